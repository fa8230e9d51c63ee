"""XML dumps: one row per repeated child of the root, or the root itself where nothing repeats."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions.files import decoded
from snapflow.session import discard, settled
from snapflow.sources.paths import filesystem, ship


def count_children(stream) -> tuple[str, Counter, set[str]]:
    """Root name, how often each child name occurs, and which of them ever hold attributes or elements.
    The file is streamed through an event parser."""
    depth, root, child, seen, structured = 0, "", "", Counter(), set()

    def start(name, attributes):
        nonlocal depth, root, child
        if depth == 0:
            root = name
        elif depth == 1:
            child = name
            seen[name] += 1
        if depth == 2 or (depth == 1 and attributes):
            structured.add(child)
        depth += 1

    def end(_name):
        nonlocal depth
        depth -= 1

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.ParseFile(stream)
    return root, seen, structured


def _profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            fs, local = filesystem(path)
            with fs.open_input_stream(local) as stream:
                root, seen, structured = count_children(stream)
            found += [(path, root, tag, n if tag in structured else 0) for tag, n in seen.items()] or [(path, root, None, 0)]
        yield pd.DataFrame(found, columns=["path", "root", "tag", "n"])


def _profiles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, root, tag, n``: per file its root and how often each child occurs; 0 for children that are only text."""
    ship(__name__)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return files.mapInPandas(_profile, "path string, root string, tag string, n long")


def _roles(profiles: DataFrame) -> tuple[list[str], DataFrame]:
    """Child names that repeat in at least one file and are more than text; and ``path, root`` of the files that hold none."""
    tags = sorted(r["tag"] for r in profiles.filter("n > 1").select("tag").distinct().collect())
    held = profiles.groupBy("path", "root").agg(F.bool_or(F.col("tag").isin(tags) & (F.col("n") > 0)).alias("held"))
    return tags, held.filter("NOT coalesce(held, false)").select("path", "root")


def row_tags(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Child names that repeat in at least one file and are more than text; and root names of the files that hold none.

    Files are scanned in parallel, once. Back come element names only.
    """
    scratch: list[str] = []
    tags, lone = _roles(settled(_profiles(spark, path), scratch))
    roots = sorted(r["root"] for r in lone.select("root").distinct().collect())
    discard(spark, scratch)
    return tags, roots


def element_shapes(stream) -> dict[str, tuple[bool, bool, set[str]]]:
    """By path below the root: whether the element repeats under one parent, has text, and its attributes."""
    shapes: dict[str, list] = {}
    stack: list[tuple[str, Counter]] = []

    def start(name, attributes):
        path = f"{stack[-1][0]}/{name}" if stack else ""
        shape = shapes.setdefault(path, [False, False, set()])
        shape[2].update(a for a in attributes if not a.startswith("xmlns"))
        if stack:
            stack[-1][1][name] += 1
            shape[0] |= stack[-1][1][name] > 1
        stack.append((path, Counter()))

    def text(data):
        if data.strip():
            shapes[stack[-1][0]][1] = True

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, lambda _name: stack.pop(), text
    parser.ParseFile(stream)
    return {k: tuple(v) for k, v in shapes.items()}


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            fs, local = filesystem(path)
            with fs.open_input_stream(local) as stream:
                found += [(at, repeats, text, sorted(attributes)) for at, (repeats, text, attributes) in element_shapes(stream).items()]
        yield pd.DataFrame(found, columns=["at", "repeats", "text", "attributes"])


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole small files as text, without their declaration."""
    for batch in batches:
        for path in batch["path"]:
            fs, local = filesystem(path)
            with fs.open_input_stream(local) as stream:
                data = stream.read()
            named = re.match(rb"""(?:\xef\xbb\xbf)?<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)["']""", data)
            code = "utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else named.group(1).decode() if named else "utf-8"
            text = re.sub(r"^\s*<\?xml.*?\?>", "", data.decode(code, "replace").lstrip("\ufeff"), flags=re.DOTALL)
            yield pd.DataFrame({"path": [path], "text": [text]})


def _record_schema(lines: list) -> T.StructType:
    """The columns of records whose elements have these shapes, all values as text: what Spark's reader would name them."""
    below: dict[str, list[str]] = {}
    of = {r["at"]: r for r in lines}
    for at in of:
        if at:
            below.setdefault(at.rpartition("/")[0], []).append(at)

    def kind(at: str) -> T.DataType:
        r = of[at]
        fields = {f"_{a}": T.StringType() for a in r["attributes"]} | {c.rpartition("/")[2]: kind(c) for c in below.get(at, [])}
        if at and not fields:
            plain: T.DataType = T.StringType()
        else:
            if r["text"]:
                fields["_VALUE"] = T.StringType()
            plain = T.StructType([T.StructField(n, fields[n]) for n in sorted(fields)])
        return T.ArrayType(plain) if r["repeats"] else plain

    return kind("")


def _lone_records(lone: DataFrame, schema: T.StructType | None, scratch: list[str]) -> DataFrame | None:
    """One row per file that is a record itself, read where it lies: the files' names and texts stay on the executors."""
    if schema is None:
        shapes = lone.select("path").mapInPandas(_shapes, "at string, repeats boolean, text boolean, attributes array<string>")
        lines = shapes.groupBy("at").agg(F.bool_or("repeats").alias("repeats"), F.bool_or("text").alias("text"),
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_set("attributes")))).alias("attributes")).collect()  # element names
        if not lines:
            return None
        schema = _record_schema(lines)
    texts = lone.select("path").mapInPandas(_contents, "path string, text string")
    if not schema.fields:  # empty roots only
        return texts.select(F.col("path").alias("_file"))
    rows = texts.select(F.from_xml("text", schema).alias("r"), F.col("path").alias("_file"))
    return rows.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields], "_file")


def record_counts(spark: SparkSession, path: str) -> DataFrame:
    """``path, records`` of XML files: the most frequent record child, or 1 for a file that is a record itself."""
    return _profiles(spark, path).groupBy("path").agg(F.greatest(F.max("n"), F.lit(1)).alias("records"))


def read_xml(spark: SparkSession, path: str, row_tag: str | None = None, schema: T.StructType | None = None, scratch: list[str] | None = None) -> DataFrame:
    """Rows of an XML file or folder through Spark's XML reader, with the file in ``_file``.

    Values are text, so that ids keep their zeros; pass ``schema`` for types. Pass ``row_tag`` where it is known: it
    saves a pass. Several repeated names give the union of their rows. A file that holds none of the names that repeat
    elsewhere is one row by itself, its root. What role a file has is found in one pass and written with its name;
    the driver sees element names only. ``scratch`` collects what is written, for ``discard``.
    """
    def one(tag: str) -> DataFrame:
        reader = spark.read.format("xml").option("rowTag", tag).option("recursiveFileLookup", "true").option("inferSchema", "false")
        rows = (reader.schema(schema) if schema else reader).load(path)
        return rows.select(*[f"`{c}`" for c in rows.columns], decoded(F.col("_metadata.file_path")).alias("_file"))

    if row_tag:
        return one(row_tag)
    tags, lone = _roles(settled(_profiles(spark, path), scratch))
    frames = [one(t) for t in tags]
    records = _lone_records(lone, schema, scratch if scratch is not None else [])
    if records is not None:
        frames.append(records)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
