"""Corpora of xlsx workbooks as a Spark data source.

``read_workbook`` is the entry point. Each read task opens its workbooks where they are (any file system
Arrow can address), seeks to the wanted sheets and streams their rows into Arrow batches, so neither the
driver nor a task ever holds a workbook. A sheet cannot exceed 1,048,576 rows, and workbooks are packed into
read partitions by size, so no task is unbounded.

Formula cells give their cached value; error cells, unreadable numbers and empty cells give NULL.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import re
import zipfile
import zlib
import zoneinfo
from collections import OrderedDict
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from snapflow.functions.text import JAVA_WHITESPACE
from snapflow.session import empty_frame, settled
from snapflow.sources.paths import filesystem, ship

FORMAT = "workbook"
BATCH_ROWS = 4096
# Built-in number formats that show a date or a time.
BUILTIN_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

META = {"_file": T.StringType(), "_sheet_index": T.IntegerType(), "_sheet": T.StringType(), "_row": T.LongType()}
SHEETS_SCHEMA = T.StructType([T.StructField(n, META[n]) for n in ("_file", "_sheet_index", "_sheet")])
PROFILE_SCHEMA = T.StructType([
    *SHEETS_SCHEMA.fields, T.StructField("position", T.IntegerType()), T.StructField("header", T.StringType()),
    T.StructField("kinds", T.StringType()), T.StructField("n_rows", T.LongType())])


# ---------------------------------------------------------------- one workbook


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _elements(stream, name: str):
    """Stream the elements of one name; each is freed once it was used."""
    parents = []
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if _local(element.tag) == name:
            yield element
            if parents:
                parents[-1].clear()


def is_date_format(number: int, code: str | None) -> bool:
    """True when a number format shows a date: a built-in one, or a code made of date letters only."""
    if number in BUILTIN_DATE_FORMATS:
        return True
    if not code:
        return False
    first = code.split(";")[0]
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", first, flags=re.I)
    return re.fullmatch(r"[\[\]ymdhsT年月日/\-.,: ]*0*(am/pm|a/p)?[\s]*", bare, flags=re.I) is not None and \
        re.search(r"[ymdhs]", bare, flags=re.I) is not None


def serial_to_wall_clock(number: float) -> dt.datetime | None:
    """Spreadsheet day number (1900 system) to wall-clock time, to the millisecond."""
    if number < 0:
        return None
    days = int(number)
    base = dt.datetime(1899, 12, 31) if number < 61 else dt.datetime(1899, 12, 30)
    try:
        return base + dt.timedelta(days=days, milliseconds=int((number - days) * 86_400_000 + 0.5))
    except OverflowError:
        return None


def number_text(x: float) -> str:
    """A double as Spark casts it to text: ``30.0``, ``1.0E7``."""
    text = repr(float(x))
    if text in ("inf", "-inf", "nan"):
        return {"inf": "Infinity", "-inf": "-Infinity", "nan": "NaN"}[text]
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return text if "e" not in text else format(x, "f").rstrip("0")
    sign, digits, exponent = re.fullmatch(r"(-?)([\d.]+)(?:e([+-]\d+))?", text).groups()
    whole, _, fraction = digits.partition(".")
    power = int(exponent or 0) + len(whole) - 1
    joined = (whole + fraction).lstrip("0")
    if whole.strip("0") == "":
        power -= len(whole + fraction) - len(joined)
    return f"{sign}{joined[0]}.{joined[1:].rstrip('0') or '0'}E{power}"


class SharedStrings:
    """The shared strings of a workbook, by number.

    Strings are kept in deflated blocks; the blocks that were used last are kept as text too. So a table takes about what it
    takes in the file, plus at most ``OPEN_BLOCKS`` blocks, however many strings it has.
    """

    BLOCK, OPEN_BLOCKS = 1024, 64

    def __init__(self, texts):
        self._blocks: list[bytes] = []
        self._open: OrderedDict[int, list[str]] = OrderedDict()
        block: list[str] = []
        for text in texts:
            block.append(text)
            if len(block) == self.BLOCK:
                self._close(block)
                block = []
        if block:
            self._close(block)

    def _close(self, block: list[str]) -> None:
        self._blocks.append(zlib.compress("\0".join(block).encode("utf-8", "surrogatepass"), 1))  # XML text has no NUL

    def __getitem__(self, number: int) -> str:
        at, place = divmod(number, self.BLOCK)
        block = self._open.get(at)
        if block is None:
            block = self._open[at] = zlib.decompress(self._blocks[at]).decode("utf-8", "surrogatepass").split("\0")
            if len(self._open) > self.OPEN_BLOCKS:
                self._open.popitem(last=False)
        else:
            self._open.move_to_end(at)
        return block[place]


class Workbook:
    """Sheet list and row streams of one open xlsx package."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream)
        self._members = set(self.zip.namelist())
        self.sheets = self._sheet_list()
        self._strings: SharedStrings | None = None
        self._date_styles: list[bool] | None = None

    def _xml(self, member: str):
        return ElementTree.fromstring(self.zip.read(member))

    def _sheet_list(self) -> list[tuple[str, str]]:
        targets = {}
        for relation in self._xml("xl/_rels/workbook.xml.rels"):
            if relation.get("Type", "").endswith("/worksheet"):
                target = relation.get("Target", "")
                targets[relation.get("Id")] = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        found = []
        for element in self._xml("xl/workbook.xml").iter():
            if _local(element.tag) == "sheet":
                key = element.get(RELATION_ID) or next((v for k, v in element.attrib.items() if _local(k) == "id"), None)
                if key in targets:
                    found.append((element.get("name"), targets[key]))
        return found

    @property
    def strings(self) -> SharedStrings:
        if self._strings is None:
            if "xl/sharedStrings.xml" in self._members:
                with self.zip.open("xl/sharedStrings.xml") as stream:
                    self._strings = SharedStrings(self._shared_text(e) for e in _elements(stream, "si"))
            else:
                self._strings = SharedStrings([])
        return self._strings

    @staticmethod
    def _shared_text(item) -> str:
        """All text runs of an entry; a phonetic run follows after a space."""
        text = ""
        for part in item:
            if _local(part.tag) == "rPh" and text:
                text += " "
            text += "".join(t.text or "" for t in part.iter() if _local(t.tag) == "t")
        return text

    @property
    def date_styles(self) -> list[bool]:
        if self._date_styles is None:
            codes, styles = {}, []
            if "xl/styles.xml" in self._members:
                root = self._xml("xl/styles.xml")
                for group in root:
                    if _local(group.tag) == "numFmts":
                        codes = {int(f.get("numFmtId")): f.get("formatCode") for f in group}
                for group in root:
                    if _local(group.tag) == "cellXfs":
                        for style in group:
                            number = int(style.get("numFmtId", "0"))
                            styles.append(is_date_format(number, codes.get(number)))
            self._date_styles = styles
        return self._date_styles

    def rows(self, index: int):
        """Rows of a sheet as ``{column index: value}``; values are str, float, bool or datetime."""
        with self.zip.open(self.sheets[index][1]) as stream:
            for row in _elements(stream, "row"):
                cells = {}
                for cell in row:
                    if _local(cell.tag) == "c":
                        column = self._column(cell.get("r"))
                        value = self._value(cell) if column >= 0 else None
                        if value is not None:
                            cells[column] = value
                yield cells

    @staticmethod
    def _column(reference: str | None) -> int:
        column = 0
        for letter in re.match("[A-Z]*", reference or "").group():
            column = column * 26 + ord(letter) - 64
        return column - 1

    def _value(self, cell):
        kind = cell.get("t")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t") or None
        raw = next((v.text for v in cell if _local(v.tag) == "v"), None)
        if not raw or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(raw)]
        if kind == "str":
            return raw
        if kind == "b":
            return raw != "0"
        try:
            number = float(raw)
        except ValueError:
            return None
        style = int(cell.get("s", "-1"))
        if 0 <= style < len(self.date_styles) and self.date_styles[style]:
            return serial_to_wall_clock(number)
        return number


def as_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return number_text(value)
    if isinstance(value, dt.datetime):
        text = value.isoformat(" ")
        return text.rstrip("0") if value.microsecond else text
    return value


def sheet_table(rows):
    """``(headers, data rows)`` of a sheet: leading blank rows skipped, the first other row names the columns."""
    rows = iter(rows)
    for row in rows:
        texts = {i: as_text(v).strip(JAVA_WHITESPACE) for i, v in row.items()}
        if any(texts.values()):
            return [texts.get(i) or f"column_{i}" for i in range(max(texts) + 1)], rows
    return [], rows


def header_of(headers: list[str], column: int) -> str:
    return headers[column] if column < len(headers) else f"column_{column}"


# ---------------------------------------------------------------- data source


class WorkbookGroup(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.mode = options.get("mode", "rows")
        self.sheet_index = int(options.get("sheetindex", 0))
        self.sheet_name = options.get("sheetname")
        self.all_sheets = options.get("allsheets", "false").lower() == "true"
        self.headers = json.loads(options["headers"]) if "headers" in options else None  # one per schema field
        self.only: dict[str, set] = {}
        self.zone = zoneinfo.ZoneInfo(options.get("timezone", "UTC"))
        self.max_bytes = int(options.get("maxpartitionbytes", 16 << 20))

    def pushFilters(self, filters):
        """Files and sheets that a query asks for by name are the only ones that are opened."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in ("_file", "_sheet") and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only[column] = self.only.get(column, wanted) & wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, base = filesystem(self.path)
        info = fs.get_file_info(base)
        if info.type == pyarrow.fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info]
        if info.type == pyarrow.fs.FileType.Directory:
            found = [f for f in fs.get_file_info(pyarrow.fs.FileSelector(base, recursive=True))
                     if f.is_file and f.extension.lower() == "xlsx" and not f.base_name.startswith(("~", ".", "_"))]
        groups, filled = [[]], 0
        for f in sorted(found, key=lambda f: f.path):
            if "_file" in self.only and self.path + f.path[len(base):] not in self.only["_file"]:
                continue
            if groups[-1] and filled + f.size > self.max_bytes:
                groups.append([])
                filled = 0
            groups[-1].append(f.path)
            filled += f.size
        return [WorkbookGroup(g) for g in groups if g]

    def read(self, partition: WorkbookGroup):
        fs, base = filesystem(self.path)
        fields = self.schema.fields
        arrow = pa.schema([(f.name, self._arrow_type(f.dataType)) for f in fields])
        batch: list[list] = [[] for _ in fields]
        for path in partition.files:
            with fs.open_input_file(path) as stream:
                book = Workbook(stream)
                for line in self._lines(self.path + path[len(base):], book):
                    for column, value in zip(batch, line):
                        column.append(value)
                    if len(batch[0]) >= BATCH_ROWS:
                        yield self._batch(batch, arrow)
                        batch = [[] for _ in fields]
        if fields and batch[0]:
            yield self._batch(batch, arrow)

    @staticmethod
    def _batch(columns, schema):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def _wanted(self, path: str, book: Workbook) -> list[int]:
        if self.all_sheets or self.mode == "sheets":
            return list(range(len(book.sheets)))
        if self.sheet_name is not None:
            return [i for i, (name, _) in enumerate(book.sheets) if name == self.sheet_name]
        if self.sheet_index >= len(book.sheets):
            raise ValueError(f"sheet index {self.sheet_index} out of range in {path}: {len(book.sheets)} sheets")
        return [self.sheet_index]

    def _lines(self, path: str, book: Workbook):
        for index in self._wanted(path, book):
            name = book.sheets[index][0]
            if "_sheet" in self.only and name not in self.only["_sheet"]:
                continue
            if self.mode == "sheets":
                yield path, index, name
            elif self.mode == "profile":
                yield from self._profile(path, index, name, book)
            else:
                yield from self._rows(path, index, name, book)

    def _profile(self, path, index, name, book):
        headers, data = sheet_table(book.rows(index))
        kinds: dict[int, set] = {i: set() for i in range(len(headers))}
        n_rows = 0
        for row in data:
            n_rows += 1
            for column, value in row.items():
                kinds.setdefault(column, set()).add(type(value).__name__)
        for column in sorted(kinds):
            yield path, index, name, column, header_of(headers, column), ",".join(sorted(kinds[column])), n_rows

    def _rows(self, path, index, name, book):
        headers, data = sheet_table(book.rows(index))
        places: dict[str, list[int]] = {}
        own: dict[str, int] = {}
        for i, f in enumerate(self.schema.fields):
            header = self.headers[i] if self.headers else f.name
            if header is None or (not self.headers and META.get(header) == f.dataType):
                own[f.name] = i
            else:
                places.setdefault(header, []).append(i)
        convert = [self._converter(f.dataType) if i not in own.values() else None for i, f in enumerate(self.schema.fields)]
        fixed = {"_file": path, "_sheet_index": index, "_sheet": name}
        for number, row in enumerate(data):
            line = [None] * len(convert)
            for column, value in row.items():
                for at in places.get(header_of(headers, column), ()):
                    line[at] = convert[at](value)
            for key, value in {**fixed, "_row": number}.items():
                if key in own:
                    line[own[key]] = value
            yield line

    def _arrow_type(self, kind: T.DataType):
        simple = {T.StringType: pa.string(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(),
                  T.TimestampType: pa.timestamp("us", "UTC"), T.IntegerType: pa.int32(), T.LongType: pa.int64()}
        if type(kind) not in simple:
            raise ValueError(f"workbook columns are string, double, boolean or timestamp, not {kind.simpleString()}")
        return simple[type(kind)]

    def _converter(self, kind: T.DataType):
        if isinstance(kind, T.StringType):
            return as_text
        wanted = {T.DoubleType: float, T.BooleanType: bool, T.TimestampType: dt.datetime}.get(type(kind))
        if wanted is dt.datetime:
            return lambda v: v.replace(tzinfo=self.zone).astimezone(dt.UTC) if isinstance(v, dt.datetime) else None
        return lambda v: v if type(v) is wanted else None


class WorkbookSource(DataSource):
    """``spark.read.format("workbook")``; options sheetIndex, sheetName, allSheets, mode, headers, timeZone, maxPartitionBytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        modes = {"sheets": SHEETS_SCHEMA, "profile": PROFILE_SCHEMA}
        mode = self.options.get("mode", "rows")
        if mode not in modes:
            raise ValueError("workbook rows need a schema; read_workbook() finds one")
        return modes[mode]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WorkbookReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    ship(__name__)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # for filters on _file and _sheet
    spark.dataSource.register(WorkbookSource)


def _reader(spark: SparkSession, **options):
    register(spark)
    named = {k: str(v) for k, v in options.items() if v is not None}
    return spark.read.format(FORMAT).options(timeZone=spark.conf.get("spark.sql.session.timeZone"), **named)


def sheet_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, _sheet_index, _sheet)`` of every workbook below ``path``, sheets in workbook order."""
    return _reader(spark, mode="sheets").load(path)


def _headers(spark: SparkSession, path: str, by: tuple[str, ...] = (), **sheet) -> dict[tuple, list[T.StructField]]:
    """Columns over all workbooks below ``path``, by first position and name; mixed kinds become text. ``by`` keeps sheets apart.

    Profiling runs on the executors; only one line per distinct header (and sheet) comes back.
    """
    profile = _reader(spark, mode="profile", **sheet).load(path)
    kinds = F.array_distinct(F.flatten(F.collect_set(F.filter(F.split("kinds", ","), lambda k: k != ""))))
    first = [F.min("_sheet_index").alias("place")]
    found = profile.groupBy(*by, "header").agg(F.min("position").alias("position"), kinds.alias("kinds"), *first).collect()
    of_kind = {"float": T.DoubleType(), "bool": T.BooleanType(), "datetime": T.TimestampType()}
    fields: dict[tuple, list[T.StructField]] = {}
    order = {}
    for c in found:
        of = tuple(c[b] for b in by)
        order[of] = min(order.get(of, c["place"]), c["place"])
    for c in sorted(found, key=lambda c: (c["position"], c["header"])):
        only = c["kinds"][0] if len(c["kinds"]) == 1 else "str"
        fields.setdefault(tuple(c[b] for b in by), []).append(T.StructField(c["header"], of_kind.get(only, T.StringType())))
    return {of: fields[of] for of in sorted(fields, key=lambda of: (order[of], of))}


def infer_schema(spark: SparkSession, path: str, **sheet) -> T.StructType:
    """Columns over all workbooks below ``path``, by first position and name; mixed kinds become text."""
    return T.StructType(_headers(spark, path, **sheet).get((), []))


def read_sheets(spark: SparkSession, path: str, scratch: list[str]) -> dict[str, DataFrame]:
    """Rows of every sheet of every workbook below ``path``, by sheet name, each with its own columns and types.

    Each workbook is parsed twice in all: once for the columns of all sheets, once for their rows, which are written with a
    folder per sheet. A sheet's frame reads its own folder. ``scratch`` collects what is written, for ``discard``. A sheet
    without a header has no rows.
    """
    columns = _headers(spark, path, by=("_sheet",), allSheets="true")
    kinds = list(dict.fromkeys((f.name, f.dataType) for fields in columns.values() for f in fields))
    place = {kind: f"c{i}" for i, kind in enumerate(kinds)}
    meta = [T.StructField(n, t) for n, t in META.items()]
    schema = T.StructType([*[T.StructField(place[k], k[1]) for k in kinds], *meta])
    reader = _reader(spark, allSheets="true", headers=json.dumps([*[h for h, _ in kinds], *[None] * len(META)]))
    rows = settled(reader.schema(schema).load(path), scratch, by=("_sheet",))
    frames = {}
    for (sheet,), fields in columns.items():
        named = {f.name for f in fields}
        frames[sheet] = rows.filter(F.col("_sheet") == sheet).select(
            *[F.col(place[f.name, f.dataType]).alias(f.name) for f in fields], *[c for c in META if c not in named])
    names = sheet_catalog(spark, path).groupBy("_sheet").agg(F.min("_sheet_index").alias("i")).orderBy("i", "_sheet").collect()
    bare = empty_frame(spark, T.StructType(meta))
    return {r["_sheet"]: frames.get(r["_sheet"], bare) for r in names}


def read_workbook(spark: SparkSession, path: str, schema: T.StructType | None = None, sheet_index: int = 0,
                  sheet_name: str | None = None, all_sheets: bool = False) -> DataFrame:
    """Rows of one sheet of every workbook below ``path``, with ``_file, _sheet_index, _sheet, _row``.

    ``_row`` numbers the data rows of a sheet from 0. Columns a workbook lacks are NULL.
    """
    sheet = {"sheetIndex": sheet_index, "sheetName": sheet_name, "allSheets": str(all_sheets).lower()}
    schema = schema or infer_schema(spark, path, **sheet)
    meta = [T.StructField(n, t) for n, t in META.items() if n not in schema.names]
    return _reader(spark, **sheet).schema(T.StructType([*schema.fields, *meta])).load(path)


def row_counts(spark: SparkSession, path: str, sheet_index: int = 0) -> DataFrame:
    """``(_file, records)``: data rows of one sheet per workbook, without building the rows."""
    profile = _reader(spark, mode="profile", sheetIndex=sheet_index).load(path)
    return profile.groupBy("_file").agg(F.max("n_rows").alias("records"))
