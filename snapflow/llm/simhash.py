"""SimHash near-duplicates by a byte-position index.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most three bits share at least
five of them. Posting lists of single bytes would hold 1/256 of all fingerprints each, so the index posts byte
*triples*: with the positions split in two halves of four, five shared bytes put three in one half, and the four
triples of each half (eight in all) miss no pair. Within a posting list shared bytes are tallied, pairs with fewer
than five are dropped, and the rest are verified by their differing bits.

Only distinct fingerprints are indexed, and a list hands back a spanning forest of its links instead of all pairs:
linear in the list, with the same components. A list with too many members is refined by two more shared bytes and
a quarter of the rest, which leaves at most 2**18 possible members however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.llm.common import id_and_text, small_batches, texts
from snapflow.llm.graph import components
from snapflow.session import settled

TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
LEAST_BYTES, MOST_BITS, SEED = 5, 3, 42
LIST_MEMBERS = 20_000
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, width: int = 3, block: int = 1 << 16) -> int:
    """Majority bits of the hashes of all word shingles, repeats included; 0 for a text without words."""
    words = text.translate(_UPPER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    stops = (ends[width - 1:] - 1).tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), block):
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at:at + block], stops[at:at + block])), ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, print`` (the 64 bits as a signed long) per row; a null text is an empty one."""
    rows = id_and_text(docs, id_column, text_column)
    schema = T.StructType([rows.schema["doc_id"], T.StructField("print", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            prints = np.array([fingerprint(t) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], ["doc_id", "print"])

    return rows.mapInArrow(run, schema)


def _byte(i: int) -> Column:
    """Byte i of a fingerprint, most significant first."""
    return F.shiftrightunsigned("print", 56 - 8 * i).bitwiseAND(F.lit(255))


def forest(members: np.ndarray, chunk: int = 1 << 16) -> list[tuple[int, int]]:
    """Links of a spanning forest over fingerprints that differ in at most three bits.

    Every member is compared with the members not yet reached: shared bytes first, differing bits of those that
    share enough.
    """
    left, links = np.unique(members.view(np.uint64)), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            near = np.zeros(len(left), bool)
            for at in range(0, len(left), chunk):
                differing = left[at:at + chunk] ^ x
                shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
                hit = np.flatnonzero(shared >= LEAST_BYTES)
                near[at + hit] = np.bitwise_count(differing[hit]) <= MOST_BITS
            found = left[near]
            if len(found):
                links += [(int(x.view(np.int64)), int(y)) for y in found.view(np.int64)]
                queue += list(found)
                left = left[~near]
    return links


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints; their components are those of all pairs within three bits."""
    distinct = prints.select("print").distinct()
    posted = distinct.select("print", F.explode(F.array(*[
        F.struct(F.lit(t).alias("triple"), F.xxhash64(F.lit(t), *map(_byte, places)).alias("key")) for t, places in enumerate(TRIPLES)])).alias("p")).select("print", "p.*")
    lists = posted.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(F.col("key").cast("string").alias("k"), "n")
    posted = posted.withColumn("k", F.col("key").cast("string"))
    small = (posted.join(lists.filter(F.col("n") <= LIST_MEMBERS), "k", "left_semi")
             .groupBy("k").agg(F.collect_list("print").alias("members")))

    # Two more shared bytes of the other five, and one quarter of the remaining 24 bits, agree for every link.
    finer = []
    for t, places in enumerate(TRIPLES):
        others = [i for i in range(8) if i not in places]
        for two in combinations(others, 2):
            rest = [i for i in others if i not in two]
            bits = F.shiftleft(_byte(rest[0]), 16) + F.shiftleft(_byte(rest[1]), 8) + _byte(rest[2])
            finer += [(t, F.xxhash64(F.lit(t), F.lit(q), *[F.lit(i) for i in two], *[_byte(i) for i in (*places, *two)],
                                     F.shiftright(bits, 6 * q).bitwiseAND(F.lit(63)))) for q in range(4)]
    refined = (posted.join(lists.filter(F.col("n") > LIST_MEMBERS), "k", "left_semi")
               .select("print", F.explode(F.filter(F.array(*[F.when(F.col("triple") == t, k) for t, k in finer]), lambda x: x.isNotNull())).alias("k"))
               .groupBy("k").agg(F.collect_list("print").alias("members"))
               .filter(F.size("members") > 1).select(F.col("k").cast("string"), "members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [link for m in batch.column("members") for link in forest(m.values.to_numpy())]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return small.union(refined).mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scratch: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, print, component_id``, the smallest id reachable over near-duplicate links.

    Texts without words have fingerprint 0 and are linked like any other. Repeated rows each give a row. A null id
    is no smallest id; a component whose ids are all null has a null ``component_id``. No rows give none.
    """
    scratch = [] if scratch is None else scratch
    prints = settled(fingerprints(docs, id_column, text_column), scratch)
    rooted, least = _rooted(prints, scratch)
    known = rooted.join(least, "r").select(F.col("print").cast("string").alias("k"), "component_id")
    return prints.withColumn("k", F.col("print").cast("string")).join(known, "k").select("doc_id", "print", "component_id")


def _rooted(prints: DataFrame, scratch: list[str]) -> tuple[DataFrame, DataFrame]:
    """``print, r`` of the distinct fingerprints, and ``r, component_id`` of their components.

    Join keys are the numbers' text: they differ from what the sides were grouped on, so that hot keys can be split.
    """
    nodes = settled(prints.groupBy("print").agg(F.min("doc_id").alias("least")), scratch)
    roots = components(links(nodes), scratch)
    rooted = nodes.join(roots, nodes["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").cast("string").alias("r"))
    least = rooted.groupBy("r").agg(F.min("least").alias("component_id")).withColumn("r", F.concat("r"))
    return rooted, least


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the document with the smallest id stays.

    A component is one of texts: rows that repeat an id with texts of different components are documents of their own, and
    of several rows with the smallest id the one whose values hash smallest stays. Of a component that has null ids only, one
    row stays; beside any other id rows with a null id go. Columns are those of ``docs``.
    """
    scratch: list[str] = []
    prints = settled(fingerprints(docs, id_column, text_column), scratch)
    rooted, least = _rooted(prints, scratch)
    least = settled(least, scratch)
    chosen = least.filter(F.col("component_id").isNotNull()).select(F.col("component_id").alias("_kept")).distinct()
    # An id that one row has names its text. Rows of other ids are told apart by fingerprint, which only they are read for again.
    shared = settled(prints.groupBy("doc_id").agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col("doc_id").isNull()).select(F.col("doc_id").alias("_shared")), scratch)
    named = docs.join(chosen, docs[id_column] == chosen["_kept"], "left_semi")
    if not shared.take(1):
        return named
    named = named.join(shared, named[id_column] == shared["_shared"], "left_anti")
    doubtful = _with_print(docs.join(shared, docs[id_column].eqNullSafe(shared["_shared"]), "left_semi"), text_column)
    placed = doubtful.withColumn("k", F.col("print").cast("string")).join(rooted.select(F.col("print").cast("string").alias("k"), "r"), "k")
    own_id = F.col(f"row.`{id_column}`")
    best = (placed.join(least, "r").filter(own_id.eqNullSafe(F.col("component_id"))).groupBy("r")
            .agg(F.min_by("row", F.xxhash64(F.col("row").cast("string"))).alias("row")))
    return named.unionByName(best.select(*[F.col("row")[c].alias(c) for c in docs.columns]))


def _with_print(rows: DataFrame, text_column: str) -> DataFrame:
    """``row, print``: whole rows beside their fingerprints."""
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("print", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            prints = np.array([fingerprint(t) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(prints)], ["row", "print"])

    return packed.mapInArrow(run, schema)
