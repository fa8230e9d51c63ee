"""Hard negatives by Kronecker-packed products.

Every component is a whole number. Lifted above zero, the same component of several candidates fits side by side into
one wide integer, each in a field that is broad enough for a whole inner product. One multiplication by an anchor's
component then serves all candidates of the integer, the products add up without touching the neighbouring field, and
each field holds the exact score of its candidate once the lifts are taken back.

Rows are sorted by label and cut into packs, anchors into blocks. The cells of the grid packs x blocks are dealt over
the cluster; a cell gives its best few per anchor, and only those are merged. First every anchor meets the packs with
its own label, which gives its positives, then the packs with other labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.session import settled

PACK_ROWS, PACK_VALUES = 4096, 1 << 18  # rows of a pack at most; components of a pack, which bounds its bytes
BLOCK_ANCHORS, BLOCK_VALUES = 2048, 1 << 17
CELL_PACKS = 16  # packs that meet one copy of an anchor block
TILE_SCORES = 1 << 20  # scores held at a time
WIDE_FIELDS = 8  # candidates per integer where machine words are too narrow
PACK = "part int, n int, uids binary, ids binary, labels array<string>, kinds array<string>, words binary, sums binary"
BLOCK = "number long, uids binary, ids binary, labels array<string>, kinds array<string>, vectors binary, found array<array<long>>, scores array<array<string>>"


class Fields:
    """How candidates share an integer: from the smallest and largest component and the vectors' length."""

    def __init__(self, low: float, high: float, width: int, scale: int):
        self.low, self.width = min(0, int(np.floor(scale * low))), width
        spread = max(0, int(np.floor(scale * high))) - self.low
        self.bits = max(1, (spread * spread * width).bit_length())
        self.machine = self.bits <= 48  # leaves room to put a row's place below its score
        self.per = 64 // self.bits if self.machine else WIDE_FIELDS
        self.bytes = 8 if self.machine else -(-self.bits * self.per // 8)

    def lifted(self, whole: np.ndarray) -> np.ndarray:
        """Rows x width of components above zero; exact whatever their size."""
        if self.machine:
            return (whole - self.low).astype(np.uint64)
        return np.array([int(x) - self.low for x in whole.ravel()], object).reshape(whole.shape)

    def pack(self, lifted: np.ndarray) -> np.ndarray:
        """Width x integers: field j of integer i belongs to row ``i * per + j``."""
        padded = np.zeros((-(-len(lifted) // self.per) * self.per, lifted.shape[1]), lifted.dtype)
        padded[:len(lifted)] = lifted
        words = padded[0::self.per].copy()
        for j in range(1, self.per):
            words += padded[j::self.per] << (np.uint64(self.bits * j) if self.machine else self.bits * j)
        return np.ascontiguousarray(words.T)

    def scores(self, anchors: np.ndarray, words: np.ndarray, anchor_sums: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Anchors x rows of exact inner products; ``anchors`` and both sums are of lifted components."""
        products = np.einsum("ij,jk->ik", anchors, words) if self.machine else anchors @ words  # einsum is faster on machine words
        out = np.empty((len(anchors), words.shape[1] * self.per), np.int64 if self.machine else object)
        shift, mask = (np.uint64, np.uint64((1 << self.bits) - 1)) if self.machine else (int, (1 << self.bits) - 1)
        for j in range(self.per):
            out[:, j::self.per] = (products >> shift(self.bits * j)) & mask
        return out[:, :len(sums)] + self.low * (anchor_sums[:, None] + sums[None, :]) + self.width * self.low * self.low

    def sums(self, lifted: np.ndarray) -> np.ndarray:
        return lifted.sum(axis=1).astype(np.int64 if self.machine else object)

    def write(self, values: np.ndarray) -> bytes:
        return values.tobytes() if self.machine else b"".join(int(x).to_bytes(self.bytes, "little") for x in values.ravel())

    def read(self, data: bytes, rows: int, columns: int) -> np.ndarray:
        if self.machine:
            return np.frombuffer(data, np.uint64).reshape(rows, columns)
        return np.array([int.from_bytes(data[i:i + self.bytes], "little") for i in range(0, len(data), self.bytes)], object).reshape(rows, columns)


def _whole(batch: pa.RecordBatch, width: int, scale: int) -> np.ndarray:
    """Rows x width of ``floor(scale * x)`` as doubles, which hold these whole numbers exactly; missing places are zero."""
    out = np.zeros((batch.num_rows, width))
    column = batch.column("vector")
    sizes = np.diff(column.offsets.to_numpy())
    at = np.arange(width)[None, :] < sizes[:, None]
    out[at] = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
    return out


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` rows, the last one smaller."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            have = sum(b.num_rows for b in held)
            held.append(batch.slice(0, rows - have))
            batch = batch.slice(rows - have)
            if sum(b.num_rows for b in held) == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _bytes(column: pa.Array) -> bytes:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False)).astype(np.int64).tobytes()


def _packs(rows: DataFrame, fields: Fields, scale: int, most: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(_gathered(batches, most)):
            lifted = fields.lifted(_whole(batch, fields.width, scale))
            labels = batch.column("label").to_pylist()
            yield pa.RecordBatch.from_pylist([{
                "part": (part + i) % parts, "n": len(labels), "uids": _bytes(batch.column("uid")), "ids": _bytes(batch.column("vec_id")), "labels": labels,
                "kinds": sorted(set(labels)), "words": fields.write(fields.pack(lifted)), "sums": fields.write(fields.sums(lifted).astype(lifted.dtype))}], _schema(PACK))
    return rows.mapInArrow(run, PACK)


def _blocks(anchors: DataFrame, fields: Fields, scale: int, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(_gathered(batches, most)):
            labels = batch.column("label").to_pylist()
            yield pa.RecordBatch.from_pylist([{
                "number": (part << 32) + i, "uids": _bytes(batch.column("uid")), "ids": _bytes(batch.column("vec_id")), "labels": labels, "kinds": sorted(set(labels)),
                "vectors": fields.write(fields.lifted(_whole(batch, fields.width, scale))),
                "found": batch.column("found").to_pylist(), "scores": batch.column("scores").to_pylist()}], _schema(BLOCK))
    return anchors.mapInArrow(run, BLOCK)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
             "array<array<long>>": pa.list_(pa.list_(pa.int64())), "array<array<string>>": pa.list_(pa.list_(pa.string()))}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


def _cells(packs: DataFrame, blocks: DataFrame, parts: int, condition: Column) -> DataFrame:
    """Every pack beside every anchor block that satisfies the condition, dealt by part and block."""
    numbers = [r["number"] for r in blocks.select("number").collect()]  # one number per 2,048 anchors
    dealt = blocks.select(F.struct(*blocks.columns).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "number")
    spread = packs.select(F.struct(*packs.columns).alias("pack"), F.explode(F.array(*[F.lit(n) for n in numbers]).cast("array<long>")).alias("number"))
    cell = lambda part: F.concat_ws(":", part, "number").alias("cell")
    left, right = spread.select("pack", cell(F.col("pack.part"))), dealt.select("block", cell(F.col("part")))
    return left.join(right, "cell").filter(condition).select("pack", "block")


class _Cell:
    """One pack beside one block: scores in tiles, sorted so that the best stand last, equal scores by id."""

    def __init__(self, fields: Fields, pack: dict, block: dict):
        self.fields, self.n = fields, pack["n"]
        self.uids, self.ids = np.frombuffer(pack["uids"], np.int64), np.frombuffer(pack["ids"], np.int64)
        self.labels, self.words = np.array(pack["labels"], object), fields.read(pack["words"], fields.width, -(-self.n // fields.per))
        self.sums = fields.read(pack["sums"], 1, self.n)[0].astype(np.int64 if fields.machine else object)
        self.anchor_uids, self.anchor_ids = np.frombuffer(block["uids"], np.int64), np.frombuffer(block["ids"], np.int64)
        self.anchor_labels = np.array(block["labels"], object)
        self.anchors = fields.read(block["vectors"], len(self.anchor_uids), fields.width)
        self.order = np.argsort(self.ids, kind="stable")
        self.place = np.empty(self.n, np.int64)
        self.place[self.order] = self.n - 1 - np.arange(self.n)  # larger is better: the smaller id

    def tiles(self, which: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``anchor, keys``: score and place of every row as one number, ``score * n + place``."""
        step = max(1, TILE_SCORES // max(1, self.n))
        for start in range(0, len(which), step):
            some = which[start:start + step]
            lifted = self.anchors[some]
            scores = self.fields.scores(lifted, self.words, self.fields.sums(lifted), self.sums)
            yield from zip(some, scores * self.n + self.place)

    def row(self, key) -> tuple[int, int]:
        """Score and row of a key."""
        score, place = divmod(int(key), self.n)
        return score, int(self.order[self.n - 1 - place])


def _each(cells: DataFrame, run, ddl: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist([dict(zip(_schema(ddl).names, line)) for line in run(row["pack"], row["block"])], _schema(ddl))
    return cells.mapInArrow(work, ddl)


def _positives(cells: DataFrame, fields: Fields, k: int) -> DataFrame:
    """The best ``k`` rows of the anchor's label in each cell."""
    def run(pack: dict, block: dict):
        cell = _Cell(fields, pack, block)
        same = {label: np.flatnonzero(cell.labels == label) for label in set(pack["kinds"]) & set(block["kinds"])}
        for a, keys in cell.tiles(np.flatnonzero([label in same for label in cell.anchor_labels])):
            own = keys[same[cell.anchor_labels[a]]]
            for key in np.sort(own)[-k - 1:]:
                score, i = cell.row(key)
                if cell.uids[i] != cell.anchor_uids[a]:
                    yield int(cell.anchor_uids[a]), int(cell.ids[i]), str(score)
    return _each(cells, run, "uid long, found long, score string")


def _negatives(cells: DataFrame, fields: Fields, k: int, low: int, high: int) -> DataFrame:
    """Per anchor and positive the best ``k`` rows of other labels in the wanted range, in each cell."""
    def run(pack: dict, block: dict):
        cell = _Cell(fields, pack, block)
        spans = {label: cell.labels != label for label in block["kinds"]}
        for a, keys in cell.tiles(np.flatnonzero([spans[label].any() for label in cell.anchor_labels])):
            other = np.sort(keys[spans[cell.anchor_labels[a]]])
            for p, (found, score) in enumerate(zip(block["found"][a], map(int, block["scores"][a]))):
                least, most = -(-low * score // 100), high * score // 100
                if most < least:
                    continue
                ends = [int(np.searchsorted(other, bound)) for bound in (least * cell.n, (most + 1) * cell.n)]
                for key in other[max(ends[0], ends[1] - k):ends[1]]:
                    s, i = cell.row(key)
                    yield int(cell.anchor_uids[a]), int(cell.anchor_ids[a]), p, found, str(score), int(cell.ids[i]), str(s)
    return _each(cells, run, "uid long, anchor_id long, place int, positive_id long, positive_score string, negative_id long, negative_score string")


def _exact(score: str) -> Column:
    """Sorts text numbers of any length by value: sign, then length, then digits."""
    negative, digits = F.col(score).startswith("-"), F.regexp_replace(score, "^-", "")
    ranked = F.concat(F.lpad(F.length(digits).cast("string"), 4, "0"), digits)
    return F.when(negative, F.concat(F.lit("a"), F.translate(ranked, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("b"), ranked))


def _first(rows: DataFrame, by: list[str], score: str, found: str, k: int) -> DataFrame:
    """The best ``k`` rows per group with their rank; Spark cuts each task's share before the shuffle."""
    window = Window.partitionBy(*by).orderBy(_exact(score).desc(), F.col(found))
    return rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: int = 256,
         id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scratch: list[str] | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the exact inner product of the components ``floor(scale * x)``. The positives of a row that satisfies
    ``anchor`` are the ``positives`` other rows of its label with the largest scores; for each, the negatives are the first
    ``k`` rows of other labels with ``low * positive_score <= 100 * negative_score <= high * positive_score``, largest score
    first. Ties go to the smaller id.

    Rows with a null id, label or vector, with a null or non-finite component, or with one that is no longer finite once
    scaled, take no part. Of vectors of unequal length the missing components count as zero. A repeated row is a row like
    any other: it can be a positive of its twin, and both are anchors. Scores beyond a long are compared exactly and
    returned as the nearest long. No rows, no anchors or one label give nothing. Other columns are not read.
    ``scratch`` collects the folders written, for ``discard``.
    """
    scratch = [] if scratch is None else scratch
    spark, v = rows.sparkSession, F.col(f"`{vector_column}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    used = rows.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("string").alias("label"), v.alias("vector"),
                       F.coalesce(anchor, F.lit(False)).alias("is_anchor"), finite.alias("finite"))
    used = used.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("finite")).drop("finite").withColumn("uid", F.monotonically_increasing_id())
    used = settled(used, scratch)
    told = used.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"), F.max(F.size("vector")).alias("width"),
                    F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")).first()
    width = told["width"] or 0
    fields = Fields(told["low"] or 0.0, told["high"] or 0.0, width, scale)

    at_once = spark.sparkContext.defaultParallelism
    most = max(1, min(PACK_ROWS, PACK_VALUES // max(1, width)))
    most = max(min(256, most), min(most, -(-told["n"] // (2 * at_once))))
    wanted = max(1, -(-told["n"] // most))
    parts = min(wanted, max(at_once, -(-wanted // CELL_PACKS)))
    dealt = used.repartitionByRange(wanted, "label", "vec_id", "uid").sortWithinPartitions("label", "vec_id", "uid").select("uid", "vec_id", "label", "vector")
    packs = settled(_packs(dealt, fields, scale, most, parts), scratch)

    block = max(1, min(BLOCK_ANCHORS, BLOCK_VALUES // max(1, width)))
    columns = ["uid", "vec_id", "label", "vector", "found", "scores"]

    def blocks(anchors: DataFrame) -> DataFrame:
        ranged = anchors.repartitionByRange(max(1, -(-told["anchors"] // block)), "label", "vec_id", "uid").sortWithinPartitions("label", "vec_id", "uid")
        return settled(_blocks(ranged.select(*columns), fields, scale, block), scratch)

    anchors = used.filter("is_anchor")
    none = anchors.withColumns({"found": F.array().cast("array<long>"), "scores": F.array().cast("array<string>")})
    shared = F.arrays_overlap("pack.kinds", "block.kinds")
    best = settled(_first(_positives(_cells(packs, blocks(none), parts, shared), fields, positives), ["uid"], "score", "found", positives), scratch)
    own = best.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("rank", "found", "score"))).alias("own"))
    having = anchors.join(own, "uid").withColumns({"found": F.col("own.found"), "scores": F.col("own.score")})
    differ = (F.size("pack.kinds") > 1) | (F.size("block.kinds") > 1) | (F.get("pack.kinds", F.lit(0)) != F.get("block.kinds", F.lit(0)))
    found = _negatives(_cells(packs, blocks(having), parts, differ), fields, k, low, high)
    edge = lambda c: F.coalesce(F.col(c).try_cast("long"), F.when(F.col(c).startswith("-"), F.lit(-(2**63))).otherwise(F.lit(2**63 - 1))).alias(c)
    return _first(found, ["uid", "place"], "negative_score", "negative_id", k).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", edge("positive_score"), edge("negative_score"))
