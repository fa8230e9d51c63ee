"""Approximate nearest neighbours by a permutation index.

Every vector is represented by the order in which a fixed set of pivots lies around it. It is posted in the inverted
files of its nearest pivots; a query reads the files of its own nearest pivots, ranks what it finds there by the
footrule distance between the two orders, and only the best share is compared on the vectors themselves.

Equal vectors are one class with its smallest ids: a vector that a third of the rows repeat is indexed once, and ties
are settled by id. A file that is too long for one task is dealt out in shards, and so are the queries that read it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.llm.common import hash_sample
from snapflow.session import settled

PIVOTS, POST, PROBE = 128, 4, 48
RERANKED, LEAST_RERANKED = 0.06, 48  # share of what a file holds for a query, and at least so many
SHARD_POSTINGS, BLOCK_QUERIES = 20_000, 2_000


def _valid(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    v = F.col(f"`{vector_column}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.filter(F.col(f"`{id_column}`").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
            .select(F.col(f"`{id_column}`").alias("vec_id"), v.cast("array<double>").alias("vector")))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for c in chunks] or [np.zeros((0, width))])


def _unit(m: np.ndarray) -> np.ndarray:
    scaled = m / np.abs(m).max(axis=1, keepdims=True)  # lengths of very large or small vectors stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Place of every pivot in the order around each vector, nearest first; equal distances in pivot order."""
    order = np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")
    places = np.empty(order.shape, np.uint8)
    np.put_along_axis(places, order, np.arange(len(pivots), dtype=np.uint8)[None, :].repeat(len(order), 0), 1)
    return places


def _search(queries: pa.Table, postings: pa.Table, pivot: int, k: int, width: int, pivots: int) -> pa.Table:
    """The best ``k`` ids per query among the postings of one shard of one pivot's file."""
    probe = min(PROBE, pivots)
    places = lambda column: np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, pivots)
    q, c = _matrix(queries.column("vector"), width), _matrix(postings.column("posted_vector"), width)
    unit_q, unit_c = _unit(q), _unit(c)
    order_q, order_c = places(queries.column("places")), places(postings.column("posted_places"))
    signed = order_c.astype(np.int16)
    posted = np.argsort(order_c, axis=1, kind="stable")[:, :POST]
    ids = postings.column("ids").to_pylist()
    names = queries.column("class_id").to_pylist()
    found: list[tuple] = []
    for i in range(len(q)):
        # A candidate is met in several files; it is looked at in the one that comes first for this query.
        mine = order_q[i]
        first = posted[np.arange(len(c)), mine[posted].argmin(axis=1)]
        here = np.flatnonzero(first == pivot)
        if mine[pivot] >= probe or not len(here):
            continue
        footrule = np.abs(signed[here] - mine.astype(np.int16)).sum(axis=1, dtype=np.int32)
        best = here[np.argsort(footrule, kind="stable")[:max(LEAST_RERANKED, int(RERANKED * len(here)))]]
        cosine = unit_c[best] @ unit_q[i]
        close = np.flatnonzero(cosine >= (np.partition(cosine, -k)[-k] if len(cosine) > k else -2))
        rows = sorted((-float(cosine[j]), v) for j in close for v in ids[best[j]])[:k]
        found += [(names[i], v, -s) for s, v in rows]
    columns = list(zip(*found)) or [(), (), ()]
    kind = queries.schema.field("class_id").type
    return pa.table({"class_id": pa.array(columns[0], kind), "vec_id": pa.array(columns[1], kind), "score": pa.array(columns[2], pa.float64())})


def nearest(vectors: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows of each query found by the index, by cosine.

    ``is_query`` is a condition on ``vec_id``. Vectors that are null, zero, or hold a null or non-finite component, rows
    without an id, and vectors whose length is not that of the smallest valid id take no part. Fewer candidates than ``k``
    are all returned; equal scores go to the smaller id; repeated rows count once. No valid vector gives no row.

    Pivots are the ``pivots`` distinct vectors whose ids hash smallest (at most 256): a bounded sample. All rows are posted.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], f"query_id {vectors.schema[id_column].dataType.simpleString()}, rank int, vec_id {vectors.schema[id_column].dataType.simpleString()}, score double")
    rows = _valid(vectors, id_column, vector_column)
    width = rows.agg(F.min_by(F.size("vector"), "vec_id")).first()[0]
    if width is None:
        return empty
    rows = rows.filter(F.size("vector") == width).distinct()
    lowest = rows.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).filter(F.col("at") <= k + 1)
    classes = settled(lowest.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("class_id", F.get("ids", F.lit(0))))
    chosen = hash_sample(classes.select("class_id", "vector"), "class_id", min(pivots, 256)).toArrow()
    centre = _unit(_matrix(chosen.column("vector"), width))
    held, count = spark.sparkContext.broadcast(centre), len(centre)  # at most 256 vectors

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                places = _orders(_matrix(batch.column("vector"), width), held.value)
                nearest_first = np.argsort(places, axis=1, kind="stable")[:, :max(POST, PROBE)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in ("class_id", "ids", "vector")), pa.array([p.tobytes() for p in places]),
                     pa.array(list(nearest_first), pa.list_(pa.int32()))], ["class_id", "ids", "vector", "places", "near"])

    kind = vectors.schema[id_column].dataType
    schema = T.StructType([T.StructField("class_id", kind), T.StructField("ids", T.ArrayType(kind)), T.StructField("vector", T.ArrayType(T.DoubleType())),
                           T.StructField("places", T.BinaryType()), T.StructField("near", T.ArrayType(T.IntegerType()))])
    placed = settled(classes.select("class_id", "ids", "vector").mapInArrow(place, schema))
    asked = settled(rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "vector").join(placed.select("vector", "class_id"), "vector").select("query_id", "class_id"))
    queries = placed.join(asked.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "vector", "places", F.explode(F.slice("near", 1, PROBE)).alias("pivot"))
    postings = placed.select(F.col("class_id").alias("posted_id"), "ids", F.col("vector").alias("posted_vector"), F.col("places").alias("posted_places"), F.explode(F.slice("near", 1, POST)).alias("pivot"))
    # One row per pivot: how many shards its file and its queries are dealt out to.
    shards = F.broadcast(postings.groupBy("pivot").agg(F.ceil(F.count("*") / SHARD_POSTINGS).cast("int").alias("shards")))
    blocks = F.broadcast(queries.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks")))
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = queries.join(shards, "pivot").join(blocks, "pivot").select("class_id", "vector", "places", "pivot", deal("class_id", "blocks").alias("block"), every("shards").alias("shard"))
    p = postings.join(shards, "pivot").join(blocks, "pivot").select("posted_id", "ids", "posted_vector", "posted_places", "pivot", deal("posted_id", "shards").alias("shard"), every("blocks").alias("block"))

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _search(left, right.sort_by("posted_id"), key[0].as_py(), k + 1, width, count)

    ids = kind.simpleString()
    found = q.groupBy("pivot", "shard", "block").cogroup(p.groupBy("pivot", "shard", "block")).applyInArrow(search, f"class_id {ids}, vec_id {ids}, score double")
    order = [F.col("score").desc(), F.col("vec_id")]
    best = found.withColumn("at", F.row_number().over(Window.partitionBy("class_id").orderBy(*order))).filter(F.col("at") <= k + 1).drop("at")
    ranked = (asked.join(best, "class_id").filter(F.col("vec_id") != F.col("query_id"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k))
    return ranked.select("query_id", "rank", "vec_id", "score")
