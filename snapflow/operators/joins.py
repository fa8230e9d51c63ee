"""The one join shape behind lookups, reference checks, parent links and loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "_probe_key"


def tagged(key: Column) -> Column:
    return F.concat(F.lit("k"), key)


def probe(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, how: str = "left") -> DataFrame:
    """Join ``left`` to ``right``, which is unique on the text column ``right_key``.

    ``how`` is ``left``, ``left_semi`` or ``left_anti``.

    * Rows without a key cannot match. They are spread over the cluster by their partition number
      instead of meeting in one task; the leading tag keeps them apart from every real key.
    * The tagged key differs from the column ``right`` was de-duplicated on, so both join inputs
      are plain exchanges. That is the shape in which adaptive execution can split a hot left
      partition over many tasks. A small right side is broadcast by Spark's own size check.

    The partition number is the same when a task is retried, so a lost executor does not move rows.
    """
    spread = F.concat(F.lit("n"), F.spark_partition_id().cast("string"))
    keyed_left = left.withColumn(KEY, F.coalesce(tagged(left_key), spread))
    keyed_right = right.withColumn(KEY, tagged(F.col(right_key))).drop(right_key)
    return keyed_left.join(keyed_right, KEY, how).drop(KEY)


def text_ids(table: DataFrame, id_column: str, name: str = "_id") -> DataFrame:
    """Distinct non-null ids as text."""
    return table.select(F.col(f"`{id_column}`").cast("string").alias(name)).filter(F.col(name).isNotNull()).distinct()


def id_set(table: DataFrame, id_column: str, name: str = "_id") -> DataFrame:
    """Distinct non-null ids as text, with a hit flag."""
    return text_ids(table, id_column, name).withColumn("_hit", F.lit(True))


MAP_BITS = 26  # places of the id map: 8 MB at most, whatever the number of ids


def among(table: DataFrame, key: Column, ids: DataFrame, id_column: str = "_id") -> DataFrame:
    """Rows of ``table`` whose text key may be in ``ids``: all that are, and few others.

    The ids set bits of a map of fixed size, which is sent to every task, so a large table drops almost all rows that no
    id of a small batch can match before anything is shuffled. With n ids about n / 2^26 of the others pass. The join that
    follows decides; this only makes it smaller.
    """
    place = lambda text: F.pmod(F.xxhash64(text), F.lit(1 << MAP_BITS))
    low = (1 << 15) - 1
    spots = ids.select(place(F.col(id_column)).alias("p")).select(F.shiftright("p", 15).alias("_chunk"), F.col("p").bitwiseAND(low).alias("p"))
    chunks = spots.groupBy("_chunk").agg(F.bitmap_construct_agg("p").alias("_bits"))  # 2^11 rows of 4 KB at most
    at = place(key)
    placed = table.withColumn("_chunk", F.shiftright(at, 15)).withColumn("_at", at.bitwiseAND(low).cast("int"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright("_at", 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.get(F.array(*[F.lit(1 << b) for b in range(8)]), F.col("_at").bitwiseAND(7))
    return placed.join(F.broadcast(chunks), "_chunk").filter(byte.bitwiseAND(bit) != 0).select(*[F.col(f"`{c}`") for c in table.columns])
