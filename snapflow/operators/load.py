"""Load steps: split off bad rows, skip existing ids, upsert.

These are pure functions over frames; ``snapshot`` holds the table writers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping as Map
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.operators.joins import among, probe, text_ids
from snapflow.operators.mapping import conform
from snapflow.operators.snapshot import as_date, resolve

REASON = "_reason"
REASONS = ("type", "null", "length", "key")


def limits_of(schema: T.StructType) -> tuple[list[str], dict[str, int]]:
    """NOT NULL columns and ``char/varchar`` lengths a table schema declares."""
    required = [f.name for f in schema.fields if not f.nullable]
    lengths = {}
    for f in schema.fields:
        declared = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
        if "(" in declared:
            lengths[f.name] = int(declared[declared.index("(") + 1:-1])
        elif isinstance(f.dataType, (T.CharType, T.VarcharType)):
            lengths[f.name] = f.dataType.length
    return required, lengths


def _value_reason(batch: DataFrame, schema: T.StructType, required: Sequence[str], lengths: Map[str, int]) -> Column:
    """``type``, ``null`` or ``length`` for a row the table would refuse on its own; NULL for a good row."""
    typed = {f.name.upper(): f for f in schema.fields}
    bad_type, bad_null, bad_length = [], [], []
    for name in batch.columns:
        f = typed.get(name.upper())
        if f is None:
            continue
        value = F.col(f"`{name}`")
        if batch.schema[name].dataType != f.dataType:
            bad_type.append(value.isNotNull() & value.try_cast(f.dataType).isNull())
        if f.name in lengths:
            bad_length.append(F.coalesce(F.length(value.cast("string")) > lengths[f.name], F.lit(False)))
    for name in required:
        have = resolve(batch, name)
        bad_null.append(F.col(f"`{have}`").isNull() if have in batch.columns else F.lit(True))
    reasons = [(bad_type, "type"), (bad_null, "null"), (bad_length, "length")]
    checks = [F.when(reduce(Column.__or__, tests), F.lit(name)) for tests, name in reasons if tests]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def mark_rejects(batch: DataFrame, schema: T.StructType, primary_key: Sequence[str] = (),
                 order_by: Sequence[str] = ("_row",), existing: DataFrame | None = None,
                 required: Sequence[str] | None = None, lengths: Map[str, int] | None = None) -> DataFrame:
    """Add ``_reason``: why the table would refuse the row, or NULL.

    Of several good rows with one primary key, the first in ``order_by`` order wins unless the table already
    has the key. ``order_by`` may repeat over keys (row numbers of several files) but has to tell apart the rows of one
    key. The winner per key comes from a partial aggregate, and is joined back on the key with the row identity, so a hot
    key never gathers its rows in one task.
    """
    declared_required, declared_lengths = limits_of(schema)
    required = declared_required if required is None else required
    lengths = declared_lengths if lengths is None else lengths
    marked = batch.withColumn(REASON, _value_reason(batch, schema, [*required, *primary_key], lengths))
    if not primary_key:
        return marked
    keys = {f"_k{i}": F.col(f"`{resolve(batch, c)}`").cast("string") for i, c in enumerate(primary_key)}
    identity = F.struct(*[F.col(f"`{c}`") for c in order_by])
    marked = marked.withColumns(keys).withColumn("_id", identity)
    winners = marked.filter(F.col(REASON).isNull()).groupBy(*keys).agg(F.min("_id").alias("_id"))
    if existing is not None:
        held = existing.select(*[F.col(f"`{resolve(existing, c)}`").cast("string").alias(k) for k, c in zip(keys, primary_key)])
        winners = winners.join(held, list(keys), "left_anti")
    place = F.struct(*keys, "_id").cast("string")  # differs from what the winners were grouped on: both sides can be split
    flagged = marked.withColumn("_at", place).join(winners.select(place.alias("_at"), F.lit(True).alias("_wins")), "_at", "left")
    reason = F.coalesce(F.col(REASON), F.when(F.col("_wins").isNull(), F.lit("key")))
    return flagged.withColumn(REASON, reason).select(*[f"`{c}`" for c in batch.columns], REASON)


def accepted(marked: DataFrame, schema: T.StructType) -> DataFrame:
    return conform(marked.filter(F.col(REASON).isNull()), schema)


def rejected(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNotNull())


def reject_rows(marked: DataFrame, identity: Sequence[str], job: str, target: str, day: dt.date | str) -> DataFrame:
    """Refused rows as ``JOB, TABLE_NAME, ROW_KEY, REASON, ROW_VALUES, TIMESTAMP``: where the row came from, why it is
    refused, and its mapped values as JSON text."""
    own = [c for c in marked.columns if c not in identity and c != REASON]
    as_text = lambda columns: F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    return rejected(marked).select(
        F.lit(job).alias("JOB"), F.lit(target).alias("TABLE_NAME"), as_text(identity).alias("ROW_KEY"), F.col(REASON).alias("REASON"),
        as_text(own).alias("ROW_VALUES"), F.lit(as_date(day)).cast("timestamp").alias("TIMESTAMP"))


def _text_id(df: DataFrame, column: str) -> Column:
    return F.col(f"`{resolve(df, column)}`").cast("string")


def _held_ids(keyed: DataFrame, current: DataFrame, batch_id: str, table_id: str) -> DataFrame:
    """Distinct ids of the table, without most of those that no batch row has."""
    table_id = resolve(current, table_id)
    near = among(current.select(F.col(f"`{table_id}`")), _text_id(current, table_id), text_ids(keyed, batch_id))
    return text_ids(near, table_id)


def new_rows(batch: DataFrame, current: DataFrame, batch_id: str, table_id: str = "ID") -> DataFrame:
    """Batch rows with a non-null id the table does not hold. Repeated new ids all stay."""
    keyed = batch.filter(F.col(f"`{batch_id}`").isNotNull())
    return probe(keyed, _held_ids(keyed, current, batch_id, table_id), _text_id(keyed, batch_id), "_id", "left_anti")


def held_places(current: DataFrame, ids: DataFrame, id_column: str, partitions: Sequence[str]) -> DataFrame:
    """``_id`` and, as text, ``_p0, _p1, ...``: the partitions in which the table holds each of the distinct text ``ids``.

    One scan that reads the id and the partition columns; rows that cannot match are dropped before the shuffle.
    """
    table_id = resolve(current, id_column)
    narrow = current.select(_text_id(current, table_id).alias("_id"), *[F.col(f"`{p}`").cast("string").alias(f"_p{i}") for i, p in enumerate(partitions)])
    near = among(narrow.filter(F.col("_id").isNotNull()), F.col("_id"), ids)
    return probe(near, ids, F.col("_id"), "_id", "left_semi").distinct()


def split_by_ids(batch: DataFrame, batch_id: str, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch rows with a non-null id: those whose id is not in ``held`` (text ``_id``), and those whose id is."""
    keyed = batch.filter(F.col(f"`{batch_id}`").isNotNull())
    ids = held.select("_id").distinct()
    return tuple(probe(keyed, ids, _text_id(keyed, batch_id), "_id", how) for how in ("left_anti", "left_semi"))


def updated_rows(current: DataFrame, batch: DataFrame, id_column: str = "ID",
                 order_by: Sequence[str] = ("_row",)) -> DataFrame:
    """The table with every mapped non-id column of a matching batch row taken over, NULLs included.

    ``batch`` carries table column names. The last batch row per id wins; unmapped columns keep their value.
    Both the batch side (one row per id after a partial aggregate) and the left-join shape let adaptive
    execution split a hot id of the table.
    """
    table_id = resolve(current, id_column)
    mapped = [c for c in current.columns if c != table_id and resolve(batch, c) in batch.columns]
    if not mapped:
        return current
    types = {f.name: f.dataType for f in current.schema.fields}
    values = F.struct(*[F.col(f"`{resolve(batch, c)}`").try_cast(types[c]).alias(c) for c in mapped])
    order = F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])
    last = (batch.select(_text_id(batch, id_column).alias("_id"), values.alias("_new"), order.alias("_order"))
            .filter("_id IS NOT NULL").groupBy("_id").agg(F.max_by("_new", "_order").alias("_new"))
            .withColumn("_hit", F.lit(True)))
    joined = probe(current, last, _text_id(current, table_id), "_id")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in mapped
        else F.col(f"`{c}`") for c in current.columns])


def upsert(current: DataFrame, batch: DataFrame, id_column: str = "ID", order_by: Sequence[str] = ("_row",)) -> DataFrame:
    """Existing ids updated, new ids inserted, null ids dropped."""
    fresh = new_rows(batch, current, resolve(batch, id_column), id_column)
    return updated_rows(current, batch, id_column, order_by).unionByName(conform(fresh, current.schema))
