"""Row transformations. Each takes a frame and returns a ``StepResult``.

A step whose required parameters are missing warns and passes the rows through unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions.text import concat_nonblank, has_text, jtrim
from snapflow.operators.joins import probe
from snapflow.operators.snapshot import latest
from snapflow.result import StepResult


def on_text_columns(df: DataFrame, rule) -> DataFrame:
    """Apply ``rule`` to every text column in one projection; other types are untouched."""
    return df.select(*[rule(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def trim(df: DataFrame) -> StepResult:
    return StepResult(on_text_columns(df, jtrim))


def uppercase(df: DataFrame) -> StepResult:
    return StepResult(on_text_columns(df, F.upper))


def value_of(df: DataFrame, column: str) -> Column:
    """A column, or NULL when the batch has no such column (an absent key reads as null)."""
    return F.col(f"`{column}`") if column in df.columns else F.lit(None).cast("string")


def concatenate(df: DataFrame, source_columns: Sequence[str] | None, target_column: str | None,
                separator: str = "") -> StepResult:
    if not source_columns or not target_column:
        return StepResult(df, warnings=["CONCATENATE needs 'sourceColumns' and 'targetColumn'"])
    joined = concat_nonblank([value_of(df, c) for c in source_columns], separator)
    return StepResult(df.withColumn(target_column, joined))


def deduplicate(df: DataFrame, key_column: str | None, order_by: Sequence[str] = ("_row",)) -> StepResult:
    """First row per key in ``order_by`` order; NULL counts as one key.

    ``row_number() = 1`` plans as a group limit on both sides of the exchange: each map task sends at
    most one row per key, so a hot key costs no more than any other.
    """
    if not key_column:
        return StepResult(df, warnings=["DEDUPLICATE needs 'keyColumn'"])
    seen, kept = Observation(), Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    window = Window.partitionBy(value_of(df, key_column)).orderBy(*[F.col(c) for c in order_by])
    first = counted.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    return StepResult(first.observe(kept, F.count(F.lit(1)).alias("rows")), counters={"in": seen, "out": kept})


def filter_null(df: DataFrame, column: str | None) -> StepResult:
    """Drop rows that are null or blank in ``column``; without such a column every row goes."""
    if not column:
        return StepResult(df, warnings=["FILTER_NULL needs 'column'"])
    counts, keep = Observation(), has_text(value_of(df, column))
    watched = df.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(keep).alias("kept"))
    return StepResult(watched.filter(keep), counters={"filter": counts})


def lookup(df: DataFrame, reference: DataFrame, source_column: str | None, target_column: str | None,
           key_column: str | None, value_column: str | None, ts_column: str | None = None,
           null_values: Sequence[str] = ()) -> StepResult:
    """Replace a value by what a reference table holds for it.

    The source is trimmed, sentinels are compared as written, the match ignores case, the reference key
    is not trimmed. Repeated reference keys resolve to the largest value.
    """
    if not (source_column and target_column and key_column and value_column):
        return StepResult(df, warnings=["LOOKUP needs sourceColumn, targetColumn, referenceTable, "
                                        "referenceKeyColumn and referenceValueColumn"])
    entries = (latest(reference, ts_column)
               .select(F.lower(F.col(key_column).cast("string")).alias("_ref_key"),
                       F.col(value_column).cast("string").alias("_ref_value"))
               .filter(F.col("_ref_key").isNotNull())
               .groupBy("_ref_key").agg(F.max("_ref_value").alias("_ref_value")))
    text = jtrim(value_of(df, source_column).cast("string"))
    wanted = has_text(text)
    if null_values:
        wanted = wanted & ~text.isin(list(null_values))
    key = F.when(wanted, F.lower(text))
    order = list(dict.fromkeys([*df.columns, target_column]))
    found = probe(df, entries, key, "_ref_key").withColumn(target_column, F.col("_ref_value"))
    counts = Observation()
    rows = found.select(*[f"`{c}`" for c in order]).observe(
        counts, F.count(F.col(f"`{target_column}`")).alias("resolved"), F.count(F.lit(1)).alias("rows"))
    return StepResult(rows, counters={"lookup": counts})
