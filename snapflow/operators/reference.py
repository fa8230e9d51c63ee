"""Checks against reference tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions.text import has_text
from snapflow.operators.clean import value_of
from snapflow.operators.joins import id_set, probe, text_ids
from snapflow.operators.snapshot import as_date, on_day
from snapflow.result import StepResult

LOG_FIELDS = ["WHERE_A", "A", "WHERE_B", "B", "CAUSE", "ACTION", "TIMESTAMP"]


def log_entry(where_a, a, where_b, b, cause, action, day: dt.date | str) -> Column:
    """One reject-log row as a struct."""
    values = [where_a, a, where_b, b, cause, action]
    texts = [v if isinstance(v, Column) else F.lit(v) for v in values]
    stamped = [*[t.cast("string") for t in texts], F.lit(as_date(day)).cast("timestamp")]
    return F.struct(*[v.alias(n) for v, n in zip(stamped, LOG_FIELDS)])


def row_id(df: DataFrame, id_column: str | None) -> Column:
    """Id text for log rows: ``?`` when no id column is named, ``null`` for a missing value."""
    if id_column is None:
        return F.lit("?")
    return F.coalesce(value_of(df, id_column).cast("string"), F.lit("null"))


def flag_reference(df: DataFrame, reference: DataFrame, field_column: str, day: dt.date | str,
                   reference_id: str = "ID", ts_column: str = "TIMESTAMP", id_column: str | None = None,
                   entity_type: str = "Unknown", log_column: str = "_reject") -> DataFrame:
    """Clear values that the day's reference ids do not hold and attach the log row as ``log_column``.

    Matching is case-sensitive and untrimmed. Several checks chain: each adds its own log column, and one
    pass over the settled frame then writes all of them.
    """
    ids = id_set(on_day(reference, ts_column, day), reference_id)
    value = value_of(df, field_column)
    text = value.cast("string")
    checked = probe(df, ids, F.when(has_text(text), text), "_id")
    bad = has_text(text) & F.col("_hit").isNull()
    entry = log_entry("Unknown", field_column, text, entity_type, row_id(df, id_column),
                      "loading data with empty value", day)
    if field_column not in df.columns:
        return checked.withColumn(log_column, F.when(F.lit(False), entry)).drop("_hit")
    empty = F.lit("") if isinstance(df.schema[field_column].dataType, T.StringType) else F.lit(None)
    kept = [F.when(bad, empty).otherwise(value).alias(c) if c == field_column else F.col(f"`{c}`") for c in df.columns]
    return checked.select(*kept, F.when(bad, entry).alias(log_column))


@dataclass(frozen=True)
class Check:
    """One reference check: values of ``field`` have to be ids that ``reference`` holds on the day."""

    field: str
    name: str
    reference: DataFrame
    reference_id: str = "ID"
    ts_column: str = "TIMESTAMP"
    id_column: str | None = None
    entity_type: str = "Unknown"
    log_column: str = "_reject"


def check_rounds(checks: Sequence[Check]) -> list[list[Check]]:
    """Checks that can run at once: a check sees what earlier ones cleared, so a column that one of them clears and another
    reads, as its field or in its log, starts a new round."""
    rounds: list[list[Check]] = []
    for c in checks:
        cleared = {x.field for x in rounds[-1]} if rounds else set()
        if not rounds or c.field in cleared or c.id_column in cleared:
            rounds.append([])
        rounds[-1].append(c)
    return rounds


def flag_references(df: DataFrame, checks: Sequence[Check], day: dt.date | str, uid: str = "_uid") -> DataFrame:
    """``flag_reference`` for the checks of one round in one join; ``uid`` tells the rows of ``df`` apart.

    The values to check become rows of (uid, check, value), which meet one set of ids: each table, id column and snapshot
    column is read once, however many checks use it. What is unknown comes back as the checks that failed per row. So the
    batch is shuffled twice, once by value and once by row.
    """
    source = lambda c: (c.name.lower(), c.reference_id, c.ts_column)
    sets = list(dict.fromkeys(source(c) for c in checks))
    read = {source(c): c for c in checks}
    ids = reduce(DataFrame.unionByName, [
        on_day(read[s].reference, s[2], day).select(F.concat(F.lit(f"{i}:"), F.col(f"`{s[1]}`").cast("string")).alias("_id")) for i, s in enumerate(sets)])
    texts = [value_of(df, c.field).cast("string") for c in checks]
    asked = F.array(*[F.when(has_text(t), F.struct(F.lit(j).alias("check"), F.concat(F.lit(f"{sets.index(source(c))}:"), t).alias("key")))
                      for j, (c, t) in enumerate(zip(checks, texts))])
    melted = df.select(F.col(uid).alias("_of"), F.explode(F.filter(asked, lambda a: a.isNotNull())).alias("a")).select("_of", "a.*")
    unknown = probe(melted, text_ids(ids, "_id", "_id"), F.col("key"), "_id", "left_anti")
    failed = unknown.groupBy("_of").agg(F.collect_set("check").alias("_failed"))
    joined = df.join(failed, df[uid] == failed["_of"], "left").drop("_of")
    out, bad = {c: F.col(f"`{c}`") for c in df.columns}, []
    for j, (c, text) in enumerate(zip(checks, texts)):
        wrong = F.coalesce(F.array_contains("_failed", j), F.lit(False))
        entry = log_entry("Unknown", c.field, text, c.entity_type, row_id(df, c.id_column), "loading data with empty value", day)
        bad.append(F.when(wrong, entry).alias(c.log_column))
        if c.field in df.columns:
            empty = F.lit("") if isinstance(df.schema[c.field].dataType, T.StringType) else F.lit(None)
            out[c.field] = F.when(wrong, empty).otherwise(out[c.field])
    return joined.select(*[v.alias(k) for k, v in out.items()], *bad)


def log_rows(df: DataFrame, log_columns: list[str]) -> DataFrame:
    """All attached log rows, in one scan of the frame."""
    entries = F.filter(F.array(*log_columns), lambda e: e.isNotNull())
    return df.select(F.inline(entries))


def validate_reference(df: DataFrame, reference: DataFrame, field_column: str, day: dt.date | str, **options) -> StepResult:
    """Cleaned rows plus their log. Both outputs read one joined frame: settle it before writing both."""
    flagged = flag_reference(df, reference, field_column, day, **options)
    name = options.get("log_column", "_reject")
    return StepResult(flagged.drop(name), outputs={"log": log_rows(flagged, [name])})


def check_query(spark: SparkSession, query: str = "SELECT 1") -> object:
    """Run a gate query that must give exactly one row with one column."""
    answer = spark.sql(query)
    if len(answer.columns) != 1:
        raise ValueError(f"check query must return one column, got {len(answer.columns)}")
    rows = answer.take(2)
    if len(rows) != 1:
        raise ValueError(f"check query must return one row, got {'several' if rows else 'none'}")
    return rows[0][0]
