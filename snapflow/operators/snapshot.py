"""Day-snapshot reads and writes.

A snapshot table is partitioned by its snapshot column (DATE or TIMESTAMP at midnight), alone or among other columns, so
a day filter prunes to the day's partitions and replacing a day rewrites those only.

Overwrites run in a session of their own, with the overwrite mode they need, over rows that are already written: the
caller's settings stay as they are, a batch that cannot be computed leaves the table alone, and new files replace old
ones when the write commits. Writes to one table take turns within a process; different tables are written at once.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.session import discard, empty_frame, settled, small_frame

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


def as_date(day: dt.date | str) -> dt.date:
    if isinstance(day, dt.datetime):
        return day.date()
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def day_value(df: DataFrame, ts_column: str, day: dt.date | str) -> Column:
    """The day as a literal of the column's own type, which keeps the filter prunable."""
    literal = F.lit(as_date(day))
    return literal.cast(df.schema[resolve(df, ts_column)].dataType)


def resolve(df: DataFrame, column: str) -> str:
    """The frame's spelling of a column name; unknown names come back unchanged."""
    if column in df.columns:
        return column
    return next((c for c in df.columns if c.lower() == column.lower()), column)


def on_day(df: DataFrame, ts_column: str, day: dt.date | str) -> DataFrame:
    """Rows of one snapshot day."""
    return df.filter(F.col(ts_column) == day_value(df, ts_column, day))


def latest(df: DataFrame, ts_column: str | None) -> DataFrame:
    """Rows of the newest snapshot of the whole table; without a snapshot column, every row."""
    if ts_column is None:
        return df
    newest = df.select(F.max(ts_column)).scalar()
    return df.filter(F.col(ts_column) == newest)


def replace_day(current: DataFrame, batch: DataFrame, ts_column: str, day: dt.date | str) -> DataFrame:
    """``current`` with the day's rows replaced by ``batch``; an empty batch still clears the day.
    Rows without a snapshot value belong to no day and stay."""
    kept = current.filter(~F.col(ts_column).eqNullSafe(day_value(current, ts_column, day)))
    return kept.unionByName(batch)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def full_name(spark: SparkSession, table: str) -> str:
    """Database and table in lower case, the same for every spelling."""
    name = table.replace("`", "").lower()
    return name if "." in name else f"{spark.catalog.currentDatabase().lower()}.{name}"


def writing(spark: SparkSession, table: str) -> threading.RLock:
    """The lock of a table: one write to it at a time, because file commits to one folder disturb each other."""
    return _LOCKS[full_name(spark, table)]


def _session(spark: SparkSession, mode: str) -> SparkSession:
    """A session with the caller's settings but its own overwrite mode."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(OVERWRITE_MODE, mode)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def _overwrite(spark: SparkSession, table: str, path: str, mode: str) -> None:
    """Overwrite the whole table (``static``) or the partitions in the rows (``dynamic``) with the frame written at ``path``."""
    own, target = _session(spark, mode), spark.table(table)
    rows = own.read.schema(target.schema).parquet(path)
    rows.select(*[f"`{c}`" for c in target.columns]).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)  # the caller's session still lists the old files


def _literal(text: str | None, kind: T.DataType) -> str:
    """A partition value as a SQL constant."""
    if text is None:
        return "NULL"
    quoted = "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    prefix = {T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP_NTZ"}.get(type(kind), "")
    return text if isinstance(kind, (T.NumericType, T.BooleanType)) else prefix + quoted


def clear_partitions(spark: SparkSession, table: str, values: dict[str, str | None]) -> None:
    """Remove the rows under leading partition values, given as text: one command, nothing else is touched."""
    target = spark.table(table)
    given = ", ".join(f"`{c}` = {_literal(v, target.schema[c].dataType)}" for c, v in values.items())
    open_ones = [c for c in partition_columns(spark, table) if c not in values]
    spec = ", ".join([given, *[f"`{c}`" for c in open_ones]])
    rest = [f.name for f in target.schema.fields if f.name not in values]
    own = _session(spark, "static")
    nothing = empty_frame(own, T.StructType([target.schema[c] for c in rest]))
    with writing(spark, table):
        own.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {{nothing}}", nothing=nothing)
        spark.catalog.refreshTable(table)


def _places(rows: DataFrame, partitions: Sequence[str]) -> set[tuple]:
    """The partition values that occur, as text: bounded by the number of partitions."""
    return {tuple(r) for r in rows.select(*[F.col(f"`{p}`").cast("string") for p in partitions]).distinct().collect()}


def overwrite_day(spark: SparkSession, table: str, batch: DataFrame, ts_column: str, day: dt.date | str) -> None:
    """Replace the day's rows by ``batch``, whatever day its rows carry; an empty batch clears the day.

    A table partitioned by its snapshot column, alone or among others, keeps all other files: the day's partitions that the
    batch fills are swapped in one overwrite, which only takes effect when all new files are written, and those it leaves
    empty are cleared after it. So the day is never empty in between, and a failing batch leaves it as it was. Any other table
    is written as a whole, in one overwrite too. A replay gives the same table.
    """
    target = spark.table(table)
    ts_name, partitions = resolve(target, ts_column), partition_columns(spark, table)
    stamp = day_value(target, ts_name, day)
    stamped = batch.select(*[stamp.alias(c) if c == ts_name else F.col(f"`{resolve(batch, c)}`") for c in target.columns])
    if ts_name not in partitions:
        replace_all(spark, table, replace_day(target, stamped, ts_name, day))
        return
    scratch: list[str] = []
    rows, only = settled(stamped, scratch), {ts_name: as_date(day).isoformat()}
    with writing(spark, table):
        if rows.isEmpty():
            if partitions[0] == ts_name:
                clear_partitions(spark, table, only)
            else:
                _clear_each(spark, table, partitions, _places(on_day(target, ts_name, day), partitions))
        else:
            stale = _places(on_day(target, ts_name, day), partitions) - _places(rows, partitions) if len(partitions) > 1 else set()
            _overwrite(spark, table, scratch[0], "dynamic")
            _clear_each(spark, table, partitions, stale)
    discard(spark, scratch)


def _clear_each(spark: SparkSession, table: str, partitions: Sequence[str], places: set[tuple]) -> None:
    for place in sorted(places, key=str):
        clear_partitions(spark, table, dict(zip(partitions, place)))


def clear_day(spark: SparkSession, table: str, ts_column: str, day: dt.date | str) -> None:
    """Delete the day's rows of a table."""
    overwrite_day(spark, table, empty_frame(spark, spark.table(table).schema), ts_column, day)


def append(spark: SparkSession, table: str, batch: DataFrame) -> None:
    """Append by column name, in the table's order."""
    with writing(spark, table):
        batch.select(*[f"`{c}`" for c in spark.table(table).columns]).write.insertInto(table)


def replace_partitions(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Overwrite the partitions that ``rows`` has, and no others."""
    scratch: list[str] = []
    settled(rows, scratch)
    with writing(spark, table):
        _overwrite(spark, table, scratch[0], "dynamic")
    discard(spark, scratch)


def replace_all(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Overwrite a table with rows that may be computed from it.

    They are written beside it first. Should the swap itself break off, the error names that folder, which then holds the
    one full copy.
    """
    scratch: list[str] = []
    settled(rows, scratch)
    with writing(spark, table):
        try:
            _overwrite(spark, table, scratch[0], "static")
        except Exception as e:
            raise RuntimeError(f"{table} was being replaced and may be incomplete; all its rows are in {scratch[0]}") from e
    discard(spark, scratch)


def clear_all(spark: SparkSession, table: str) -> None:
    """Empty a table, managed or external."""
    replace_all(spark, table, empty_frame(spark, spark.table(table).schema))


def within(rows: DataFrame, places: set[tuple], partitions: Sequence[str]) -> DataFrame:
    """Rows of the given partitions. The values are constants, so a scan of a table reads these partitions only."""
    def among(column: str, values: set) -> Column:
        kind = rows.schema[column].dataType
        known = F.col(f"`{column}`").isin([F.lit(v).cast(kind) for v in sorted(v for v in values if v is not None)])
        return known | F.col(f"`{column}`").isNull() if None in values else known

    columns = [among(c, {p[i] for p in places}) for i, c in enumerate(partitions)]
    kept = rows.filter(reduce(Column.__and__, columns, F.lit(bool(places))))
    if len(partitions) > 1 and places:  # not every combination of these values; one line per partition
        listed = small_frame(rows.sparkSession, sorted(places, key=str), ", ".join(f"_p{i} string" for i in range(len(partitions))))
        same = [F.col(f"`{c}`").cast("string").eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(partitions)]
        kept = kept.join(F.broadcast(listed), reduce(Column.__and__, same), "left_semi")
    return kept
