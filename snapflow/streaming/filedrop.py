"""Incremental ingestion: newly dropped files run through the same job, one job per day."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions.files import file_name, ingest_date
from snapflow.plans.job import JobResult, run_job
from snapflow.plans.parallel import at_once
from snapflow.session import delete, discard, file_exists, list_files, settled, small_frame
from snapflow.sources.workbook import read_workbook
from snapflow.sources.xmlrows import read_xml

LEDGER = "path STRING, modified TIMESTAMP, day DATE, status STRING, failed_tasks ARRAY<STRING>, at TIMESTAMP"
LISTING = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
DONE = ("SUCCESS", "SUPERSEDED")
COMPACT_FILES = 32  # ledger files that are written into one
ARRIVED = "_arrived"
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


def read_drop(spark: SparkSession, path: str, file_format: str, spec: dict, schema: T.StructType | None, **options: str) -> DataFrame:
    """Rows of one dropped file, with a ``_row`` order where the format has one."""
    return read_drops(spark, [path], file_format, spec, schema, **options).drop(ARRIVED)


def read_drops(spark: SparkSession, paths: Sequence[str], file_format: str, spec: dict, schema: T.StructType | None, **options: str) -> DataFrame:
    """Rows of dropped files, with their order: ``_arrived``, ``_file`` where several are read, ``_row``.

    Files of Spark's own formats are one scan, however many they are.
    """
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]  # a file name is not a pattern
    if file_format in ("workbook", "xml"):
        def one(place: int) -> DataFrame:
            if file_format == "workbook":
                rows = read_workbook(spark, paths[place], schema, sheet_index=max(0, spec.get("sheetIndex", 0)))
            else:
                rows = read_xml(spark, literal[place], (spec.get("parameters") or {}).get("rowTag"), schema).withColumn("_row", F.monotonically_increasing_id())
            return rows.withColumn(ARRIVED, F.lit(place))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, range(len(paths))))
    reader = spark.read.format(file_format).options(**options)
    rows = (reader.schema(schema) if schema else reader).load(literal)
    number = F.col("_metadata.row_index") if file_format == "parquet" else F.monotonically_increasing_id()
    rows = rows.withColumns({"_row": number, ARRIVED: F.col("_metadata.file_modification_time")})
    return rows.withColumn("_file", F.col("_metadata.file_name")) if len(paths) > 1 and "_file" not in rows.columns else rows


# ---------------------------------------------------------------- the ledger


def _ledger(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-outcomes"


def _versions(spark: SparkSession, ledger: str) -> list[str]:
    """Complete versions of the ledger, oldest first."""
    found = sorted((int(re.search(r"v(\d+)$", f).group(1)), f) for f in list_files(spark, ledger) if re.search(r"/v\d+$", f))
    return [f for _, f in found if file_exists(spark, f"{f}/_SUCCESS")]


def _newest(lines: DataFrame) -> DataFrame:
    return lines.groupBy("path").agg(F.max_by(F.struct(*[c for c in lines.columns if c != "path"]), "at").alias("o")).select("path", "o.*")


def outcomes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Newest recorded outcome of each dropped file: ``path, modified, day, status, failed_tasks, at``.

    A file is through with ``SUCCESS``, or with ``SUPERSEDED`` where a later dump of its day was loaded in its place.
    """
    return _newest(spark.read.schema(LEDGER).parquet(_versions(spark, _ledger(checkpoint))[-1]))


def _record(spark: SparkSession, checkpoint: str, lines: DataFrame) -> None:
    """Append outcomes in one write. A ledger of many files is written into one, which is used once it is complete."""
    current = _versions(spark, _ledger(checkpoint))[-1]
    lines.coalesce(1).write.mode("append").parquet(current)
    if sum(f.endswith(".parquet") for f in list_files(spark, current)) > COMPACT_FILES:
        number = int(current.rsplit("/v", 1)[1])
        following = f"{_ledger(checkpoint)}/v{number + 1}"
        delete(spark, following)  # left by a call that broke off
        _newest(spark.read.schema(LEDGER).parquet(current)).coalesce(1).write.parquet(following)
        delete(spark, current)


# ---------------------------------------------------------------- days


def _truncates(spec: dict) -> list[dict]:
    steps = [(t, s) for t in spec.get("tasks") or [] for s in t.get("subtasks") or []]
    return [{**(spec.get("parameters") or {}), **(t.get("parameters") or {}), **(s.get("parameters") or {})} for t, s in steps if s["type"].upper() == "TRUNCATE"]


def _open(found: DataFrame, known: DataFrame, replaces: bool) -> DataFrame:
    """``path, modified, day`` of the files that are still to be loaded, by a join with the ledger.

    A file counts as known with its modification time. One that is not through is tried again, unless the job replaces
    a day and a later dump of its day is loaded.
    """
    told = known.select("path", F.col("modified").alias("_modified"), "status")
    rows = found.join(told, "path", "left").filter(
        F.col("_modified").isNull() | (F.col("_modified") != F.col("modified")) | ~F.col("status").isin(*DONE))
    if replaces:
        loaded = known.filter(F.col("status") == "SUCCESS").groupBy("day").agg(F.max("modified").alias("_loaded"))
        rows = rows.join(loaded, "day", "left").filter(
            F.col("_loaded").isNull() | (F.col("modified") >= F.col("_loaded")) | F.col("_modified").isNull() | (F.col("_modified") != F.col("modified")))
    return rows.select("path", "modified", "day").distinct()


def ingest_drops(spark: SparkSession, spec: dict, drop_dir: str, checkpoint: str, file_format: str = "parquet",
                 schema: T.StructType | None = None, order_by: tuple[str, ...] = ("_row",), max_files: int | None = None,
                 parallel: int = 1, **options: str) -> list[JobResult]:
    """Load the files that arrived since the last call, and those that are not through yet; one job result per job run.

    The stream only discovers files, and its checkpoint remembers them; contents are not read by it. A file is one dump and
    its name gives the ingest day. All new files of a day are one job: where the spec clears its day or table first, the dump that
    arrived last is what the day holds, so that one is loaded (the one before it if nothing of it could be) and earlier ones
    are recorded as superseded; any other spec gets the rows of all of them in one batch, ordered by arrival, file and
    row. If such a batch fails as a whole, its files run one by one, so that a broken file does not hold up the rest.

    Days run in order, or up to ``parallel`` at once where the spec replaces nothing but its day. The outcome of every
    file is recorded beside the checkpoint, once per batch (see ``outcomes``). Only a job that ends as SUCCESS has loaded its
    files; after FAILED or PARTIAL they are tried again by the next call, unless a later dump of their day has been loaded
    meanwhile. A batch that is replayed after a crash passes over the files that are recorded as loaded, so their log and
    edge rows are not written twice. Known files stay in the ledger and are joined there; the driver holds the names of a
    day's new files at a time.
    """
    if not (file_exists(spark, _ledger(checkpoint)) and _versions(spark, _ledger(checkpoint))):
        small_frame(spark, [], LEDGER).write.mode("overwrite").parquet(f"{_ledger(checkpoint)}/v0")
    results: list[JobResult] = []
    clears = _truncates(spec)
    apart = bool(clears) and all(c.get("timestampColumn") for c in clears)

    def attempt(day: dt.date, some: list[tuple[str, int]]) -> JobResult:
        paths = [p for p, _ in some]
        try:
            rows = read_drops(spark, paths, file_format, spec, schema, **options)
        except Exception as e:  # noqa: BLE001 - an unreadable file is an outcome
            now = dt.datetime.now(dt.UTC)
            return JobResult(spec["name"], "FAILED", paths[0], spec.get("fileType", "EXCEL").upper(), now, now,
                             [(spec["name"], None, None, now, "ERROR", spec["name"], f"no batch: {e}")], [], [])
        if len(paths) == 1:
            return run_job(spark, spec, rows.drop(ARRIVED), day, order_by, paths[0])
        order = (ARRIVED, *[c for c in ("_file",) if c in rows.columns], *order_by)
        return run_job(spark, spec, rows, day, order, f"{len(paths)} files from {paths[0]}")

    def run_day(day: dt.date, files: list[tuple[str, int]]) -> tuple[list[JobResult], list[tuple]]:
        """Job results of a day and the ledger lines of its files, which come in order of arrival."""
        done: list[JobResult] = []
        lines: list[tuple] = []

        def note(some: list[tuple[str, int]], status: str, failed: list[str]) -> None:
            lines.extend((p, EPOCH + dt.timedelta(microseconds=m), day, status, failed, dt.datetime.now(dt.UTC)) for p, m in some)

        def run(some: list[tuple[str, int]]) -> JobResult:
            done.append(attempt(day, some))
            return done[-1]

        def told(some: list[tuple[str, int]], result: JobResult) -> None:
            note(some, result.status, [t[1] for t in result.tasks if t[2] == "FAILED"])

        if clears:  # the last dump that can be loaded is what the day holds
            for place in reversed(range(len(files))):
                result = run([files[place]])
                told([files[place]], result)
                if result.status == "SUCCESS":
                    note(files[:place], "SUPERSEDED", [])
                    break
                if result.processed:  # it has written rows, which an older dump must not replace
                    note(files[:place], "PENDING", [])
                    break
        else:
            result = run(files)
            if result.status == "FAILED" and len(files) > 1:
                for f in files:
                    told([f], run([f]))
            else:
                told(files, result)
        return done, lines

    def load(found: DataFrame) -> None:
        scratch: list[str] = []
        todo = settled(_open(found, outcomes(spark, checkpoint), bool(clears)), scratch, by=("day",))
        days = sorted(r["day"] for r in todo.select("day").distinct().collect())

        def one(day: dt.date) -> tuple[list[JobResult], list[tuple]]:
            files = todo.filter(F.col("day") == F.lit(day)).select("path", F.unix_micros("modified").alias("at")).collect()  # names of a day's new files
            return run_day(day, sorted(((r["path"], r["at"]) for r in files), key=lambda f: (f[1], f[0].rsplit("/", 1)[-1], f[0])))

        answers = at_once(spark, one, days, parallel if apart else 1)
        lines = [line for _, some in answers for line in some]
        if lines:
            _record(spark, checkpoint, small_frame(spark, lines, LEDGER))
        results.extend(r for done, _ in answers for r in done)
        discard(spark, scratch)

    load(outcomes(spark, checkpoint).filter(~F.col("status").isin(*DONE)).select("path", "modified", "day"))
    listing = spark.readStream.format("binaryFile").schema(LISTING)
    if max_files:
        listing = listing.option("maxFilesPerTrigger", max_files)

    def each(batch: DataFrame, _epoch: int) -> None:
        load(batch.select("path", F.col("modificationTime").alias("modified"), ingest_date(file_name("path")).alias("day")))

    query = (listing.load(drop_dir).select("path", "modificationTime").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return results

