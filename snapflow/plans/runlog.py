"""Run log and run summary as DataFrames.

``LOG``: one line per message of a job, task or step. ``JOBS``, ``TASKS``, ``STEPS``: one line each.
``COUNTERS``: one line per counter of a step.
Frames may hold the history of many runs; every function takes the columns that identify one run or job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.text import jtrim

LOG = "run string, job string, task string, step string, timestamp timestamp, level string, source string, message string"
TASKS = "run string, job string, task string, status string, processed long, failed long"
STEPS = "run string, job string, task string, step string, type string, status string, start_time timestamp, end_time timestamp"
COUNTERS = "run string, job string, task string, step string, type string, counter string, value long"
JOBS = ("run string, job string, file_path string, file_type string, status string, start_time timestamp, "
        "end_time timestamp, processed long, failed long, skipped long, errors long, warnings long")

# Worst first.
STATUS_PRIORITY = ["FAILED", "PARTIAL", "SUCCESS", "SKIPPED", "RUNNING", "PENDING"]
SHEET_NAME_LIMIT = 31  # characters of a sheet title


def job_status(tasks: DataFrame, by: Sequence[str] = ("run", "job")) -> DataFrame:
    """SUCCESS without a failed task, FAILED when every task failed, else PARTIAL."""
    failed = F.count_if(F.col("status") == "FAILED")
    status = F.when(failed == 0, "SUCCESS").when(failed == F.count(F.lit(1)), "FAILED").otherwise("PARTIAL")
    return tasks.groupBy(*by).agg(status.alias("status"))


def run_status(jobs: DataFrame, by: Sequence[str] = ("run",)) -> DataFrame:
    """SUCCESS when all jobs succeeded (or there are none), FAILED when all failed, else PARTIAL."""
    all_of = lambda v: F.coalesce(F.bool_and(F.col("status") == v), F.lit(v == "SUCCESS"))
    status = F.when(all_of("SUCCESS"), "SUCCESS").when(all_of("FAILED"), "FAILED").otherwise("PARTIAL")
    return jobs.groupBy(*by).agg(status.alias("status"))


def run_totals(jobs: DataFrame, by: Sequence[str] = ("run",)) -> DataFrame:
    """Jobs by status, summed counters and the share of successful jobs in percent."""
    total, ok = F.count(F.lit(1)), F.count_if(F.col("status") == "SUCCESS")
    summed = [F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("processed", "failed", "skipped", "errors", "warnings")]
    return jobs.groupBy(*by).agg(
        total.alias("total_jobs"), ok.alias("successful_jobs"), F.count_if(F.col("status") == "FAILED").alias("failed_jobs"),
        F.count_if(F.col("status") == "PARTIAL").alias("partial_jobs"), *summed,
        F.when(total > 0, ok / total * 100.0).otherwise(0.0).alias("success_rate"))


def _millis(start: Column | str, end: Column | str) -> Column:
    at = lambda c: F.unix_millis((F.col(c) if isinstance(c, str) else c).cast("timestamp"))
    return at(end) - at(start)


def run_bounds(jobs: DataFrame, by: Sequence[str] = ("run",)) -> DataFrame:
    """First start, last end and the time between; a run without any start or end counts as now."""
    bounds = jobs.groupBy(*by).agg(F.coalesce(F.min("start_time"), F.current_timestamp()).alias("start_time"),
                                   F.coalesce(F.max("end_time"), F.current_timestamp()).alias("end_time"))
    return bounds.withColumn("duration_ms", _millis("start_time", "end_time"))


def messages(log: DataFrame, level: str, job_level_only: bool = True) -> DataFrame:
    """Entries of one level; by default only those a job itself wrote, not its tasks or steps."""
    kept = log.filter(F.col("level") == level)
    return kept.filter(F.col("task").isNull() & F.col("step").isNull()) if job_level_only else kept


def job_summary(jobs: DataFrame, by: Sequence[str] = ("run", "job")) -> DataFrame:
    """Per job its status, duration in milliseconds and counters. The messages behind the error count are
    ``messages(log, "ERROR")``, kept as rows: a list per job could outgrow one task."""
    return jobs.select(*by, "file_path", "file_type", "status",
                       F.coalesce(_millis("start_time", "end_time"), F.lit(0)).alias("duration_ms"),
                       "processed", "failed", "skipped", "errors")


def message_counts(log: DataFrame, by: Sequence[str] = ("run", "job")) -> DataFrame:
    """Error and warning counts of job-level entries."""
    own = log.filter(F.col("task").isNull() & F.col("step").isNull())
    return own.groupBy(*by).agg(F.count_if(F.col("level") == "ERROR").alias("errors"),
                                F.count_if(F.col("level") == "WARN").alias("warnings"))


def execution_log(log: DataFrame) -> DataFrame:
    """TIMESTAMP, SEVERITY, STEP, MESSAGE of all entries, by time. The other columns only break ties, which
    also lets the range partitioning split a burst of entries with one timestamp."""
    table = log.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("TIMESTAMP"), F.col("level").alias("SEVERITY"),
                       F.coalesce("source", F.lit("")).alias("STEP"), F.coalesce("message", F.lit("")).alias("MESSAGE"),
                       F.col("timestamp").alias("_at"))
    return table.orderBy("_at", "STEP", "MESSAGE", "SEVERITY").drop("_at")


def dataset_group(job: Column | str) -> Column:
    """Job name without its language suffix."""
    name = F.col(job) if isinstance(job, str) else job
    return jtrim(F.regexp_replace(name, r"(?i)[-_](es|en|fr|de|it|pt)$", ""))


def sheet_title(dataset: Column | str) -> Column:
    """A dataset's name as a sheet title; for display, as two names may share one."""
    return F.substring(dataset, 1, SHEET_NAME_LIMIT)


def log_by_dataset(log: DataFrame) -> DataFrame:
    """The log with its dataset group; write it ``partitionBy("dataset")`` for one folder per group."""
    return log.withColumn("dataset", dataset_group("job"))


def worst_status(jobs: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Worst status per group, as a minimum over ranks: a partial aggregate over integers."""
    ranks = F.create_map(*[F.lit(v) for pair in zip(STATUS_PRIORITY, range(len(STATUS_PRIORITY))) for v in pair])
    names = F.array(*[F.lit(s) for s in STATUS_PRIORITY])
    ranked = jobs.select(*by, F.coalesce(F.try_element_at(ranks, F.col("status")), F.lit(len(STATUS_PRIORITY) - 1)).alias("_rank"))
    return ranked.groupBy(*by).agg(F.min("_rank").alias("_rank")).select(*by, F.get(names, F.col("_rank")).alias("status"))


def summary_csv(jobs: DataFrame) -> DataFrame:
    """The seven columns of the CSV summary, under their headings."""
    s = job_summary(jobs)
    return s.select(F.col("job").alias("Job Name"), F.col("file_path").alias("File Path"), F.col("file_type").alias("File Type"),
                    F.col("status").alias("Status"), F.col("duration_ms").alias("Duration (ms)"),
                    F.col("processed").alias("Records Processed"), F.col("failed").alias("Records Failed"))


def write_summary_csv(jobs: DataFrame, path: str) -> None:
    """Header line, UTF-8; values are quoted only where they need it."""
    summary_csv(jobs).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
