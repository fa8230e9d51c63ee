"""Session helpers: shared scratch folder, lineage cuts, adaptive-execution settings."""

from __future__ import annotations

import tempfile
import threading
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Adaptive execution splits hot join partitions and re-plans small sides; the operators rely on it.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# For the thread to fetch an answer that is already there.
ANSWER_SECONDS = 10.0


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors. The cluster's own setting always wins.

    Only a local-mode session (tests, notebooks) gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="snapflow-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, scratch: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Compute a frame once and cut its lineage: written to the shared folder and read back.

    Used where several writes read one frame and where an iterative plan would grow. The rows sit in shared
    storage, so a lost executor neither recomputes nor changes them; being columnar, each reader only scans the
    columns it needs, and Spark knows the size. ``scratch`` collects the path for ``discard``. ``by`` names columns whose
    values get a folder each, so that a reader of one value opens its files only; they come last in the frame.
    """
    path = shared_path(df.sparkSession, "settled")
    df.write.parquet(path, partitionBy=list(by) or None)
    if scratch is not None:
        scratch.append(path)
    fields = sorted(df.schema.fields, key=lambda f: f.name in by)
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Files and folders right below a folder."""
    target, fs = _path(spark, folder)
    return [status.getPath().toString() for status in fs.listStatus(target)]


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Delete settled frames that nothing reads any more."""
    for path in scratch:
        delete(spark, path)
    scratch.clear()


def file_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def small_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few driver-side rows (spec or log lines) as a local relation, without starting Python workers."""
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) or [()] * len(schema.fields)
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema)


def observed(observation: Observation) -> dict:
    """Counters of an observation whose action has finished.

    An answer arrives with the action's own event, so all events sent so far are waited for, however late the
    listeners are; a queue that does not drain within a day is an error. Once the events are through, an observation
    without an answer was optimised away: its plan was reduced to nothing, or a custom step threw its frame away.
    Only then the counters are empty.
    """
    SparkSession.active().sparkContext._jsc.sc().listenerBus().waitUntilEmpty(86_400_000)
    found: dict = {}
    broken: list[Exception] = []

    def ask() -> None:
        try:
            found.update(observation.get)
        except Exception as e:  # noqa: BLE001 - handed to the caller below
            broken.append(e)

    asking = threading.Thread(target=ask, daemon=True)  # asking for a lost observation never ends
    asking.start()
    asking.join(ANSWER_SECONDS)
    if broken:
        raise broken[0]
    return dict(found)
