import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "6g").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(home / "warehouse"))
               .config("spark.checkpoint.dir", str(home / "checkpoints")).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Create a table with a fresh name: ``table("ID STRING, TS TIMESTAMP", "TS")``."""
    made = []

    def create(columns, partition=None, name=None, properties=""):
        name = name or f"t_{uuid.uuid4().hex[:10]}"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet "
                  + (f"PARTITIONED BY ({partition}) " if partition else "") + properties)
        made.append(name)
        return name

    yield create
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def values(df, *columns):
    """Rows as sorted tuples, NULL first."""
    rows = [tuple(r) for r in df.select(*columns or df.columns).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])
