"""Plan shapes and hot keys."""

import contextlib

import pytest
from conftest import values
from pyspark.sql import functions as F

from snapflow.operators import clean, link, load, reference, snapshot
from snapflow.operators.joins import probe

DAY = "2026-03-02"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


TINY_SKEW = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
             "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB", "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
             "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB", "spark__sql__shuffle__partitions": "8"}


@pytest.fixture
def hot(spark):
    """20,000 rows in 8 map tasks; a third share one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(0, 20000, 1, 8).select(F.col("id").alias("_row"), key.alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))


def test_hot_key_of_a_probe_is_split_and_missing_keys_are_spread(spark, hot):
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").alias("id")).unionByName(spark.sql("select 'hot' as id"))
    with conf(spark, **TINY_SKEW):
        joined = probe(hot, keys.distinct().withColumn("hit", F.lit(1)), F.col("k"), "id")
        rows = joined.agg(F.count("*"), F.count("hit")).first()
        assert tuple(rows) == (20000, hot.filter("k is not null").count())
        collected = joined.collect()
        final = plan(joined)
    assert len(collected) == 20000 and "skew=true" in final
    with conf(spark, **TINY_SKEW, spark__sql__adaptive__enabled="false"):
        joined_again = probe(hot, keys.distinct().withColumn("hit", F.lit(1)), F.col("k"), "id")
        places = {r["p"] for r in joined_again.select("k", "pad", F.spark_partition_id().alias("p")).collect() if r["k"] is None}
    assert len(places) >= 3


def test_validation_splits_a_hot_value(spark, hot):
    ids = spark.range(200).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("ID"),
                                  F.lit(DAY).cast("timestamp").alias("TIMESTAMP"))
    with conf(spark, **TINY_SKEW):
        rows = reference.validate_reference(hot, ids, "k", DAY).rows
        n = len(rows.filter("k = 'hot'").collect())
        whole = rows
        assert len(whole.collect()) == 20000
        assert "skew=true" in plan(whole)
    assert n == hot.filter("k = 'hot'").count()


def test_upsert_splits_a_hot_id(spark, hot):
    current = hot.select(F.col("k").alias("ID"), F.col("pad").alias("NAME"))
    batch = spark.createDataFrame([("hot", "new", 0)], "ID string, NAME string, _row long")
    with conf(spark, **TINY_SKEW):
        out = load.updated_rows(current, batch)
        assert len(out.collect()) == 20000 and "skew=true" in plan(out)
        assert out.filter("NAME = 'new'").count() == hot.filter("k = 'hot'").count()


def test_deduplicate_limits_groups_before_the_exchange(hot):
    df = clean.deduplicate(hot, "k").rows
    text = plan(df)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert df.count() == 1 + 1 + hot.filter("k like 'k%'").select("k").distinct().count()


def test_key_check_joins_on_the_row_not_on_the_key(spark, hot):
    with conf(spark, **TINY_SKEW):
        marked = load.mark_rejects(hot.withColumnRenamed("k", "ID"), hot.withColumnRenamed("k", "ID").schema, primary_key=["ID"])
        text = plan(marked)
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert "_at" in join and "ID" not in join  # the text of key and row together, so a hot key is many join keys
    assert marked.filter("_reason is null").count() == 1 + hot.filter("k like 'k%'").select("k").distinct().count()


def test_links_join_all_parent_tables_once(spark):
    rules = [{"parentType": t, "checkTable": t, "relationTable": "X"} for t in ("A", "B", "C")]
    ids = spark.createDataFrame([("p/o",)], "ID string").withColumn("TIMESTAMP", F.lit(DAY).cast("timestamp"))
    batch = spark.createDataFrame([("1", "p", "o", "A")], "ID string, path string, obj string, type string")
    found = link.resolve_parents(batch, lambda t: ids, rules, DAY, "ID", "path", "obj", "type")
    assert plan(found).count("Join") == 1


def test_text_steps_stay_in_one_codegen_stage_without_a_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select("c_name", "c_mktsegment")
    out = clean.concatenate(clean.trim(df).rows, ["c_name", "c_mktsegment"], "ID").rows.select("ID")
    text = plan(out)
    assert "Exchange" not in text and "Python" not in text and "ReadSchema: struct<c_name:string,c_mktsegment:string>" in text


def test_day_scan_is_pushed_to_the_files(spark):
    df = snapshot.on_day(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "o_orderdate", "1998-10-03")
    assert "EqualTo(o_orderdate" in plan(df)


def test_latest_snapshot_prunes_partitions(spark, table):
    name = table("ID STRING, TS DATE", "TS")
    snapshot.append(spark, name, spark.sql("select 'a' as ID, date'2026-03-01' as TS union all select 'b', date'2026-03-02'"))
    newest = snapshot.latest(spark.table(name), "TS")
    assert values(newest, "ID") == [("b",)]
    scan = [line for line in plan(newest).splitlines() if "FileScan" in line or "PartitionFilters" in line]
    assert any("subquery" in line.lower() and "PartitionFilters" in line for line in scan)
