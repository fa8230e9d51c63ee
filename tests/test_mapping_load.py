import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.operators import load, mapping, snapshot
from snapflow.operators.mapping import Mapping

D1, D2 = dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 2)


def test_auto_map_matches_by_normal_form_and_lets_explicit_win():
    plan = mapping.auto_map(["Nombre Producto", "Región", "Precio", "Notas internas", " "],
                            ["nombre_producto", "REGION", "PRECIO", "FECHA_INGESTA", "CODIGO_REF"],
                            [Mapping("FECHA_INGESTA", generate="TIMESTAMP"), Mapping("precio", source="Other")])
    assert [(m.target, m.source) for m in plan.mappings] == [
        ("NOMBRE_PRODUCTO", "Nombre Producto"), ("REGION", "Región"), ("FECHA_INGESTA", None), ("precio", "Other")]
    assert plan.unmatched_headers == ["Notas internas"] and plan.unmapped_columns == ["CODIGO_REF"]
    assert len(plan.warnings()) == 2


def test_two_headers_for_one_column_are_refused():
    with pytest.raises(ValueError, match="'my col' and 'My-Col'"):
        mapping.auto_map(["my col", "My-Col"], ["MY_COL"])


def test_unknown_table_maps_nothing():
    assert mapping.auto_map(["a"], []).mappings == []


def test_project_kinds_and_conform(spark):
    df = spark.createDataFrame([("f", "1", 2.5, 0)], "a string, b string, c double, _row int")
    maps = mapping.parse([{"dbColumn": "ID", "concatenate": ["a", "b"], "separator": "/"}, {"dbColumn": "TS", "autoGenerate": "timestamp"},
                          {"excelColumn": "c", "dbColumn": "score"}, {"excelColumn": "zz", "dbColumn": "GONE"}, "junk"])
    schema = T.StructType.fromDDL("ID STRING, SCORE STRING, TS TIMESTAMP, GONE DOUBLE, EXTRA INT")
    row = mapping.conform(mapping.project(df, maps, "2026-03-02"), schema).first()
    assert tuple(row) == ("f/1", "2.5", D2, None, None)
    assert mapping.parse(None) == [] == mapping.parse("x")


def test_source_of_column():
    maps = [Mapping("ID", parts=("a",)), Mapping("id", source="Key")]
    assert mapping.source_of_column("Id", maps) == "Key" and mapping.source_of_column("OTHER", maps) == "OTHER"


def test_day_filters_and_replace(spark):
    df = spark.createDataFrame([("a", D1), ("b", D2), ("c", None)], "ID string, TS timestamp")
    assert values(snapshot.on_day(df, "TS", "2026-03-02"), "ID") == [("b",)]
    assert values(snapshot.latest(df, "TS"), "ID") == [("b",)] and snapshot.latest(df, None).count() == 3
    empty = df.limit(0)
    assert values(snapshot.replace_day(df, empty, "TS", "2026-03-02"), "ID") == [("a",), ("c",)]


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ", "DATE"])
def test_day_partition_overwrite_keeps_other_days(spark, table, kind):
    name = table(f"ID STRING, TS {kind}", "TS")
    day = lambda i, d: spark.createDataFrame([(i, d)], "ID string, TS timestamp").withColumn("TS", F.col("TS").cast(kind))
    snapshot.append(spark, name, day("a", D1))
    snapshot.overwrite_day(spark, name, day("b", D2), "ts", "2026-03-02")
    snapshot.overwrite_day(spark, name, day("c", D2), "TS", "2026-03-02")
    assert values(spark.table(name), "ID") == [("a",), ("c",)]
    assert "PartitionFilters: [isnotnull(TS" in snapshot.on_day(spark.table(name), "TS", "2026-03-02")._jdf.queryExecution().toString()
    snapshot.clear_day(spark, name, "TS", "2026-03-02")
    assert values(spark.table(name), "ID") == [("a",)]
    snapshot.clear_all(spark, name)
    assert spark.table(name).count() == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrites_do_not_depend_on_the_session(spark, table, mode):
    name = table("ID STRING, TS DATE", "TS")
    days = spark.sql("select 'a' as ID, date'2026-03-01' as TS union all select 'b', date'2026-03-02'")
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, mode)
    try:
        snapshot.append(spark, name, days)
        snapshot.replace_partitions(spark, name, days.filter("ID = 'b'").withColumn("ID", F.lit("c")))
        assert values(spark.table(name), "ID") == [("a",), ("c",)]
        snapshot.overwrite_day(spark, name, days.limit(0), "TS", "2026-03-01")
        assert values(spark.table(name), "ID") == [("c",)]
        snapshot.replace_all(spark, name, spark.table(name).unionByName(days).filter("ID != 'b'"))
        assert values(spark.table(name), "ID") == [("a",), ("c",)]
        snapshot.replace_all(spark, name, days.filter("ID = 'b'"))
        assert values(spark.table(name), "ID") == [("b",)]
        snapshot.clear_all(spark, name)
        assert spark.table(name).count() == 0 and spark.conf.get(setting) == mode
    finally:
        spark.conf.set(setting, before)


def test_clear_day_of_an_unpartitioned_table(spark, table):
    name = table("ID STRING, TS TIMESTAMP")
    snapshot.append(spark, name, spark.createDataFrame([("a", D1), ("b", D2), ("n", None)], "ID string, TS timestamp"))
    snapshot.clear_day(spark, name, "TS", "2026-03-01")
    assert values(spark.table(name), "ID") == [("b",), ("n",)]


ITEM = T.StructType([T.StructField("ID", T.StringType()), T.StructField("NAME", T.StringType()), T.StructField("SCORE", T.DoubleType())])


def marks(spark, rows, **options):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "ID string, NAME string, SCORE string, _row int")
    marked = load.mark_rejects(df, ITEM, **options)
    return marked, {r["_row"]: r["_reason"] for r in marked.collect()}


def test_bad_rows_by_reason(spark):
    rows = [("1", "ok", "1.5"), ("2", "toolong", None), ("3", None, "1"), ("4", "x", "abc"), ("1", "dup", "2"), (None, "x", "1"), ("9", "x", "1")]
    existing = spark.createDataFrame([("9",)], "ID string")
    marked, why = marks(spark, rows, primary_key=["ID"], existing=existing, required=["NAME"], lengths={"NAME": 5})
    assert why == {0: None, 1: "length", 2: "null", 3: "type", 4: "key", 5: "null", 6: "key"}
    assert values(load.accepted(marked, ITEM)) == [("1", "ok", 1.5)] and load.rejected(marked).count() == 6


def test_a_bad_first_row_does_not_hold_the_key(spark):
    _, why = marks(spark, [("1", "x", "abc"), ("1", "x", "1"), ("1", "x", "2")], primary_key=["ID"])
    assert why == {0: "type", 1: None, 2: "key"}


@pytest.mark.parametrize("held, expected", [(["2"], (3, 1)), (["2", "4"], (2, 2))])
def test_rows_held_by_the_table(spark, held, expected):
    existing = spark.createDataFrame([(h,) for h in held], "ID string")
    _, why = marks(spark, [(str(i), "n", None) for i in range(1, 5)], primary_key=["ID"], existing=existing)
    good = sum(w is None for w in why.values())
    assert (good, len(why) - good) == expected


def test_order_of_several_columns(spark):
    df = spark.createDataFrame([("k", "late", "b", 0), ("k", "first", "a", 1), ("k", "second", "a", 2)], "ID string, NAME string, _file string, _row int")
    marked = load.mark_rejects(df, T.StructType.fromDDL("ID STRING, NAME STRING"), ["ID"], ["_file", "_row"])
    assert values(load.accepted(marked, T.StructType.fromDDL("NAME STRING"))) == [("first",)]


def test_limits_come_from_the_table(spark, table):
    name = table("ID STRING, CODE VARCHAR(3)")
    assert load.limits_of(spark.table(name).schema) == ([], {"CODE": 3})


def test_skip_existing(spark):
    current = spark.createDataFrame([("1",), (None,)], "id string")
    batch = spark.createDataFrame([(1, "old"), (2, "new"), (2, "again"), (None, "lost")], "Key int, v string")
    assert values(load.new_rows(batch, current, "Key", "ID"), "v") == [("again",), ("new",)]


def test_upsert(spark):
    current = spark.createDataFrame([("1", "a", "keep"), ("2", "b", "keep"), (None, "n", "keep")], "ID string, NAME string, OTHER string")
    batch = spark.createDataFrame([("1", "first", 0), ("1", None, 1), ("3", "x", 2), ("3", "y", 3), (None, "lost", 4)], "ID string, NAME string, _row int")
    assert values(load.upsert(current, batch)) == [
        (None, "n", "keep"), ("1", None, "keep"), ("2", "b", "keep"), ("3", "x", None), ("3", "y", None)]


def test_upsert_with_only_the_id_mapped_changes_nothing(spark):
    current = spark.createDataFrame([("1", "a")], "ID string, NAME string")
    batch = spark.createDataFrame([("1", 0)], "ID string, _row int")
    assert values(load.updated_rows(current, batch)) == [("1", "a")]


def test_two_files_with_equal_row_numbers_keep_every_row(spark):
    rows = [("A", "f1", 0), ("B", "f1", 1), ("A", "f2", 0), ("C", "f2", 1)]
    batch = spark.createDataFrame(rows, "ID string, _file string, _row long")
    marked = load.mark_rejects(batch, batch.select("ID").schema, ["ID"], ["_file", "_row"])
    assert values(marked, "ID", "_file", load.REASON) == [("A", "f1", None), ("A", "f2", "key"), ("B", "f1", None), ("C", "f2", None)]
    assert load.mark_rejects(batch.select("ID", "_row"), batch.select("ID").schema, ["ID"]).count() == 4


def test_a_job_over_two_files_loads_each_key_once(spark, table):
    from snapflow.plans.job import run_job

    target, rejects = table("ID STRING, V STRING"), table("JOB STRING, TABLE_NAME STRING, ROW_KEY STRING, REASON STRING, ROW_VALUES STRING, TIMESTAMP TIMESTAMP")
    batch = spark.createDataFrame([("A", "1", 0), ("B", "2", 1), ("A", "3", 0), ("C", "4", 1)], "ID string, V string, _row long")
    spec = {"name": "j", "tasks": [{"name": "t", "type": "PERSISTENCE", "subtasks": [{"name": "i", "type": "INSERT", "parameters": {
        "tableName": target, "primaryKey": ["ID"], "rejectTable": rejects}}]}]}
    result = run_job(spark, spec, batch, "2026-03-02")
    assert (result.processed, result.failed) == (3, 1)
    assert sorted(r["ID"] for r in spark.table(target).collect()) == ["A", "B", "C"]
    assert [r["REASON"] for r in spark.table(rejects).collect()] == ["key"]
