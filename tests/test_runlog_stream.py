import datetime as dt
import os

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.plans import runlog, shapes
from snapflow.queries.fixtures import workbook_bytes
from snapflow.streaming import filedrop
from snapflow.streaming.filedrop import ingest_drops, outcomes

T0 = dt.datetime(2026, 3, 2, 10)


def jobs(spark, *statuses):
    return spark.createDataFrame([("r", f"j{i}", "f", "EXCEL", s, T0 + dt.timedelta(seconds=i), T0 + dt.timedelta(seconds=10), 1, 0, 0, 2, 1)
                                  for i, s in enumerate(statuses)], runlog.JOBS)


@pytest.mark.parametrize("statuses, expected", [
    ("SUCCESS SUCCESS", "SUCCESS"), ("FAILED FAILED", "FAILED"), ("SUCCESS FAILED", "PARTIAL"), ("SUCCESS SKIPPED", "PARTIAL"), ("SKIPPED", "PARTIAL"), ("", "SUCCESS")])
def test_run_status(spark, statuses, expected):
    assert runlog.run_status(jobs(spark, *statuses.split()), by=()).first()["status"] == expected


def test_totals_and_bounds_without_jobs(spark):
    empty = jobs(spark, "SUCCESS").limit(0)
    assert runlog.run_totals(empty, by=()).first()["success_rate"] == 0.0
    assert runlog.run_bounds(empty, by=()).first()["duration_ms"] == 0


def test_totals_and_bounds(spark):
    df = jobs(spark, "SUCCESS", "FAILED", "PARTIAL", "SKIPPED")
    assert tuple(runlog.run_totals(df).first())[1:] == (4, 1, 1, 1, 4, 0, 0, 8, 4, 25.0)
    assert tuple(runlog.run_bounds(df).first())[1:] == (T0, T0 + dt.timedelta(seconds=10), 10000)


@pytest.mark.parametrize("name, group", [
    ("actions-ES", "actions"), ("actions_fr", "actions"), ("actions-import", "actions-import"), ("a-es-es", "a-es"), ("x" * 40 + "-de", "x" * 40), (" b -it", "b")])
def test_dataset_group(spark, name, group):
    assert spark.range(1).select(runlog.dataset_group(F.lit(name))).first()[0] == group


def test_worst_status(spark):
    df = spark.createDataFrame([("a", "SUCCESS"), ("a", "PARTIAL"), ("b", "SKIPPED"), ("b", "PENDING"), ("c", "RUNNING")], "dataset string, status string")
    assert values(runlog.worst_status(df)) == [("a", "PARTIAL"), ("b", "SKIPPED"), ("c", "RUNNING")]


def test_execution_log_is_sorted(spark):
    log = spark.createDataFrame([("r", "j", None, None, T0 + dt.timedelta(seconds=i % 3), "INFO", None, f"m{i}") for i in range(9)], runlog.LOG)
    rows = runlog.execution_log(log).collect()
    assert [r["TIMESTAMP"] for r in rows] == sorted(r["TIMESTAMP"] for r in rows) and rows[0].asDict() == {
        "TIMESTAMP": "2026-03-02 10:00:00", "SEVERITY": "INFO", "STEP": "", "MESSAGE": "m0"}


def test_job_level_messages(spark):
    log = spark.createDataFrame([("r", "j", None, None, T0, "ERROR", "j", "job"), ("r", "j", "t", None, T0, "ERROR", "t", "task"),
                                 ("r", "j", None, None, T0, "WARN", "j", "warn")], runlog.LOG)
    assert values(runlog.messages(log, "ERROR"), "message") == [("job",)] and runlog.messages(log, "ERROR", False).count() == 2
    assert values(runlog.message_counts(log)) == [("r", "j", 1, 1)]


def test_summary_csv(spark, tmp_path):
    runlog.write_summary_csv(jobs(spark, "SUCCESS").withColumn("file_path", F.lit("a,b")), str(tmp_path / "csv"))
    head = "Job Name,File Path,File Type,Status,Duration (ms),Records Processed,Records Failed\n"
    parts = [part.read_text() for part in (tmp_path / "csv").glob("part-*.csv")]
    assert all(p.startswith(head) for p in parts)
    assert "".join(p.removeprefix(head) for p in parts) == 'j0,"a,b",EXCEL,SUCCESS,10000,1,0\n'


def test_workbook_drops_run_once(spark, table, tmp_path):
    target = table("ID STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP")
    spec = {"name": "drop", "tasks": [{"name": "load", "type": "PERSISTENCE", "subtasks": [
        {"name": "clear", "type": "TRUNCATE", "parameters": {"tableName": target, "timestampColumn": "TIMESTAMP"}},
        {"name": "insert", "type": "INSERT", "parameters": {"tableName": target, "mappings": [{"dbColumn": "TIMESTAMP", "autoGenerate": "TIMESTAMP"}]}}]}]}
    drop, state = tmp_path / "drop", str(tmp_path / "state")
    drop.mkdir()

    def put(name, *ids):
        (drop / name).write_bytes(workbook_bytes({"S": [["ID"], *[[i] for i in ids]]}))

    put("2026-03-01-A.xlsx", "a", "b")
    put("2026-03-02-A.xlsx", "c")
    first = ingest_drops(spark, spec, str(drop), state, "workbook")
    assert [r.status for r in first] == ["SUCCESS", "SUCCESS"] and [r.processed for r in first] == [2, 1]
    assert ingest_drops(spark, spec, str(drop), state, "workbook") == []
    put("2026-03-01-A-v2.xlsx", "z")
    assert len(ingest_drops(spark, spec, str(drop), state, "workbook")) == 1
    assert values(spark.table(target)) == [("c", dt.datetime(2026, 3, 2)), ("z", dt.datetime(2026, 3, 1))]


def load_spec(target, clear=True, **insert):
    return shapes.job("drop", "A", [shapes.step("trim", "TRIM")], [
        *([shapes.step("clear", "TRUNCATE", tableName=target, timestampColumn="TIMESTAMP")] if clear else []),
        shapes.step("insert", "INSERT", tableName=target, mappings=[shapes.STAMP], **insert)])


def write(folder, name, text, at=None):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    if at is not None:
        os.utime(folder / name, (1_700_000_000 + at, 1_700_000_000 + at))


def status_of(spark, state):
    return {r["path"].rsplit("/", 1)[-1]: (r["status"], r["failed_tasks"]) for r in outcomes(spark, state).collect()}


CSV = T.StructType([T.StructField("Id", T.StringType()), T.StructField("Name", T.StringType())])


def test_a_thousand_files_of_ten_days_are_ten_jobs(spark, table, tmp_path):
    target, drop = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP"), tmp_path / "drop"
    for i in range(1000):
        write(drop, f"2026-03-{i % 10 + 1:02d}-part-{i}.csv", f"{i},n\n")
    results = ingest_drops(spark, load_spec(target, clear=False), str(drop), str(tmp_path / "state"), "csv", CSV)
    assert [r.status for r in results] == ["SUCCESS"] * 10 and [r.processed for r in results] == [100] * 10
    rows = spark.table(target).select(F.col("ID").cast("int"), F.day("TIMESTAMP")).collect()
    assert sorted(r[0] for r in rows) == list(range(1000)) and all(r[0] % 10 + 1 == r[1] for r in rows)
    assert ingest_drops(spark, load_spec(target, clear=False), str(drop), str(tmp_path / "state"), "csv", CSV) == []


def test_partial_jobs_are_tried_again(spark, table, tmp_path):
    name, drop, state = f"late_{os.getpid()}", tmp_path / "drop", str(tmp_path / "state")
    write(drop, "2026-03-01-A.csv", "a,x\n")
    assert [r.status for r in ingest_drops(spark, load_spec(name), str(drop), state, "csv", CSV)] == ["PARTIAL"]
    assert status_of(spark, state) == {"2026-03-01-A.csv": ("PARTIAL", ["persist-data"])}
    assert [r.status for r in ingest_drops(spark, load_spec(name), str(drop), state, "csv", CSV)] == ["PARTIAL"]
    table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP", name)
    assert [r.status for r in ingest_drops(spark, load_spec(name), str(drop), state, "csv", CSV)] == ["SUCCESS"]
    assert values(spark.table(name), "ID") == [("a",)] and status_of(spark, state)["2026-03-01-A.csv"] == ("SUCCESS", [])
    assert ingest_drops(spark, load_spec(name), str(drop), state, "csv", CSV) == []


def test_the_last_dump_that_can_be_loaded_counts(spark, table, tmp_path):
    target, drop, state = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP"), tmp_path / "drop", str(tmp_path / "state")
    spec = load_spec(target)
    schema = CSV
    for at, (name, id_) in enumerate([("2026-03-01-c", "one"), ("2026-03-01-b", "two")]):
        rows = str(tmp_path / f"w{at}")
        spark.createDataFrame([(id_, "n")], schema).coalesce(1).write.parquet(rows)
        drop.mkdir(exist_ok=True)
        part = next(p for p in (tmp_path / f"w{at}").glob("part-*.parquet"))
        part.rename(drop / f"{name}.parquet")
        os.utime(drop / f"{name}.parquet", (1_700_000_000 + at, 1_700_000_000 + at))
    write(drop, "2026-03-01-a.parquet", "no parquet", at=9)  # arrived last and cannot be read
    results = ingest_drops(spark, spec, str(drop), state, "parquet", schema)
    assert [r.status for r in results] == ["PARTIAL", "SUCCESS"] and values(spark.table(target), "ID") == [("two",)]
    assert {k: v[0] for k, v in status_of(spark, state).items()} == {"2026-03-01-a.parquet": "PARTIAL", "2026-03-01-b.parquet": "SUCCESS", "2026-03-01-c.parquet": "SUPERSEDED"}
    assert [r.status for r in ingest_drops(spark, spec, str(drop), state, "parquet", schema)] == ["PARTIAL"]  # the broken one only
    assert values(spark.table(target), "ID") == [("two",)]


def test_a_broken_file_does_not_hold_up_the_others(spark, table, tmp_path):
    target, drop, state = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP"), tmp_path / "drop", str(tmp_path / "state")
    spec = {"name": "one task", "tasks": load_spec(target, clear=False)["tasks"][1:]}
    drop.mkdir()
    for n in "ab":
        (drop / f"2026-03-01-{n}.xlsx").write_bytes(workbook_bytes({"S": [["ID", "Name"], [n, n]]}))
    write(drop, "2026-03-01-c.xlsx", "no workbook")
    results = ingest_drops(spark, spec, str(drop), state, "workbook")
    assert sorted(r.status for r in results) == ["FAILED", "FAILED", "SUCCESS", "SUCCESS"] and values(spark.table(target), "ID") == [("a",), ("b",)]
    (drop / "2026-03-01-c.xlsx").write_bytes(workbook_bytes({"S": [["ID", "Name"], ["c", "c"]]}))
    assert [r.status for r in ingest_drops(spark, spec, str(drop), state, "workbook")] == ["SUCCESS"]
    assert values(spark.table(target), "ID") == [("a",), ("b",), ("c",)]


def test_upserts_of_a_day_follow_arrival(spark, table, tmp_path):
    target, drop = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP"), tmp_path / "drop"
    write(drop, "2026-03-01-b.csv", "1,first\n2,first\n", at=1)
    write(drop, "2026-03-01-a.csv", "1,second\n", at=2)
    spark.sql(f"INSERT INTO {target} VALUES ('1', 'old', NULL), ('2', 'old', NULL)")
    ingest_drops(spark, load_spec(target, clear=False, upsertMode=True), str(drop), str(tmp_path / "state"), "csv", CSV)
    assert values(spark.table(target), "ID", "NAME") == [("1", "second"), ("2", "first")]


def test_the_ledger_stays_short_and_survives_a_broken_compaction(spark, table, tmp_path, monkeypatch):
    target, drop, state = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP"), tmp_path / "drop", str(tmp_path / "state")
    monkeypatch.setattr(filedrop, "COMPACT_FILES", 2)
    for i in range(6):
        write(drop, f"2026-03-0{i + 1}-A.csv", f"{i},x\n")
        if i == 3:
            (tmp_path / "state-outcomes" / "v99").mkdir()  # without its mark
        assert len(ingest_drops(spark, load_spec(target), str(drop), state, "csv", CSV)) == 1
    versions = sorted(p.name for p in (tmp_path / "state-outcomes").iterdir() if p.is_dir())
    assert len(versions) == 2 and versions[0] != "v0" and len(outcomes(spark, state).collect()) == 6
    assert len(list((tmp_path / "state-outcomes" / versions[0]).glob("*.parquet"))) <= 3


def test_days_at_once_equal_days_in_turn(spark, table, tmp_path):
    results = []
    for parallel in (1, 4):
        target, drop = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP"), tmp_path / f"drop{parallel}"
        for i in range(12):
            write(drop, f"2026-03-{i % 6 + 1:02d}-{i}.csv", f"{i},n{i}\n", at=i)
        done = ingest_drops(spark, load_spec(target), str(drop), str(tmp_path / f"state{parallel}"), "csv", CSV, parallel=parallel)
        results.append((values(spark.table(target)), [(r.status, r.processed) for r in done]))
    assert results[0] == results[1] and len(results[0][0]) == 6
