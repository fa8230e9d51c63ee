import copy
import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from snapflow.operators import snapshot
from snapflow.plans import job, runlog

DAY, TS, OLD = "2026-03-02", dt.datetime(2026, 3, 2), dt.datetime(2026, 3, 1)
LOG = "WHERE_A STRING, A STRING, WHERE_B STRING, B STRING, CAUSE STRING, ACTION STRING, TIMESTAMP TIMESTAMP"


def spec(*tasks, **extra):
    return {"name": "j", "tasks": [{"name": f"t{i}", "type": kind, "stopOnFailure": stop, "subtasks": [
        {"name": f"s{i}{k}", "type": t, "parameters": p} for k, (t, p) in enumerate(steps)]} for i, (kind, stop, steps) in enumerate(tasks)], **extra}


def messages(result, level=None):
    return [line[6] for line in result.log if level in (None, line[4])]


def counters(result):
    return {(c[2], c[4]): c[5] for c in result.counters}


@pytest.fixture
def world(spark, table):
    people = table("ID STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP")
    risks = table("ID STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP")
    snapshot.append(spark, people, spark.createDataFrame([("p1", TS), ("p2", OLD)], "ID string, TIMESTAMP timestamp"))
    snapshot.append(spark, risks, spark.createDataFrame([("r/1", TS), ("r/1", OLD)], "ID string, TIMESTAMP timestamp"))
    names = {"actions": table("ID STRING, NAME STRING, OWNER STRING, DELEGATE STRING, NOTE STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP"),
             "edges": table("ID_1 STRING, ID_2 STRING, TIMESTAMP TIMESTAMP, SIMILARITY INT"), "log": table(LOG), "people": people, "risks": risks}
    validate = lambda f: ("VALIDATE_REFERENCE", {"fieldColumn": f, "referenceTable": people, "idColumn": "ID", "etlLogTable": names["log"],
                                                 "currentEntityType": "Action"})
    names["spec"] = spec(
        ("TRANSFORMATION", True, [("TRIM", {}), ("CONCATENATE", {"sourceColumns": ["Folder", "No"], "targetColumn": "ID", "separator": "/"})]),
        ("PERSISTENCE", True, [
            ("TRUNCATE", {"tableName": names["actions"], "timestampColumn": "TIMESTAMP"}), validate("Owner"), validate("Delegate"),
            ("INSERT", {"tableName": names["actions"], "mappings": [{"dbColumn": "TIMESTAMP", "autoGenerate": "TIMESTAMP"},
                                                                    {"excelColumn": "Action_Name", "dbColumn": "NAME"}]}),
            ("LINK_PARENT", {"idColumn": "ID", "parentPathColumn": "Path", "parentObjectsColumn": "Obj", "parentTypeColumn": "Type",
                             "etlLogTable": names["log"], "currentEntityType": "Action",
                             "rules": [{"parentType": "Risk", "checkTable": risks, "relationTable": names["edges"], "parentEntityType": "Risk",
                                        "extraColumns": {"SIMILARITY": 1}}]})]))
    names["batch"] = spark.createDataFrame(
        [(" f", "1 ", "one", "p1", "p2", "r", "1", "Risk", 0), ("f", "2", "two", "gone", None, "r", "9", "Risk", 1), ("f", "3", "three", " ", "p1", "x", "y", "Moon", 2)],
        "Folder string, No string, Action_Name string, Owner string, Delegate string, Path string, Obj string, Type string, _row long")
    return names


def test_whole_spec_replayed_and_over_two_days(spark, world):
    for day in (DAY, DAY, "2026-03-01"):
        result = job.run_job(spark, world["spec"], world["batch"], day)
        assert result.status == "SUCCESS", messages(result, "ERROR")
    rows = values(spark.table(world["actions"]).filter(F.col("TIMESTAMP") == TS), "ID", "NAME", "OWNER", "DELEGATE", "NOTE")
    assert rows == [("f/1", "one", "p1", "", None), ("f/2", "two", "", None, None), ("f/3", "three", "", "p1", None)]
    assert spark.table(world["actions"]).count() == 6


def test_side_outputs_and_counters(spark, world):
    result = job.run_job(spark, world["spec"], world["batch"], DAY)
    assert values(spark.table(world["edges"])) == [("f/1", "r/1", TS, 1)]
    assert values(spark.table(world["log"]), "WHERE_A", "A", "WHERE_B", "CAUSE") == [
        ("Risk", "r/9", "Action", "Unknown"), ("Unknown", "Delegate", "p2", "f/1"), ("Unknown", "Moon", "Action", "Unknown"), ("Unknown", "Owner", "gone", "f/2")]
    got = counters(result)
    assert (got["s11", "cleared"], got["s12", "cleared"], got["s13", "inserted"]) == (1, 1, 3)
    assert (got["s14", "linked"], got["s14", "missing"], got["s14", "unknown"]) == (1, 1, 1)
    assert result.processed == 3 and "3 rows in the batch" in messages(result)
    assert "parents: 1 linked, 1 absent, 1 of a type without rule" in messages(result, "SUMMARY")


def test_empty_batch_clears_the_day(spark, world):
    job.run_job(spark, world["spec"], world["batch"], DAY)
    result = job.run_job(spark, world["spec"], world["batch"].limit(0), DAY)
    assert result.status == "SUCCESS" and spark.table(world["actions"]).count() == 0
    assert counters(result)["s13", "inserted"] == 0


def test_transformations_without_a_load_still_count(spark, table):
    people = table("mail STRING, id STRING")
    snapshot.append(spark, people, spark.createDataFrame([("a@x", "N1")], "mail string, id string"))
    batch = spark.createDataFrame([("A@x", 0), ("A@x", 1), ("zz", 2), (" ", 3)], "o string, _row long")
    result = job.run_job(spark, spec(("TRANSFORMATION", True, [
        ("FILTER_NULL", {"column": "o"}), ("DEDUPLICATE", {"keyColumn": "o"}), ("UPPERCASE", {}), ("DEDUPLICATE", {}),
        ("LOOKUP", {"sourceColumn": "o", "targetColumn": "ck", "referenceTable": people, "referenceKeyColumn": "mail", "referenceValueColumn": "id"})])), batch, DAY)
    got = counters(result)
    assert (got["s00", "removed"], got["s01", "removed"], got["s04", "resolved"], got["s04", "nulled"]) == (1, 1, 1, 1)
    assert messages(result, "WARN") == ["DEDUPLICATE needs 'keyColumn'"]


def insert(target, **p):
    return ("PERSISTENCE", False, [("INSERT", {"tableName": target, **p})])


def test_bad_rows_are_counted_not_fatal(spark, table):
    target = table("ID STRING, SCORE DOUBLE, CODE VARCHAR(2)", properties="TBLPROPERTIES ('snapflow.primaryKey' = 'ID')")
    batch = spark.createDataFrame([("1", "1.5", "ab", 0), ("2", "x", "ab", 1), ("3", "1", "abc", 2), ("1", "2", "ab", 3)], "Id string, Score string, Code string, _row long")
    result = job.run_job(spark, spec(insert(target)), batch, DAY)
    assert values(spark.table(target)) == [("1", 1.5, "ab")] and (result.processed, result.failed) == (1, 3)
    assert result.status == "SUCCESS" and counters(result)["s00", "failed"] == 3
    again = job.run_job(spark, spec(insert(target)), batch, DAY)
    assert (again.processed, again.failed) == (0, 4)


def test_skip_existing_and_upsert(spark, table):
    target = table("ID STRING, NAME STRING, EXTRA STRING")
    snapshot.append(spark, target, spark.createDataFrame([("1", "a", "k"), ("2", "b", "k")], "ID string, NAME string, EXTRA string"))
    batch = spark.createDataFrame([(1, "A", 0), (3, "C", 1), (None, "lost", 2)], "Id int, Name string, _row long")
    assert job.run_job(spark, spec(insert(target, skipExisting=True)), batch.filter("Id = 1 or Id is null"), DAY).processed == 0
    result = job.run_job(spark, spec(insert(target, upsertMode=True, skipExisting=True)), batch, DAY)
    assert values(spark.table(target)) == [("1", "A", "k"), ("2", "b", "k"), ("3", "C", None)]
    assert counters(result)["s00", "updated"] == 1 and result.processed == 2
    job.run_job(spark, spec(insert(target, skipExisting=True)), batch, DAY)
    assert spark.table(target).count() == 3


def test_upsert_rewrites_only_touched_partitions(spark, table):
    target = table("ID STRING, NAME STRING, LAND STRING", "LAND")
    rows = [("1", "a", "ES"), ("2", "b", "ES"), ("3", "c", "FR"), ("4", "d", None)]
    snapshot.append(spark, target, spark.createDataFrame(rows, "ID string, NAME string, LAND string").coalesce(1))
    files = lambda: set(spark.table(target).inputFiles())
    before = files()
    batch = spark.createDataFrame([("2", "B", 0), ("4", "D", 1), ("9", "new", 2)], "Id string, Name string, _row long")
    result = job.run_job(spark, spec(insert(target, upsertMode=True)), batch, DAY)
    assert result.status == "SUCCESS", messages(result, "ERROR")
    assert values(spark.table(target)) == [("1", "a", "ES"), ("2", "B", "ES"), ("3", "c", "FR"), ("4", "D", None), ("9", "new", None)]
    assert [f for f in before if "LAND=FR" in f][0] in files() and not any("LAND=ES" in f and f in before for f in files())


def test_upsert_needs_the_id_mapped(spark, table):
    target = table("ID STRING, NAME STRING")
    snapshot.append(spark, target, spark.createDataFrame([("1", "a")], "ID string, NAME string"))
    batch = spark.createDataFrame([("1", "A", 0)], "ID string, Name string, _row long")
    only_name = [{"excelColumn": "Name", "dbColumn": "NAME"}]
    result = job.run_job(spark, spec(insert(target, upsertMode=True, autoMap=False, mappings=only_name)), batch, DAY)
    assert result.status == "FAILED" and "ID identifies rows but nothing is mapped to it" in messages(result, "ERROR")[0]


def test_failure_policy(spark, table):
    target = table("ID STRING")
    batch = spark.createDataFrame([("1", 0)], "ID string, _row long")
    broken = ("PERSISTENCE", False, [("SELECT", {"query": "SELECT 1 WHERE false"})])
    assert job.run_job(spark, spec(broken, insert(target)), batch, DAY).status == "PARTIAL"
    assert spark.table(target).count() == 1
    stopped = job.run_job(spark, spec((broken[0], True, broken[2]), insert(target)), batch, DAY)
    assert stopped.status == "PARTIAL" and spark.table(target).count() == 1
    assert "nothing runs after t0" in messages(stopped, "ERROR")
    assert [t[2] for t in stopped.tasks] == ["FAILED", "PENDING"]
    assert job.run_job(spark, spec(broken), batch, DAY).status == "FAILED"
    assert job.run_job(spark, spec(("PERSISTENCE", True, [("SELECT", {})])), batch, DAY).status == "SUCCESS"


def test_step_of_the_other_kind_only_warns(spark):
    batch = spark.createDataFrame([("1", 0)], "ID string, _row long")
    result = job.run_job(spark, spec(("PERSISTENCE", True, [("TRIM", {})])), batch, DAY)
    assert result.status == "SUCCESS" and messages(result, "WARN") == ["TRIM is no step of a persistence task"]
    assert job.run_job(spark, spec(("PERSISTENCE", True, [("EXPLODE", {})])), batch, DAY).status == "FAILED"


def test_parameters_merge_inwards():
    s = spec(("TRANSFORMATION", True, [("TRIM", {"c": 3})]), parameters={"a": 1, "b": 1, "c": 1})
    s["tasks"][0]["parameters"] = {"b": 2, "c": 2}
    assert job.bind(s)[0].steps[0].params == {"a": 1, "b": 2, "c": 3}


def test_selection():
    specs = [{"name": "a"}, {"name": "b", "enabled": False}, {"name": "c"}]
    assert [s["name"] for s in job.selected(specs)] == ["a", "c"] and [s["name"] for s in job.selected(specs, ["b", "c"])] == ["c"]


def test_user_step(spark, table):
    target = table("ID STRING")

    @job.step("REVERSE")
    def reverse(run, p):
        run.touch(run.rows.withColumn(p["column"], F.reverse(p["column"])))

    batch = spark.createDataFrame([("abc", 0)], "ID string, _row long")
    job.run_job(spark, spec(("TRANSFORMATION", True, [("REVERSE", {"column": "ID"})]), insert(target)), batch, DAY)
    assert values(spark.table(target)) == [("cba",)]
    del job.STEPS["REVERSE"]


def test_run_over_a_folder_of_dumps(spark, table, tmp_path):
    from snapflow.queries.fixtures import workbook_bytes

    one, two = table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP"), table("ID STRING, NAME STRING, TIMESTAMP TIMESTAMP")
    flat = table("ID STRING, NAME STRING")
    (tmp_path / "2026-03-01-Full Dump Chain.xlsx").write_bytes(workbook_bytes({one: [["ID", "Name"], ["old", "x"]]}))
    (tmp_path / "2026-03-02-Full Dump Chain.xlsx").write_bytes(workbook_bytes(
        {one: [["ID", "Name"], ["a", " n "]], "empty": [["ID"]], two: [["ID", "Name"], ["b", "m"], ["c", "o"]]}))
    (tmp_path / "2026-03-02-Flat.xml").write_text("<r><row><ID>x1</ID><NAME>n</NAME></row><row><ID>x2</ID></row></r>")
    text = """
name: chain
fileType: EXCEL
processAllSheets: true
source: {type: RESOURCES, location: {path: Chain}}
tasks:
  - {name: clean, type: TRANSFORMATION, subtasks: [{name: trim, type: TRIM}]}
  - name: load
    type: PERSISTENCE
    subtasks:
      - name: upsert
        type: INSERT
        parameters: {tableName: _FROM_SHEET_, upsertMode: true, idColumn: ID, mappings: [{dbColumn: TIMESTAMP, autoGenerate: TIMESTAMP}]}
"""
    xml = spec(insert(flat), fileType="XML", source={"location": {"path": "flat"}})
    report = job.run_jobs(spark, [job.load_spec(text), xml, {"name": "none", "source": {"location": {"path": "Absent"}}}, {"name": "off", "enabled": False}],
                          job.open_dump(spark, str(tmp_path)))
    assert not messages(report.results[0], "ERROR")
    assert values(spark.table(one)) == [("a", "n", TS)] and values(spark.table(two), "ID") == [("b",), ("c",)]
    assert values(spark.table(flat)) == [("x1", "n"), ("x2", None)]
    assert values(report.jobs(), "job", "status", "processed") == [("chain", "SUCCESS", 3), ("j", "SUCCESS", 2), ("none", "FAILED", 0)]
    log = report.log()
    assert runlog.messages(log, "WARN").filter("message like 'no rows in sheet %'").count() == 1
    assert values(runlog.run_status(report.jobs()), "status") == [("PARTIAL",)]
    assert runlog.messages(log, "ERROR").filter("job = 'none'").count() == 1
    assert values(report.steps().groupBy("job", "type", "status").count()) == [
        ("chain", "INSERT", "SUCCESS", 2), ("chain", "TRIM", "SUCCESS", 2), ("j", "INSERT", "SUCCESS", 1)]
    assert report.counters().filter("counter = 'inserted'").count() == 3 and report.tasks().count() == 3
    assert values(runlog.run_totals(report.jobs()), "total_jobs", "failed_jobs", "total_processed") == [(3, 1, 5)]


def test_directory_import_comes_first_in_the_report(spark, table):
    from snapflow.plans.directory import ATTRIBUTES

    hr = table("id STRING, name STRING, mail STRING, department STRING, ckmanager STRING, title STRING, timestamp TIMESTAMP", "timestamp")
    people = spark.createDataFrame([("A",) * 7], ", ".join(f"{c} string" for c in ATTRIBUTES))
    sources = {"good": lambda: people, "bad": lambda: spark.table("no_such_export")}
    done = job.run_directory_import(spark, sources, DAY, hr)
    empty = job.run_directory_import(spark, {"bad": sources["bad"]}, DAY, hr)
    broken = job.run_directory_import(spark, sources, DAY, "no_such_table")
    assert spark.table(hr).count() == 0  # the empty import cleared the day
    report = job.run_jobs(spark, [], None, before=[done, empty, broken])
    assert [r.status for r in report.results] == ["SUCCESS", "PARTIAL", "FAILED"]
    assert values(report.jobs(), "status", "processed") == [("FAILED", 0), ("PARTIAL", 0), ("SUCCESS", 1)]


def test_unreadable_file_skips_the_job(spark):
    report = job.run_jobs(spark, [{"name": "x"}], lambda s: None)
    assert values(report.jobs(), "status", "warnings") == [("SKIPPED", 1)]


def test_spec_is_not_changed_by_a_run(spark, world):
    before = copy.deepcopy(world["spec"])
    job.run_job(spark, world["spec"], world["batch"], DAY)
    assert world["spec"] == before
