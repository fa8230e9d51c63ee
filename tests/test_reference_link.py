import datetime as dt

import pytest
from conftest import values

from snapflow.operators import link, reference

DAY, TS = "2026-03-02", dt.datetime(2026, 3, 2)
OLD = dt.datetime(2026, 3, 1)


def test_validate_reference(spark):
    ids = spark.createDataFrame([("d1", TS), ("d1", TS), ("d2", OLD), (None, TS)], "ID string, TIMESTAMP timestamp")
    batch = spark.createDataFrame([("r1", "d1"), ("r2", "d2"), ("r3", "D1"), ("r4", " "), (None, "x"), ("r6", None), ("r7", " d1")], "ID string, F string")
    result = reference.validate_reference(batch, ids, "F", DAY, id_column="ID", entity_type="Issue")
    assert values(result.rows) == [(None, ""), ("r1", "d1"), ("r2", ""), ("r3", ""), ("r4", " "), ("r6", None), ("r7", "")]
    log = result.outputs["log"]
    assert log.columns == reference.LOG_FIELDS
    assert values(log, "WHERE_A", "A", "WHERE_B", "B", "CAUSE", "TIMESTAMP") == [
        ("Unknown", "F", " d1", "Issue", "r7", TS), ("Unknown", "F", "D1", "Issue", "r3", TS),
        ("Unknown", "F", "d2", "Issue", "r2", TS), ("Unknown", "F", "x", "Issue", "null", TS)]


def test_validate_without_id_and_on_other_types(spark):
    ids = spark.createDataFrame([("30.0", TS)], "ID string, TIMESTAMP timestamp")
    batch = spark.createDataFrame([(30.0,), (31.0,)], "n double")
    result = reference.validate_reference(batch, ids, "n", DAY)
    assert values(result.rows) == [(None,), (30.0,)]
    assert values(result.outputs["log"], "CAUSE", "WHERE_B", "B") == [("?", "31.0", "Unknown")]


def test_validating_an_absent_column_does_nothing(spark):
    ids = spark.createDataFrame([("a", TS)], "ID string, TIMESTAMP timestamp")
    result = reference.validate_reference(spark.createDataFrame([("x",)], "a string"), ids, "b", DAY)
    assert values(result.rows) == [("x",)] and result.outputs["log"].count() == 0


def test_check_query(spark):
    assert reference.check_query(spark) == 1
    for query in ("SELECT 1 WHERE false", "SELECT * FROM range(2)", "SELECT 1, 2", "SELECT * FROM no_such_table"):
        with pytest.raises(Exception):
            reference.check_query(spark, query)


RULES = [{"parentType": "Risk", "checkTable": "RISK", "relationTable": "A_RISK", "parentEntityType": "Risk node", "extraColumns": {"SIMILARITY": 1}},
         {"parentType": "Control", "checkTable": "CONTROL", "relationTable": "A_CONTROL"},
         {"parentType": "Risk", "checkTable": "CONTROL", "relationTable": "A_CONTROL"}]


@pytest.fixture
def links(spark):
    tables = {"RISK": spark.createDataFrame([("p/o", TS), ("p/o", TS), ("old/o", OLD), ("/", TS)], "ID string, TIMESTAMP timestamp"),
              "CONTROL": spark.createDataFrame([("c/1", TS)], "ID string, TIMESTAMP timestamp")}
    batch = spark.createDataFrame([
        ("1", "p", "o", " Risk "), ("1", "p", "o", "Risk"), ("2", "old", "o", "Risk"), ("3", "c", "1", "Control"), ("4", "p", "o", "Control"),
        ("5", None, None, "Risk"), ("6", "x", "y", "risk"), ("7", "x", "y", " "), ("8", "x", "y", None), (None, "p", "o", "Risk")],
        "ID string, path string, obj string, type string")
    return link.resolve_parents(batch, tables.__getitem__, RULES, DAY, "ID", "path", "obj", "type")


def test_edges(links):
    risk, = link.edges(links, RULES, "A_RISK", DAY)
    assert risk.columns == ["ID_1", "ID_2", "TIMESTAMP", "SIMILARITY"]
    assert values(risk) == [("1", "p/o", TS, 1), ("1", "p/o", TS, 1), ("5", "/", TS, 1), ("null", "p/o", TS, 1)]
    first, second = link.edges(links, RULES, "A_CONTROL", DAY)
    assert values(first) == [("3", "c/1", TS)] and second.count() == 0


def test_link_logs(links):
    assert values(link.missing_log(links, RULES, DAY, "Action"), "WHERE_A", "A", "WHERE_B", "B", "CAUSE", "ACTION") == [
        ("CONTROL", "p/o", "Action", "4", "Unknown", "relationship not loaded"),
        ("Risk node", "old/o", "Action", "2", "Unknown", "relationship not loaded")]
    assert values(link.unknown_log(links, DAY, "Action"), "WHERE_A", "A", "B") == [("Unknown", "risk", "6")]


def test_without_rules_every_type_is_unknown(spark):
    batch = spark.createDataFrame([("1", "p", "o", "Risk")], "ID string, path string, obj string, type string")
    found = link.resolve_parents(batch, None, None, DAY, "ID", "path", "obj", "type")
    assert values(link.unknown_log(found, DAY), "A", "WHERE_B") == [("Risk", "Unknown")]


def test_extra_columns_may_override_keys(spark):
    rules = [{"parentType": "R", "checkTable": "T", "relationTable": "X", "extraColumns": {"ID_2": "fixed", "W": 0.5}}]
    ids = spark.createDataFrame([("a-b", TS)], "KEY string, DAY timestamp")
    batch = spark.createDataFrame([("1", "a", "b", "R")], "ID string, path string, obj string, type string")
    found = link.resolve_parents(batch, lambda t: ids, rules, DAY, "ID", "path", "obj", "type", "-", "KEY", "DAY")
    assert values(link.edges(found, rules, "X", DAY, id1="FROM_ID", ts_column="DAY")[0]) == [("1", "fixed", TS, 0.5)]
