from conftest import values

from snapflow.operators import clean


def test_trim_and_uppercase_touch_text_only(spark):
    df = spark.createDataFrame([("\t straße ", 1.5, None)], "a string, b double, c string")
    assert clean.trim(df).rows.first().asDict() == {"a": "straße", "b": 1.5, "c": None}
    assert clean.uppercase(clean.trim(df).rows).rows.first()["a"] == "STRASSE"


def test_concatenate_replaces_an_existing_target(spark):
    df = spark.createDataFrame([("f", "1", "old"), (" ", None, "old")], "a string, b string, ID string")
    out = clean.concatenate(df, ["a", "b", "missing"], "ID", "/").rows
    assert values(out, "ID") == [("",), ("f/1",)] and out.columns == ["a", "b", "ID"]


def test_missing_parameters_warn_and_keep_rows(spark):
    df = spark.createDataFrame([("x",)], "a string")
    for result in (clean.concatenate(df, [], "t"), clean.concatenate(df, ["a"], None), clean.deduplicate(df, None),
                   clean.filter_null(df, None), clean.lookup(df, df, "a", "b", None, "a")):
        assert result.warnings and values(result.rows) == [("x",)]


def test_deduplicate_keeps_the_first_and_one_null(spark):
    df = spark.createDataFrame([("b", 3, "late"), ("b", 1, "first"), (None, 2, "n1"), (None, 4, "n2"), ("B", 5, "case")],
                               "k string, _row int, v string")
    assert values(clean.deduplicate(df, "k").rows, "v") == [("case",), ("first",), ("n1",)]
    assert values(clean.deduplicate(df, "absent").rows, "v") == [("first",)]


def test_deduplicate_counters(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, _row int")
    result = clean.deduplicate(df, "k")
    assert result.rows.count() == 2
    assert result.counters["in"].get == {"rows": 3} and result.counters["out"].get == {"rows": 2}


def test_filter_null(spark):
    df = spark.createDataFrame([("a",), (" ",), (None,), ("",)], "v string")
    assert values(clean.filter_null(df, "v").rows) == [("a",)]
    assert clean.filter_null(df, "absent").rows.count() == 0


def test_lookup_semantics(spark):
    batch = spark.createDataFrame([(1, " A@x \t"), (2, "Unknown"), (3, None), (4, "  "), (5, "nobody"), (6, "unknown")], "i int, owner string")
    people = spark.createDataFrame([("a@X", "N1"), ("a@x", "N2"), ("unknown", "N3"), (" b", "N4"), (None, "N5")], "mail string, id string")
    result = clean.lookup(batch, people, "owner", "owner", "mail", "id", null_values=["Unknown", ""])
    assert result.rows.columns == ["i", "owner"]
    assert values(result.rows, "i", "owner") == [(1, "N2"), (2, None), (3, None), (4, None), (5, None), (6, "N3")]
    assert result.counters["lookup"].get == {"resolved": 2, "rows": 6}


def test_lookup_uses_the_newest_snapshot_of_the_table(spark):
    batch = spark.createDataFrame([("k",), ("old",)], "s string")
    ref = spark.createDataFrame([("k", "older", "2026-01-01"), ("old", "gone", "2026-01-01"), ("K", "newer", "2026-01-02")],
                                "key string, val string, ts string")
    assert values(clean.lookup(batch, ref, "s", "t", "key", "val", "ts").rows) == [("k", "newer"), ("old", None)]
