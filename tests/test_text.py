import pytest
from conftest import values
from pyspark.sql import functions as F

from snapflow.functions import files, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_jtrim_strips_control_characters_but_not_nbsp(spark):
    assert one(spark, text.jtrim(F.lit("\t\x00 a b \n"))) == "a b"
    assert one(spark, text.jtrim(F.lit(" a"))) == " a"


@pytest.mark.parametrize("value, blank", [("", True), (" \t\n", True), (" ", True), (" ", False), ("a", False), (" a\n", False)])
def test_is_blank(spark, value, blank):
    assert one(spark, text.is_blank(F.lit(value))) is blank


def test_has_text_is_never_null(spark):
    assert one(spark, text.has_text(F.lit(None).cast("string"))) is False


def test_concat_nonblank(spark):
    row = spark.createDataFrame([("a", " ", 30.0, None)], "a string, b string, c double, d string")
    assert row.select(text.concat_nonblank(["a", "b", "c", "d"], "-")).first()[0] == "a-30.0"
    assert row.select(text.concat_nonblank(["b", "d"], "-")).first()[0] == ""


HEADERS = [
    ("First Name", "FIRST_NAME"), ("with-dashes", "WITH_DASHES"), ("with.dots", "WITH_DOTS"), ("camelCaseField", "CAMEL_CASE_FIELD"),
    ("  spaces  around  ", "SPACES_AROUND"), ("ALREADY_UPPER", "ALREADY_UPPER"), ("código región", "CODIGO_REGION"),
    ("Año/Mes (2)", "ANO_MES_2"), ("__x__", "X"), ("a1B", "A1B"), ("HTTPServer", "HTTPSERVER"), ("Ünïçode", "UNICODE"), ("#", ""),
]


@pytest.mark.parametrize("raw, expected", HEADERS)
def test_normalize_header(raw, expected):
    assert text.normalize_header(raw) == expected


def test_normalize_header_of_nothing():
    assert text.normalize_header(None) is None and text.normalize_header(" \t") is None


@pytest.mark.parametrize("raw, expected", [("mail: a@b", "a@b"), (" x ", "x"), ("a: b: c", "b: c"), (":", ""), (None, None), ("a\nb: c", "c")])
def test_clean_attr(spark, raw, expected):
    assert one(spark, text.clean_attr(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw, expected", [
    ("CN=N1,OU=D2", "N1"), ("OU=x,CN= N2 ,CN=N3", "N2"), ("CN=N4", "N4"), (" plain ", "plain"), ("CN=,OU=x", ",OU=x"), ("CN=", ""), (None, None)])
def test_extract_cn(spark, raw, expected):
    assert one(spark, text.extract_cn(F.lit(raw).cast("string"))) == expected


def test_item_label(spark):
    df = spark.createDataFrame([("Name", "a/b/c"), (None, "a/b"), ("Name", "a/"), ("Name", "solo")], "n string, i string")
    assert [r[0] for r in df.select(text.item_label("n", "i")).collect()] == ["Name (c)", None, None, "Name (solo)"]


@pytest.mark.parametrize("serial, expected", [
    (1.0, "1900-01-01 00:00:00"), (59.0, "1900-02-28 00:00:00"), (61.0, "1900-03-01 00:00:00"),
    (46135.4375, "2026-04-23 10:30:00"), (25569.0, "1970-01-01 00:00:00"), (-1.0, None)])
def test_serial_to_timestamp(spark, serial, expected):
    from snapflow.sources.workbook import serial_to_wall_clock

    got = one(spark, files.serial_to_timestamp(F.lit(serial)).cast("string"))
    assert got == expected
    clock = serial_to_wall_clock(serial)
    assert (clock.isoformat(" ") if clock else None) == expected


@pytest.mark.parametrize("name, day", [("2026-03-02-Name.xlsx", "2026-03-02"), ("x 2026-03-02 2027-01-01.xml", "2026-03-02")])
def test_ingest_date(spark, name, day):
    from snapflow.plans.job import ingest_day

    assert str(one(spark, files.ingest_date(F.lit(name)))) == day == str(ingest_day(name))


@pytest.mark.parametrize("name", ["Name.xlsx", "2026-02-30-Name.xlsx"])
def test_ingest_date_falls_back_to_today(spark, name):
    assert one(spark, files.ingest_date(F.lit(name)) == F.current_date())


@pytest.mark.parametrize("name, key", [
    ("2026-03-06-Full Dump Actions-ES.xlsx", "Actions-ES.xlsx"), ("2026-03-06-Actions.xlsx", "Actions.xlsx"), ("Full Dump A.xlsx", "Full Dump A.xlsx")])
def test_dataset_key(spark, name, key):
    assert one(spark, files.dataset_key(F.lit(name))) == key


def test_stem(spark):
    names = spark.createDataFrame([("A.B.xlsx",), ("Noext",), (".hidden",)], "n string")
    assert values(names.select(files.stem("n").alias("s"))) == [(".hidden",), ("a.b",), ("noext",)]
