import datetime as dt
import random
import sys
import tracemalloc

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.queries.fixtures import workbook_bytes
from snapflow.sources import files, headers, workbook, xmlrows


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())


def book(*sheets):
    return workbook_bytes({f"S{i}": s for i, s in enumerate(sheets)})


def test_typed_cells(spark, tmp_path):
    raw = [("raw", 't="inlineStr"><is><t>in</t><r><t>line</t></r></is>'), ("raw", 't="e"><v>#N/A</v>'), ("raw", "><f>1+2</f><v>3</v>"),
           ("raw", 't="str"><f>A1</f><v>txt</v>'), ("raw", "><v>abc</v>")]
    put(tmp_path, "b.xlsx", book([["Name", "Age", "Flag", "When", "Inline", "Error", "Formula", "Str", "Bad"],
                                  ["Ann", 30, True, ("date", 46135.4375), *raw], [None, 1.5, False]]))
    df = workbook.read_workbook(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in df.schema.fields[:9]] == [
        "string", "double", "boolean", "timestamp", "string", "string", "double", "string", "string"]
    first, second = df.orderBy("_row").collect()
    assert tuple(first[:9]) == ("Ann", 30.0, True, dt.datetime(2026, 4, 23, 10, 30), "inline", None, 3.0, "txt", None)
    assert tuple(second[:9]) == (None, 1.5, False, None, None, None, None, None, None)
    assert (first["_row"], second["_row"], first["_sheet"], first["_sheet_index"]) == (0, 1, "S0", 0)


def test_header_rules(spark, tmp_path):
    put(tmp_path, "b.xlsx", book([[], ["  "], [" Col ", " ", "C"], ["a", "b", "c", "d"], ["x", None, "y"]]))
    df = workbook.read_workbook(spark, str(tmp_path / "b.xlsx"))
    assert df.columns[:4] == ["Col", "column_1", "C", "column_3"]
    assert values(df, *df.columns[:4]) == [("a", "b", "c", "d"), ("x", None, "y", None)]


def test_header_only_and_empty_sheets(spark, tmp_path):
    put(tmp_path, "b.xlsx", book([["A", "B"]], []))
    assert workbook.read_workbook(spark, str(tmp_path)).count() == 0
    assert workbook.read_workbook(spark, str(tmp_path), sheet_index=1).count() == 0


def test_equal_headers_keep_the_last_cell(spark, tmp_path):
    put(tmp_path, "b.xlsx", book([["A", "A"], [1, 2], [3, None]]))
    assert values(workbook.read_workbook(spark, str(tmp_path)), "A") == [(2.0,), (3.0,)]


def test_sheets_by_index_name_and_all(spark, tmp_path):
    put(tmp_path, "b.xlsx", book([["K"], ["zero"]], [["K"], ["one"]]))
    assert values(workbook.sheet_catalog(spark, str(tmp_path)), "_sheet_index", "_sheet") == [(0, "S0"), (1, "S1")]
    assert values(workbook.read_workbook(spark, str(tmp_path), sheet_index=1), "K") == [("one",)]
    assert values(workbook.read_workbook(spark, str(tmp_path), sheet_name="S0"), "K") == [("zero",)]
    assert values(workbook.read_workbook(spark, str(tmp_path), all_sheets=True), "K", "_sheet") == [("one", "S1"), ("zero", "S0")]
    with pytest.raises(Exception, match="out of range"):
        workbook.read_workbook(spark, str(tmp_path), sheet_index=2).count()


def test_corpus_unites_headers_and_mixes_kinds_to_text(spark, tmp_path):
    put(tmp_path, "a.xlsx", book([["K", "V"], [1, 10000000]]))
    put(tmp_path / "sub", "b.xlsx", book([["K", "W"], ["x", True]]))
    put(tmp_path, "~lock.xlsx", b"no workbook")
    df = workbook.read_workbook(spark, str(tmp_path))
    assert df.columns == ["K", "V", "W", "_file", "_sheet_index", "_sheet", "_row"]
    assert values(df, "K", "V", "W") == [("1.0", 1.0e7, None), ("x", None, True)]
    text = T.StructType([T.StructField("V", T.StringType())])
    assert values(workbook.read_workbook(spark, str(tmp_path), text), "V") == [(None,), ("1.0E7",)]


@pytest.mark.parametrize("x", [0.0, 30.0, -1.5, 1e7, 12345678.9, 1e-3, 9.99e-4, 1.5e300, 123456.789, 1e21, 2.2250738585072014e-308, -2.5e-7])
def test_number_text_is_how_spark_casts(spark, x):
    assert workbook.number_text(x) == spark.createDataFrame([(x,)], "x double").selectExpr("cast(x as string)").first()[0]


@pytest.mark.parametrize("number, code, expected", [
    (14, None, True), (1, "0", False), (170, "yyyy-mm-dd hh:mm:ss", True), (171, '0.00 "days"', False), (172, "[h]:mm", True),
    (173, "[$-409]d/m/yy h:mm AM/PM;@", True), (174, "General", False), (175, "#,##0.00", False), (176, "[Red]0", False), (177, "dd\\.mm\\.yyyy", True)])
def test_date_formats(number, code, expected):
    assert workbook.is_date_format(number, code) is expected


def test_file_metadata(spark, tmp_path):
    put(tmp_path, "a.xlsx", book([["K"], [1], [2], [3]]))
    put(tmp_path, "b.xlsx", book([["K"]]))
    meta = files.file_metadata(files.list_files(spark, str(tmp_path)), workbook.row_counts(spark, str(tmp_path)))
    rows = {r["path"].rsplit("/", 1)[1]: (r["size"], r["records"]) for r in meta.collect()}
    assert rows == {n: ((tmp_path / n).stat().st_size, k) for n, k in (("a.xlsx", 3), ("b.xlsx", 0))}


def test_missing_path(spark, tmp_path):
    with pytest.raises(Exception):
        workbook.sheet_catalog(spark, str(tmp_path / "none")).count()


def newest(spark, names, *suffixes):
    listing = spark.createDataFrame([(f"file:/d/{n}",) for n in names], "path string")
    wanted = spark.createDataFrame([(s,) for s in suffixes], "suffix string")
    return {r["suffix"]: r["path"] and r["path"].rsplit("/", 1)[1] for r in files.latest_dumps(listing, wanted).collect()}


@pytest.mark.parametrize("names, suffix, expected", [
    (["2025-01-01-Report-ES.xlsx", "2026-03-01-Report-ES.xlsx"], "Report-ES", "2026-03-01-Report-ES.xlsx"),
    (["Table_CMDB.xlsx", "2026-03-06-Full Dump CMDB.xlsx"], "CMDB", "2026-03-06-Full Dump CMDB.xlsx"),
    (["Table_CMDB.xlsx"], "cmdb", "Table_CMDB.xlsx"),
    (["2026-02-15-ZZZ Full Dump Actions-ES.xlsx", "2026-03-01-Actions-ES.xlsx"], "Actions-ES", "2026-03-01-Actions-ES.xlsx"),
    (["2026-03-06-Full Dump SubProcess-ES.xlsx"], "Process-ES", None),
    (["2026-03-06-Full Dump Sub-Processes-ES.xlsx"], "Processes-ES", None),
    (["2026-03-06-Full Dump Sub-Processes-ES.xlsx"], "Sub-Processes-ES", "2026-03-06-Full Dump Sub-Processes-ES.xlsx"),
    (["REPORT.XLSX"], "report", "REPORT.XLSX"),
    (["1x-Report.xlsx"], "Report", None),
    (["2026-13-01-Report.xlsx", "Report.xlsx"], "Report", "Report.xlsx"),
    (["a.b.xlsx"], "b", "a.b.xlsx"),
])
def test_latest_dump(spark, names, suffix, expected):
    assert newest(spark, names, suffix) == {suffix: expected}


def test_all_datasets_in_one_pass(spark):
    names = ["2026-03-06-Full Dump Process-ES.xlsx", "2026-03-06-Full Dump SubProcess-ES.xlsx", "2026-03-07-Process-ES.xlsx"]
    assert newest(spark, names, "Process-ES", "SubProcess-ES", "None") == {
        "Process-ES": names[2], "SubProcess-ES": names[1], "None": None}


def test_resolve_dump(spark, tmp_path):
    put(tmp_path, "2026-03-06-Full Dump A-ES.xlsx", b"x")
    put(tmp_path, "2026-03-07-A-ES.xlsx", b"x")
    assert files.resolve_dump(spark, str(tmp_path), "A-ES").endswith("2026-03-07-A-ES.xlsx")
    with pytest.raises(FileNotFoundError):
        files.resolve_dump(spark, str(tmp_path), "B-ES")


def test_xml_repeated_children(spark, tmp_path):
    put(tmp_path, "r.xml", "<rows><info>x</info><row><a>1</a><b>u</b></row><row><a>2</a></row></rows>")
    assert xmlrows.row_tags(spark, str(tmp_path)) == (["row"], [])
    assert values(xmlrows.read_xml(spark, str(tmp_path)), "a", "b") == [("1", "u"), ("2", None)]


def test_xml_without_repeats_is_one_row(spark, tmp_path):
    put(tmp_path, "one.xml", "<doc><a>1</a><b>x</b></doc>")
    assert values(xmlrows.read_xml(spark, str(tmp_path)), "a", "b") == [("1", "x")]


def test_repeated_text_is_a_list_of_the_root_row(spark, tmp_path):
    put(tmp_path, "list.xml", "<doc><t>a</t><t>b</t><n>1</n></doc>")
    row, = xmlrows.read_xml(spark, str(tmp_path)).collect()
    assert (row["t"], row["n"]) == (["a", "b"], "1")


def test_xml_several_repeated_names(spark, tmp_path):
    put(tmp_path, "two.xml", "<d><p><x>1</x></p><p><x>2</x></p><q><y>3</y></q><q><y>4</y></q></d>")
    assert values(xmlrows.read_xml(spark, str(tmp_path)), "x", "y") == [(None, "3"), (None, "4"), ("1", None), ("2", None)]


def test_single_child_with_a_known_row_tag(spark, tmp_path):
    put(tmp_path, "single.xml", "<rows><row><a>1</a></row></rows>")
    assert values(xmlrows.read_xml(spark, str(tmp_path), "row"), "a") == [("1",)]


def test_values_stay_text_and_single_records_stay_rows(spark, tmp_path):
    put(tmp_path, "list.xml", "<rows><row><a>007</a></row><row><a>1.10</a></row></rows>")
    put(tmp_path, "lone.xml", "<rows><row><a>2026-03-02</a></row></rows>")
    put(tmp_path, "card.xml", "<card><a>008</a></card>")
    rows = xmlrows.read_xml(spark, str(tmp_path))
    assert values(rows, "a") == [("007",), ("008",), ("1.10",), ("2026-03-02",)]
    counts = {r["path"].rsplit("/", 1)[-1]: r["records"] for r in xmlrows.record_counts(spark, str(tmp_path)).collect()}
    assert counts == {"list.xml": 2, "lone.xml": 1, "card.xml": 1}


def test_headers_of_raw_cells(spark):
    raw = spark.createDataFrame([
        ("f", "s", 0, [" ", None]), ("f", "s", 1, [" A ", None, "A"]), ("f", "s", 2, ["1", "2", None, "4"]), ("f", "s", 3, ["1", None, "3"]),
        ("f", "t", 0, ["H"]), ("f", "u", 0, [" "])], "_file string, _sheet string, _row int, cells array<string>")
    found = {(r["_sheet"], r["_row"]): r["values"] for r in headers.with_headers(raw).collect()}
    assert found == {("s", 2): {"A": "1", "column_1": "2", "column_3": "4"}, ("s", 3): {"A": "3"}}


def test_wide_and_repeated_headers(spark):
    """Two thousand columns; names that repeat, name a cell beyond the header, or look like one."""
    width = 2000
    heads = [f"h{i % 1500}" for i in range(width)]
    heads[3], heads[4], heads[5], heads[6] = "column_2003", "column_1", "column_007", "column_99999999999999"
    cells = [None if i % 7 == 0 else str(i) for i in range(width + 6)]
    want = {}
    for i, c in enumerate(cells):
        if c is not None:
            want[heads[i] if i < width else f"column_{i}"] = c
    raw = spark.createDataFrame([("f", "s", 0, heads)] + [("f", "s", n, cells) for n in range(1, 40)] + [("f", "s", 40, None), ("f", "s", 41, cells[:2])],
                                "_file string, _sheet string, _row int, cells array<string>")
    found = {r["_row"]: r["values"] for r in headers.with_headers(raw).collect()}
    assert all(found[n] == want for n in range(1, 40)) and found[41] == {"h1": "1"} and not found[40]


def test_shared_strings_stay_small():
    texts = [f"text number {i} {chr(0xE9)}" for i in range(300_000)]
    tracemalloc.start()
    table = workbook.SharedStrings(iter(texts))
    for i in random.Random(1).sample(range(len(texts)), 3000):
        assert table[i] == texts[i]
    size, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    listed = sum(map(sys.getsizeof, texts))
    assert size < listed / 2 and len(table._open) <= table.OPEN_BLOCKS
    assert [workbook.SharedStrings(["", "a\nb", ""])[i] for i in range(3)] == ["", "a\nb", ""]
    with pytest.raises(IndexError):
        workbook.SharedStrings([])[0]


def test_a_book_with_many_strings(spark, tmp_path):
    rows = [["K", "V"], *[[f"k{i}", f"v{i % 5000}"] for i in range(60_000)]]
    put(tmp_path, "b.xlsx", book(rows))
    df = workbook.read_workbook(spark, str(tmp_path))
    assert df.count() == 60_000 and df.filter(F.substring("V", 2, 9).cast("int") != F.substring("K", 2, 9).cast("int") % 5000).count() == 0


def test_all_sheets_in_one_read(spark, tmp_path, monkeypatch):
    put(tmp_path, "a.xlsx", workbook_bytes({"One": [["Id", "X"], ["a", 1]], "T'wo / 2": [["Id", "X", "Y"], [7, "text", True]], "Bare": []}))
    put(tmp_path, "b.xlsx", workbook_bytes({"Late": [["_row", "Id"], ["own", "z"]], "One": [["X", "Z"], [2, "zz"]]}))
    opened = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(workbook.WorkbookReader, "_opened", opened, raising=False)
    lines = workbook.WorkbookReader._lines
    monkeypatch.setattr(workbook.WorkbookReader, "_lines", lambda self, path, book: (self._opened.add(1), lines(self, path, book))[1])
    scratch = []
    sheets = workbook.read_sheets(spark, str(tmp_path), scratch)
    parsed = opened.value
    assert list(sheets) == ["Late", "One", "T'wo / 2", "Bare"] and len(scratch) == 1
    one, two, late = sheets["One"], sheets["T'wo / 2"], sheets["Late"]
    assert dict(one.dtypes)["X"] == "double" and dict(two.dtypes)["X"] == "string" and dict(two.dtypes)["Id"] == "double"
    assert values(one, "Id", "X", "Z") == [(None, 2.0, "zz"), ("a", 1.0, None)] and values(two, "Id", "X", "Y") == [(7.0, "text", True)]
    assert values(late, "_row", "Id") == [("own", "z")] and sheets["Bare"].count() == 0
    assert one.columns[:3] == ["Id", "X", "Z"] or one.columns[:3] == ["X", "Id", "Z"]
    for name, frame in sheets.items():
        lone = workbook.read_workbook(spark, str(tmp_path), sheet_name=name)
        assert values(frame, *sorted(set(lone.columns) - {"_row"})) == values(lone, *sorted(set(lone.columns) - {"_row"}))
    assert parsed <= 6  # two books: columns, rows, and the sheet list, which parses no rows


def test_filters_on_file_and_sheet_reach_the_source(spark, tmp_path):
    for n in "abc":
        put(tmp_path, f"{n}.xlsx", workbook_bytes({"S": [["Id"], [n]], "T": [["Id"], [n + "t"]]}))
    put(tmp_path, "d.xlsx", "no workbook")
    df = workbook.read_workbook(spark, str(tmp_path), T.StructType([T.StructField("Id", T.StringType())]), all_sheets=True)
    picked = df.filter((F.col("_file") == str(tmp_path / "b.xlsx")) & F.col("_sheet").isin("T", "U"))
    assert values(picked, "Id") == [("bt",)]  # the broken file is not opened
    with pytest.raises(Exception, match="zip"):
        df.filter("_sheet = 'T'").collect()


def test_lone_records_of_every_shape(spark, tmp_path):
    """Beside lists, and with the lists' own root: attributes, nesting, repeats, declared encodings, empty roots."""
    put(tmp_path, "list.xml", "<rows><row><a>1</a></row><row><a>2</a></row></rows>")
    put(tmp_path, "same root.xml", "<rows><note>n</note></rows>")
    put(tmp_path, "none.xml", "<rows/>")
    put(tmp_path, "latin.xml", "<?xml version='1.0' encoding='ISO-8859-1'?><card id='7'><a>é</a></card>".encode("latin-1"))
    put(tmp_path, "deep+1.xml", "<card><place k='v'>Rome<zip>01</zip></place><t>x</t><t>y</t></card>")
    rows = xmlrows.read_xml(spark, str(tmp_path))
    found = {r["_file"].rsplit("/", 1)[-1]: r.asDict(True) for r in rows.filter("a is null or a not in ('1', '2')").collect()}
    assert rows.count() == 6 and set(found) == {"same root.xml", "none.xml", "latin.xml", "deep+1.xml"}
    assert found["same root.xml"]["note"] == "n" and found["latin.xml"]["a"] == "é" and found["latin.xml"]["_id"] == "7"
    assert found["deep+1.xml"]["place"] == {"_VALUE": "Rome", "_k": "v", "zip": "01"} and found["deep+1.xml"]["t"] == ["x", "y"]
    assert all(v is None for k, v in found["none.xml"].items() if k != "_file")
    assert xmlrows.row_tags(spark, str(tmp_path)) == (["row"], ["card", "rows"])


def test_lone_records_as_sparks_reader_names_them(spark, tmp_path):
    texts = ["<r><a>1</a><b><c>x</c><c>y</c></b></r>", "<r z='1'><a q='2'>t</a><b/></r>", "<r><d> s </d><e><f g='h'/></e></r>"]
    for i, t in enumerate(texts):
        put(tmp_path, f"{i}.xml", t)
    own = xmlrows.read_xml(spark, str(tmp_path))
    theirs = spark.read.format("xml").option("rowTag", "r").option("inferSchema", "false").load(str(tmp_path))
    assert sorted(theirs.columns) == sorted(c for c in own.columns if c != "_file")
    assert values(own, "d", "_z") == values(theirs, "d", "_z")


def test_many_small_records(spark, tmp_path):
    for i in range(300):
        put(tmp_path / str(i % 7), f"{i}.xml", f"<card><id>{i:05d}</id></card>")
    scratch = []
    assert values(xmlrows.read_xml(spark, str(tmp_path), scratch=scratch), "id") == [(f"{i:05d}",) for i in range(300)] and len(scratch) == 1


def test_typed_lone_records(spark, tmp_path):
    put(tmp_path, "a.xml", "<card><id>7</id></card>")
    rows = xmlrows.read_xml(spark, str(tmp_path), schema=T.StructType([T.StructField("id", T.IntegerType())]))
    assert values(rows, "id") == [(7,)]
