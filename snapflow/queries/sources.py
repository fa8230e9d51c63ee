"""Queries for the sources: workbooks, raw headers, XML, file listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions import files as names
from snapflow.queries import query, table
from snapflow.queries.fixtures import write_workbooks
from snapflow.session import shared_path, small_frame
from snapflow.sources import files, headers, workbook, xmlrows


def _customer_books(spark, sf):
    """Customers as workbooks of 400 rows, one sheet per segment."""
    folder = shared_path(spark, "books")
    rows = table(spark, sf, "customer").select(
        F.floor(F.col("c_custkey") / 400).alias("book"), "c_mktsegment", F.col("c_custkey").alias("Key"), F.col("c_name").alias(" Name "),
        F.when(F.col("c_nationkey") % 3 != 0, F.col("c_acctbal")).alias("Balance"),
        (F.col("c_acctbal") > 0).alias("In credit"), (F.col("c_custkey") + 30000).cast("double").alias("Since"))
    write_workbooks(rows, folder, "book", "c_mktsegment", dates=("Since",))
    return folder


_BOOK_ROWS = """
    SELECT c_mktsegment AS "_sheet", CAST(c_custkey AS DOUBLE) AS "Key", c_name AS "Name",
           CASE WHEN c_nationkey % 3 <> 0 THEN c_acctbal END AS "Balance", c_acctbal > 0 AS "In credit",
           TIMESTAMP '1899-12-30' + to_days(CAST(c_custkey + 30000 AS INTEGER)) AS "Since" FROM customer
"""


@query("A1_workbook_source", _BOOK_ROWS + " WHERE c_mktsegment = 'BUILDING'")
def a1(spark, sf):
    """Second sheet of every workbook, column types found from the cells."""
    rows = workbook.read_workbook(spark, _customer_books(spark, sf), sheet_index=1)
    return rows.select("_sheet", "Key", "Name", "Balance", "In credit", "Since")


@query("A5_all_sheets", _BOOK_ROWS)
def a5(spark, sf):
    """Sheet by sheet, as the fan-out into one table per sheet does; the books are parsed once for all sheets' rows."""
    sheets = workbook.read_sheets(spark, _customer_books(spark, sf), [])
    rows = reduce(DataFrame.unionByName, sheets.values())
    return rows.select("_sheet", "Key", "Name", "Balance", "In credit", "Since")


@query("A2_header_detection", """
    SELECT c_mktsegment AS "_sheet", c_custkey AS "_row", c_name AS name, CAST(c_nationkey AS VARCHAR) AS blank_header,
           CASE WHEN c_acctbal > 0 THEN 'extra' END AS beyond FROM customer""")
def a2(spark, sf):
    """Raw cells: per segment a blank row, a header row, then customers, some with a cell beyond the header."""
    c = table(spark, sf, "customer")
    text = F.lit(None).cast("string")
    body = c.select(F.lit("f").alias("_file"), F.col("c_mktsegment").alias("_sheet"), F.col("c_custkey").alias("_row"),
                    F.array("c_name", F.col("c_nationkey").cast("string"), F.when(F.col("c_acctbal") > 0, "extra")).alias("cells"))
    lead = c.select("c_mktsegment").distinct().select(
        F.lit("f").alias("_file"), F.col("c_mktsegment").alias("_sheet"), F.explode(F.array(
            F.struct(F.lit(-2).cast("long").alias("_row"), F.array(F.lit("  "), text).alias("cells")),
            F.struct(F.lit(-1).cast("long").alias("_row"), F.array(F.lit(" Name\t"), F.lit(" ")).alias("cells")))).alias("r"))
    raw = body.unionByName(lead.select("_file", "_sheet", "r.*"))
    v = F.col("values")
    return headers.with_headers(raw).select("_sheet", "_row", v["Name"].alias("name"), v["column_1"].alias("blank_header"),
                                            v["column_2"].alias("beyond"))


@query("A3_cell_typing", """
    SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS stamp FROM orders""")
def a3(spark, sf):
    days = F.unix_date(F.to_date("o_orderdate")) + 25569 + F.lit(90 / 1440)
    return table(spark, sf, "orders").select("o_orderkey", names.serial_to_timestamp(days).alias("stamp"))


def _customer_xml(spark, sf):
    """Customers with zero-padded ids as lists; beside them, single records: one file per region."""
    folder = shared_path(spark, "xml")
    rows = table(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("id"), F.col("c_name").alias("name"),
                                               F.struct("c_nationkey", "c_mktsegment").alias("place"))
    rows.write.format("xml").option("rootTag", "customers").option("rowTag", "customer").save(f"{folder}/lists")
    region = table(spark, sf, "region").select(F.format_string("<region><id>%05d</id><name>%s</name></region>", "r_regionkey", "r_name").alias("value"), "r_regionkey")
    region.write.partitionBy("r_regionkey").text(f"{folder}/records")
    return folder


@query("A6_xml_rows", """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT lpad(CAST(r_regionkey AS VARCHAR), 5, '0'), r_name, NULL, NULL FROM region""")
def a6(spark, sf):
    """Values stay text, and files that hold one record only are rows like those of a list."""
    rows = xmlrows.read_xml(spark, _customer_xml(spark, sf))
    return rows.select("id", "name", F.col("place.c_nationkey").alias("nation"), F.col("place.c_mktsegment").alias("segment"))


@query("A7_xml_records", """
    SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM region) AS records, (SELECT count(*) FROM region) AS single_files""")
def a7_xml(spark, sf):
    counts = xmlrows.record_counts(spark, _customer_xml(spark, sf))
    return counts.agg(F.sum("records").alias("records"), F.count_if(F.col("path").contains("/records/")).alias("single_files"))


@query("A7_file_metadata", """
    SELECT count(DISTINCT c_custkey // 400) AS n_files, sum(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END)::BIGINT AS records,
           true AS all_sized FROM customer""")
def a7(spark, sf):
    """Size and first-sheet records of each workbook, summed up."""
    folder = _customer_books(spark, sf)
    meta = files.file_metadata(files.list_files(spark, folder), workbook.row_counts(spark, folder))
    return meta.agg(F.count(F.lit(1)).alias("n_files"), F.sum("records").alias("records"),
                    F.bool_and(F.col("size") > 0).alias("all_sized"))


def _dump_names(spark, sf):
    """One file name per order: dated full dumps, dated plain dumps, undated dumps and near misses."""
    key, dataset = F.col("o_orderkey"), F.regexp_replace("o_orderpriority", "[^A-Z]+", "")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = (F.when(key % 5 == 0, F.concat(date, F.lit("-Full Dump "), dataset, F.lit("-ES.xlsx")))
            .when(key % 5 == 1, F.concat(date, F.lit("-"), dataset, F.lit("-es.xml")))
            .when(key % 5 == 2, F.concat(F.lit("Table_"), dataset, F.lit("-ES.xlsx")))
            .when(key % 5 == 3, F.concat(F.lit("2030-01-01-Full Dump Sub-"), dataset, F.lit("-ES.xlsx")))
            .otherwise(F.concat(F.lit("2030-01-01-Full Dump Sub"), dataset, F.lit("-ES.xlsx"))))
    return table(spark, sf, "orders").select(F.concat(F.lit("/drop/"), key, F.lit("/"), name).alias("path"), "o_orderkey", name.alias("name"))


_NAMES = """
    WITH base AS (SELECT o_orderkey AS k, regexp_replace(o_orderpriority, '[^A-Z]+', '', 'g') AS ds, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
    names AS (SELECT k, ds, d, CASE k % 5 WHEN 0 THEN d || '-Full Dump ' || ds || '-ES.xlsx' WHEN 1 THEN d || '-' || ds || '-es.xml'
        WHEN 2 THEN 'Table_' || ds || '-ES.xlsx' WHEN 3 THEN '2030-01-01-Full Dump Sub-' || ds || '-ES.xlsx'
        ELSE '2030-01-01-Full Dump Sub' || ds || '-ES.xlsx' END AS name FROM base)
"""


@query("A8_latest_dump", _NAMES + """
    SELECT ds || '-ES' AS suffix, regexp_extract(name, '^.*$') AS name FROM (
        SELECT ds, name, row_number() OVER (PARTITION BY ds ORDER BY CASE WHEN k % 5 < 2 THEN d END DESC NULLS LAST, name DESC) AS rn
        FROM names WHERE k % 5 < 3) WHERE rn = 1
    UNION ALL SELECT 'ABSENT-ES', NULL""")
def a8(spark, sf):
    listing = _dump_names(spark, sf)
    datasets = table(spark, sf, "orders").select(
        F.concat(F.regexp_replace("o_orderpriority", "[^A-Z]+", ""), F.lit("-ES")).alias("suffix")).distinct()
    datasets = datasets.unionByName(small_frame(spark, [("ABSENT-ES",)], "suffix string"))
    return files.latest_dumps(listing, datasets).select("suffix", names.file_name("path").alias("name"))


@query("A9_dataset_key", _NAMES + """
    SELECT k AS o_orderkey, CASE k % 5 WHEN 0 THEN ds || '-ES.xlsx' WHEN 1 THEN ds || '-es.xml' WHEN 2 THEN 'Table_' || ds || '-ES.xlsx'
        WHEN 3 THEN 'Sub-' || ds || '-ES.xlsx' ELSE 'Sub' || ds || '-ES.xlsx' END AS dataset FROM names""")
def a9(spark, sf):
    return _dump_names(spark, sf).select("o_orderkey", names.dataset_key("name").alias("dataset"))


@query("A10_ingest_date", _NAMES + """
    SELECT k AS o_orderkey, CASE WHEN k % 5 < 2 THEN CAST(d AS DATE) WHEN k % 5 > 2 THEN DATE '2030-01-01' END AS ingest_date,
           k % 5 = 2 AS is_today FROM names""")
def a10(spark, sf):
    """Undated names fall back to today, shown here as a flag so that the result does not change overnight."""
    day = names.ingest_date("name")
    today = (day == F.current_date())
    return _dump_names(spark, sf).select("o_orderkey", F.when(~today, day).alias("ingest_date"), today.alias("is_today"))
