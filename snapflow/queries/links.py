"""Queries for reference checks and parent links."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapflow.operators import clean, link, reference
from snapflow.queries import query, table

DAY = "2026-03-02"


def stamped(df, day=DAY):
    return df.withColumn("TIMESTAMP", F.lit(day).cast("timestamp"))


def customer_ids(spark, sf):
    """Customers in credit, as of the ingest day."""
    return stamped(table(spark, sf, "customer").filter("c_acctbal > 0").select(F.concat(F.lit("C"), "c_custkey").alias("ID")))


def order_batch(spark, sf):
    """Untrimmed order dump: folder and number make the id; some owners are blank or missing."""
    key = F.col("o_orderkey")
    owner = F.when(key % 17 == 0, F.lit("  ")).when(key % 19 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("\tC"), F.col("o_custkey"), F.lit(" ")))
    return table(spark, sf, "orders").select(F.concat(F.lit(" "), "o_orderpriority").alias("Folder"),
                                             key.cast("string").alias("Number"), owner.alias("Owner"), "o_totalprice")


def checked_orders(spark, sf):
    trimmed = clean.trim(order_batch(spark, sf)).rows
    keyed = clean.concatenate(trimmed, ["Folder", "Number"], "ID", "/").rows
    return reference.validate_reference(keyed, customer_ids(spark, sf), "Owner", DAY, id_column="ID", entity_type="Order")


_CHECKED = """
    WITH good AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal > 0),
    batch AS (SELECT o_orderpriority || '/' || o_orderkey AS id, o_totalprice,
                     CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'C' || o_custkey END AS owner
              FROM orders)
"""


@query("C13_validate_reference_rows", _CHECKED + """
    SELECT b.id AS "ID", o_totalprice, CASE WHEN owner IS NULL THEN NULL WHEN g.id IS NULL THEN '' ELSE owner END AS "Owner"
    FROM batch b LEFT JOIN good g ON b.owner = g.id""")
def c13_rows(spark, sf):
    return checked_orders(spark, sf).rows.select("ID", "o_totalprice", "Owner")


@query("C13_validate_reference_log", _CHECKED + f"""
    SELECT 'Unknown' AS "WHERE_A", 'Owner' AS "A", owner AS "WHERE_B", 'Order' AS "B", b.id AS "CAUSE",
           'loading data with empty value' AS "ACTION", TIMESTAMP '{DAY}' AS "TIMESTAMP"
    FROM batch b LEFT JOIN good g ON b.owner = g.id WHERE owner <> '' AND g.id IS NULL""")
def c13_log(spark, sf):
    return checked_orders(spark, sf).outputs["log"]


RULES = [
    {"parentType": "SalesOrder", "checkTable": "ORDERS", "relationTable": "LINE_ORDER", "parentEntityType": "Order"},
    {"parentType": "Part", "checkTable": "PARTS", "relationTable": "LINE_PART", "extraColumns": {"SIMILARITY": 1}},
]


def parent_tables(spark, sf):
    frames = {
        "ORDERS": lambda: table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
            F.concat(F.lit("sales/"), "o_orderkey").alias("ID")),
        "PARTS": lambda: table(spark, sf, "part").filter("p_size > 10").select(F.concat(F.lit("parts/"), "p_partkey").alias("ID")),
    }
    return lambda name: stamped(frames[name]())


def line_links(spark, sf):
    """Lines name an order, a part or an unknown kind of parent by return flag; some name none."""
    flag, key = F.col("l_returnflag"), F.col("l_orderkey")
    batch = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("ID"),
        F.when(flag == "A", F.lit("sales")).when(flag == "N", F.lit("parts")).alias("path"),
        F.when(flag == "A", key).otherwise(F.col("l_partkey")).cast("string").alias("objects"),
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).when(flag == "A", F.lit(" SalesOrder ")).when(flag == "N", F.lit("Part"))
        .otherwise(F.concat(F.lit("Kind"), "l_linestatus")).alias("type"))
    return link.resolve_parents(batch, parent_tables(spark, sf), RULES, DAY, "ID", "path", "objects", "type")


_LINKED = """
    WITH lines AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS id, l_returnflag AS f,
                          CASE l_returnflag WHEN 'A' THEN 'sales/' || l_orderkey WHEN 'N' THEN 'parts/' || l_partkey END AS parent,
                          'Kind' || l_linestatus AS kind FROM lineitem WHERE l_linenumber <> 7),
    parents AS (SELECT 'A' AS f, 'sales/' || o_orderkey AS pid FROM orders WHERE o_orderstatus <> 'P'
                UNION SELECT 'N', 'parts/' || p_partkey FROM part WHERE p_size > 10)
"""


@query("C14_link_parent_edges", _LINKED + f"""
    SELECT CASE l.f WHEN 'A' THEN 'LINE_ORDER' ELSE 'LINE_PART' END AS relation_table, id AS "ID_1", pid AS "ID_2",
           TIMESTAMP '{DAY}' AS "TIMESTAMP", CASE l.f WHEN 'N' THEN '1' END AS "SIMILARITY"
    FROM lines l JOIN parents p ON l.f = p.f AND l.parent = p.pid""")
def c14(spark, sf):
    links = line_links(spark, sf)
    orders = link.edges(links, RULES, "LINE_ORDER", DAY)[0].withColumn("relation_table", F.lit("LINE_ORDER"))
    parts = link.edges(links, RULES, "LINE_PART", DAY)[0].withColumn("relation_table", F.lit("LINE_PART"))
    both = orders.unionByName(parts, allowMissingColumns=True)
    return both.withColumn("SIMILARITY", F.col("SIMILARITY").cast("string"))


@query("C15_missing_parent_log", _LINKED + f"""
    SELECT CASE l.f WHEN 'A' THEN 'Order' ELSE 'PARTS' END AS "WHERE_A", parent AS "A", 'Line' AS "WHERE_B", id AS "B",
           'Unknown' AS "CAUSE", 'relationship not loaded' AS "ACTION", TIMESTAMP '{DAY}' AS "TIMESTAMP"
    FROM lines l LEFT JOIN parents p ON l.f = p.f AND l.parent = p.pid WHERE l.f <> 'R' AND p.pid IS NULL""")
def c15(spark, sf):
    return link.missing_log(line_links(spark, sf), RULES, DAY, "Line")


@query("C16_unknown_type_log", _LINKED + f"""
    SELECT 'Unknown' AS "WHERE_A", kind AS "A", 'Line' AS "WHERE_B", id AS "B", 'Unknown' AS "CAUSE",
           'relationship not loaded' AS "ACTION", TIMESTAMP '{DAY}' AS "TIMESTAMP" FROM lines WHERE f = 'R'""")
def c16(spark, sf):
    return link.unknown_log(line_links(spark, sf), DAY, "Line")
