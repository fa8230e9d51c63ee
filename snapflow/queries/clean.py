"""Queries for the row transformations."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapflow.operators import clean, mapping
from snapflow.queries import query, table

DAY = "2026-03-02"

WS = "' ' || chr(9) || chr(10)"


def padded(c: str):
    return F.concat(F.lit("\t "), F.col(c), F.lit(" \n"))


@query("B1_trim", """
    SELECT c_custkey, c_name AS padded_name, c_mktsegment AS padded_segment, c_acctbal FROM customer""")
def b1(spark, sf):
    dirty = table(spark, sf, "customer").select("c_custkey", padded("c_name").alias("padded_name"),
                                                padded("c_mktsegment").alias("padded_segment"), "c_acctbal")
    return clean.trim(dirty).rows


@query("B2_uppercase", """
    SELECT p_partkey, upper(lower(p_name) || ' straße') AS p_name, upper(p_type) AS p_type, p_size FROM part"""
       .replace("straße') AS", "strasse') AS"))
def b2(spark, sf):
    lower = table(spark, sf, "part").select("p_partkey", F.concat(F.lower("p_name"), F.lit(" straße")).alias("p_name"),
                                            F.lower("p_type").alias("p_type"), "p_size")
    return clean.uppercase(lower).rows


@query("B3_concatenate", """
    SELECT p_partkey, concat_ws('/', nullif(trim(b), ''), nullif(trim(t), ''), CAST(p_size AS VARCHAR)) AS ID
    FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN '  ' ELSE p_brand END AS b,
                 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS t FROM part)""")
def b3(spark, sf):
    holes = table(spark, sf, "part").select(
        "p_partkey", "p_size", F.when(F.col("p_partkey") % 2 == 0, F.lit("  ")).otherwise(F.col("p_brand")).alias("b"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("t"))
    return clean.concatenate(holes, ["b", "t", "p_size"], "ID", "/").rows.select("p_partkey", "ID")


@query("B4_deduplicate", """
    SELECT event_id, CAST(k AS VARCHAR) AS user_key, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id) AS rn FROM (
        SELECT event_id, event_type, CASE WHEN user_id % 10 <> 0 THEN user_id END AS k FROM events)) WHERE rn = 1""")
def b4(spark, sf):
    keyed = table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_key"), "event_type")
    first = clean.deduplicate(keyed, "user_key", order_by=["event_id"]).rows
    return first.withColumn("user_key", F.col("user_key").cast("string"))


@query("B5_filter_null", """
    SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0""")
def b5(spark, sf):
    key = F.col("c_custkey")
    holes = table(spark, sf, "customer").select(
        "c_custkey", F.when(key % 3 == 0, F.lit(" \t")).when(key % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"))
    return clean.filter_null(holes, "c_mktsegment").rows


@query("B6_lookup", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 7 <> 0
        THEN CAST(c_custkey AS VARCHAR) END AS owner
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""")
def b6(spark, sf):
    """Order owner names, padded and in another case, to customer ids; one status holds a sentinel name."""
    name = F.concat(F.lit(" CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("\t"))
    batch = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.lit(" Unknown "))
        .when(F.col("o_orderkey") % 7 == 0, F.lit("  ")).otherwise(name).alias("owner"))
    people = table(spark, sf, "customer").filter("c_acctbal > 0")
    return clean.lookup(batch, people, "owner", "owner", "c_name", "c_custkey", null_values=["Unknown", ""]).rows


@query("B6_lookup_latest_snapshot", """
    WITH newest AS (SELECT user_id, max(event_type) AS v FROM events
                    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY user_id)
    SELECT c_custkey, v AS last_event FROM customer LEFT JOIN newest ON c_custkey = user_id""")
def b6_latest(spark, sf):
    reference = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    batch = table(spark, sf, "customer").select("c_custkey")
    return clean.lookup(batch, reference, "c_custkey", "last_event", "user_id", "event_type", ts_column="day").rows


@query("B7_normalize_header", """
    SELECT p_partkey AS "PART_KEY", p_name AS "PART_NAME", p_brand AS "REGION_DE_ORIGEN", p_size AS "SIZE_2" FROM part""")
def b7(spark, sf):
    """Headers with padding, dashes, camel case and accents meet the table's columns through the mapping that jobs use."""
    batch = table(spark, sf, "part").select(F.col("p_partkey").alias("  partKey "), F.col("p_name").alias("part--name"),
                                            F.col("p_brand").alias("Región de origen"), F.col("p_size").alias("Size (2)"))
    plan = mapping.auto_map(batch.columns, ["PART_KEY", "PART_NAME", "REGION_DE_ORIGEN", "SIZE_2"])
    return mapping.project(batch, plan.mappings, DAY)
