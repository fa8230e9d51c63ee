"""Queries for mapping, load and snapshot steps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.operators import load, mapping, reference, snapshot
from snapflow.queries import query, table

DAY = "1998-10-03"


@query("A11_snapshot_scan", f"""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = TIMESTAMP '{DAY}'""")
def a11(spark, sf):
    return snapshot.on_day(table(spark, sf, "orders"), "o_orderdate", DAY).select("o_orderkey", "o_custkey", "o_totalprice")


@query("A12_latest_snapshot_scan", """
    SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def a12(spark, sf):
    daily = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return snapshot.latest(daily, "day")


@query("C1_day_replace", f"""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate <> TIMESTAMP '{DAY}'
    UNION ALL SELECT o_orderkey, TIMESTAMP '{DAY}', o_totalprice * 2 FROM orders WHERE o_orderstatus = 'F'""")
def c1(spark, sf):
    current = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    batch = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        "o_orderkey", F.lit(DAY).cast("timestamp").alias("o_orderdate"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return snapshot.replace_day(current, batch, "o_orderdate", DAY)


@query("C3_auto_map_projection", """
    SELECT l_orderkey AS "ORDER_KEY", l_partkey AS "PART_KEY", l_quantity AS "CANTIDAD_PIEZAS",
           CAST(NULL AS VARCHAR) AS "REMARK" FROM lineitem""")
def c3(spark, sf):
    batch = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias(" orderKey "), F.col("l_partkey").alias("part-key"),
        F.col("l_quantity").alias("Cantidad  Píezas"), F.col("l_tax").alias("Internal note"))
    target = T.StructType([T.StructField("ORDER_KEY", T.LongType()), T.StructField("PART_KEY", T.LongType()),
                           T.StructField("CANTIDAD_PIEZAS", T.DoubleType()), T.StructField("REMARK", T.StringType())])
    plan = mapping.auto_map(batch.columns, target.names)
    return mapping.conform(mapping.project(batch, plan.mappings, DAY), target)


@query("C3_column_defaults", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 'dump' AS origin, 7 AS rank FROM customer")
def c3_defaults(spark, sf):
    """Columns that nothing is mapped to get their DEFAULT."""
    from snapflow.session import shared_path

    name = "c3_defaults"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id STRING, name STRING, origin STRING DEFAULT 'dump', rank INT DEFAULT 3 + 4) USING parquet "
              f"LOCATION '{shared_path(spark, name)}'")
    batch = table(spark, sf, "customer").select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name"))
    target = spark.table(name)
    plan = mapping.auto_map(batch.columns, target.columns)
    snapshot.append(spark, name, mapping.conform(mapping.project(batch, plan.mappings, DAY), target.schema))
    return spark.table(name)


SUPPLIER = T.StructType([T.StructField("ID", T.StringType()), T.StructField("NAME", T.StringType()),
                         T.StructField("BALANCE", T.DoubleType()), T.StructField("TIMESTAMP", T.TimestampType())])


@query("C4_mapping_normal", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer")
def c4(spark, sf):
    maps = mapping.parse([{"excelColumn": "c_custkey", "dbColumn": "id"}, {"excelColumn": "c_name", "dbColumn": "name"}])
    target = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    return mapping.conform(mapping.project(table(spark, sf, "customer"), maps, DAY), target)


@query("C5_mapping_timestamp", f"""
    SELECT o_orderkey AS id, TIMESTAMP '{DAY}' AS loaded FROM orders""")
def c5(spark, sf):
    maps = mapping.parse([{"excelColumn": "o_orderkey", "dbColumn": "id"}, {"dbColumn": "loaded", "autoGenerate": "timestamp"}])
    return mapping.project(table(spark, sf, "orders"), maps, DAY)


@query("C6_mapping_uuid", """
    SELECT o_orderkey AS id, 36 AS uuid_length, true AS is_v4, CAST(NULL AS VARCHAR) AS unknown_kind FROM orders""")
def c6(spark, sf):
    maps = mapping.parse([{"excelColumn": "o_orderkey", "dbColumn": "id"}, {"dbColumn": "token", "autoGenerate": "UUID"},
                          {"dbColumn": "other", "autoGenerate": "SEQUENCE"}])
    rows = mapping.project(table(spark, sf, "orders"), maps, DAY)
    return rows.select("id", F.length("token").alias("uuid_length"),
                       F.col("token").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("is_v4"),
                       F.col("other").cast("string").alias("unknown_kind"))


@query("C7_mapping_concatenate", """
    SELECT c_custkey, concat_ws('-', CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END, CAST(c_nationkey AS VARCHAR),
                                c_name) AS label FROM customer""")
def c7(spark, sf):
    maps = mapping.parse([{"excelColumn": "c_custkey", "dbColumn": "c_custkey"},
                          {"dbColumn": "label", "concatenate": ["segment", "c_nationkey", "c_name", "absent"], "separator": "-"}])
    batch = table(spark, sf, "customer").withColumn(
        "segment", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit("  ")))
    return mapping.project(batch, maps, DAY)


@query("C2_full_truncate", """
    SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0""")
def c2(spark, sf):
    """Fill a table with every supplier, truncate it, load the batch: only the batch is left."""
    from snapflow.session import shared_path

    name = "c2_supplier"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (s_suppkey BIGINT, s_name STRING) USING parquet LOCATION '{shared_path(spark, name)}'")
    suppliers = table(spark, sf, "supplier")
    snapshot.append(spark, name, suppliers.select("s_suppkey", "s_name"))
    snapshot.clear_all(spark, name)
    snapshot.append(spark, name, suppliers.filter("s_acctbal > 0").select("s_suppkey", "s_name"))
    return spark.table(name)


LINE = T.StructType([T.StructField("ID", T.StringType()), T.StructField("STATUS", T.StringType()),
                     T.StructField("AMOUNT", T.DoubleType()), T.StructField("KIND", T.StringType())])


def _order_batch(spark, sf):
    """Orders keyed by customer (so keys repeat), from two files whose row numbers are the same, with unreadable
    amounts, missing and overlong texts."""
    key = F.col("o_orderkey")
    amount = F.when(key % 11 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("ID"), F.when(key % 13 != 0, F.col("o_orderstatus")).alias("STATUS"),
        amount.alias("AMOUNT"), F.col("o_orderpriority").alias("KIND"),
        F.concat(F.lit("f"), key % 2).alias("_file"), F.floor(key / 2).alias("_row"))


_MARKED = """
    WITH raw AS (SELECT 'C' || o_custkey AS id, o_orderkey AS k, o_totalprice AS amount, o_orderstatus AS status,
                        o_orderpriority AS kind FROM orders),
    checked AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'type' WHEN k % 13 = 0 THEN 'null'
                               WHEN length(kind) > 8 THEN 'length' END AS reason FROM raw),
    winners AS (SELECT k FROM (SELECT k, row_number() OVER (PARTITION BY id ORDER BY k % 2, k // 2) AS rn FROM checked WHERE reason IS NULL
                AND id NOT IN (SELECT 'C' || c_custkey FROM customer WHERE c_acctbal < 0)) WHERE rn = 1),
    marked AS (SELECT c.*, coalesce(c.reason, CASE WHEN w.k IS NULL THEN 'key' END) AS why
               FROM checked c LEFT JOIN winners w ON c.k = w.k)
"""


def _marked(spark, sf):
    held = table(spark, sf, "customer").filter("c_acctbal < 0").select(F.concat(F.lit("C"), "c_custkey").alias("ID"))
    return load.mark_rejects(_order_batch(spark, sf), LINE, primary_key=["ID"], order_by=["_file", "_row"], existing=held,
                             required=["STATUS"], lengths={"KIND": 8})


@query("C8_append_load", _MARKED + """
    SELECT id AS "ID", status AS "STATUS", amount AS "AMOUNT", kind AS "KIND" FROM marked WHERE why IS NULL""")
def c8(spark, sf):
    return load.accepted(_marked(spark, sf), LINE)


@query("C9_bad_row_isolation", _MARKED + """
    SELECT coalesce(why, 'accepted') AS outcome, count(*) AS n_rows, CAST(sum(k // 2) AS BIGINT) AS key_sum FROM marked GROUP BY 1""")
def c9(spark, sf):
    return (_marked(spark, sf).groupBy(F.coalesce(load.REASON, F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_row").alias("key_sum")))


@query("C9_reject_table", _MARKED.replace("AND id NOT IN (SELECT 'C' || c_custkey FROM customer WHERE c_acctbal < 0)", "") + """
    SELECT 'f' || (k % 2) AS file, k // 2 AS number, why AS reason, id, CASE WHEN k % 13 <> 0 THEN status END AS status FROM marked WHERE why IS NOT NULL""")
def c9_table(spark, sf):
    """A job's INSERT writes each refused row with its origin, reason and values."""
    from snapflow.plans.job import run_job
    from snapflow.session import shared_path

    columns = {"c9_lines": "ID STRING, STATUS STRING, AMOUNT DOUBLE, KIND VARCHAR(8)",
               "c9_rejects": "JOB STRING, TABLE_NAME STRING, ROW_KEY STRING, REASON STRING, ROW_VALUES STRING, TIMESTAMP TIMESTAMP"}
    for name, ddl in columns.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{shared_path(spark, name)}'")
    run_job(spark, {"name": "lines", "tasks": [{"name": "load", "type": "PERSISTENCE", "subtasks": [{"name": "insert", "type": "INSERT", "parameters": {
        "tableName": "c9_lines", "primaryKey": ["ID"], "requiredColumns": ["STATUS"], "rejectTable": "c9_rejects"}}]}]}, _order_batch(spark, sf), DAY)
    of = lambda column, name: F.get_json_object(column, f"$.{name}")
    return spark.table("c9_rejects").select(
        of("ROW_KEY", "_file").alias("file"), of("ROW_KEY", "_row").cast("long").alias("number"), F.col("REASON").alias("reason"),
        of("ROW_VALUES", "ID").alias("id"), of("ROW_VALUES", "STATUS").alias("status"))


def _part_table(spark, sf):
    return table(spark, sf, "part").filter("p_size <= 25").select(
        F.col("p_partkey").cast("string").alias("ID"), F.col("p_name").alias("NAME"), F.col("p_retailprice").alias("PRICE"),
        F.col("p_brand").alias("BRAND"))


def _part_batch(spark, sf):
    """Every part, twice for some brands, with new prices; one type has no id."""
    parts = table(spark, sf, "part")
    both = parts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("p_brand") < "Brand#2", 1).otherwise(0))))
    return both.select(F.when(F.col("p_type") != "PROMO", F.col("p_partkey")).alias("ID"),
                       F.concat("p_name", F.lit("!")).alias("NAME"),
                       F.when(F.col("p_size") % 4 != 0, F.col("p_retailprice") + F.col("copy")).alias("PRICE"),
                       (F.col("p_partkey") * 2 + F.col("copy")).alias("_row"))


_PARTS = """
    WITH cur AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_retailprice AS price, p_brand AS brand
                 FROM part WHERE p_size <= 25),
    copies AS (SELECT 0 AS copy UNION ALL SELECT 1),
    batch AS (SELECT CASE WHEN p_type <> 'PROMO' THEN CAST(p_partkey AS VARCHAR) END AS id, p_name || '!' AS name,
                     CASE WHEN p_size % 4 <> 0 THEN p_retailprice + copy END AS price, p_partkey * 2 + copy AS r
              FROM part JOIN copies ON copy = 0 OR p_brand < 'Brand#2'),
    fresh AS (SELECT * FROM batch WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM cur))
"""


@query("C10_skip_existing_load", _PARTS + """
    SELECT id AS "ID", name AS "NAME", price AS "PRICE" FROM fresh""")
def c10(spark, sf):
    fresh = load.new_rows(_part_batch(spark, sf), _part_table(spark, sf), "ID")
    return fresh.select(F.col("ID").cast("string").alias("ID"), "NAME", "PRICE")


@query("C11_upsert_load", _PARTS + """
    , last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r DESC) AS rn FROM batch
                              WHERE id IS NOT NULL) WHERE rn = 1)
    SELECT c.id AS "ID", CASE WHEN l.id IS NULL THEN c.name ELSE l.name END AS "NAME",
           CASE WHEN l.id IS NULL THEN c.price ELSE l.price END AS "PRICE", c.brand AS "BRAND"
    FROM cur c LEFT JOIN last l ON c.id = l.id
    UNION ALL SELECT id, name, price, NULL FROM fresh""")
def c11(spark, sf):
    return load.upsert(_part_table(spark, sf), _part_batch(spark, sf))


@query("C17_select_check", """
    SELECT (SELECT count(*) FROM lineitem) AS answer""")
def c17(spark, sf):
    """The gate's own answer, put back next to the table it looked at."""
    lines = table(spark, sf, "lineitem")
    lines.createOrReplaceTempView("c17_lineitem")
    answer = reference.check_query(spark, "SELECT count(*) FROM c17_lineitem")
    return lines.groupBy().agg(F.lit(answer).cast("long").alias("answer"))


def _day_region(spark, name):
    from snapflow.session import shared_path

    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (ID STRING, AMOUNT DOUBLE, TIMESTAMP TIMESTAMP, REGION STRING) USING parquet PARTITIONED BY (TIMESTAMP, REGION) "
              f"LOCATION '{shared_path(spark, name)}'")


def _amounts(spark, sf, condition, factor=1):
    return table(spark, sf, "orders").filter(condition).select(
        F.col("o_orderkey").cast("string").alias("Id"), (F.col("o_totalprice") * factor).alias("Amount"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("Region"), F.col("o_orderkey").alias("_row"))


@query("C1_day_region_table", """
    SELECT CAST(o_orderkey AS VARCHAR) AS "ID", o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS "AMOUNT",
           CASE o_orderstatus WHEN 'F' THEN TIMESTAMP '2026-03-02' ELSE TIMESTAMP '2026-03-01' END AS "TIMESTAMP",
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS "REGION"
    FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority <> '2-HIGH')""")
def c1_day_region(spark, sf):
    """A job replaces one day of a table partitioned by day and region, with rows that lack one of the day's regions."""
    from snapflow.plans.job import run_job

    name = "c1_day_region"
    _day_region(spark, name)
    spec = {"name": "regions", "tasks": [{"name": "load", "type": "PERSISTENCE", "subtasks": [
        {"name": "clear", "type": "TRUNCATE", "parameters": {"tableName": name, "timestampColumn": "TIMESTAMP"}},
        {"name": "insert", "type": "INSERT", "parameters": {"tableName": name, "mappings": [{"dbColumn": "TIMESTAMP", "autoGenerate": "TIMESTAMP"}]}}]}]}
    for batch, day in ((_amounts(spark, sf, "o_orderstatus = 'O'"), "2026-03-01"), (_amounts(spark, sf, "o_orderstatus = 'P'"), "2026-03-02"),
                       (_amounts(spark, sf, "o_orderstatus = 'F' AND o_orderpriority <> '2-HIGH'", 2), "2026-03-02")):
        run_job(spark, spec, batch, day)
    return spark.table(name)


@query("C11_upsert_partitions", """
    SELECT CAST(o_orderkey AS VARCHAR) AS "ID", o_totalprice * CASE WHEN o_orderstatus = 'O' AND o_orderkey % 10 = 0 THEN 3 ELSE 1 END AS "AMOUNT",
           CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2026-03-02' WHEN o_orderstatus = 'O' THEN TIMESTAMP '2026-03-01' END AS "TIMESTAMP",
           CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN o_orderpriority END AS "REGION" FROM orders
    WHERE o_orderstatus <> 'P' OR o_orderkey % 10 = 0""")
def c11_partitions(spark, sf):
    """An upsert whose ids lie in the regions of one of two days, or are new: only those partitions are rewritten."""
    from snapflow.plans.job import run_job

    name = "c11_partitions"
    _day_region(spark, name)
    stamped = lambda rows, day: rows.select(F.col("Id").alias("ID"), F.col("Amount").alias("AMOUNT"), F.lit(day).cast("timestamp").alias("TIMESTAMP"),
                                            F.col("Region").alias("REGION"))
    snapshot.append(spark, name, stamped(_amounts(spark, sf, "o_orderstatus = 'O'"), "2026-03-01"))
    snapshot.append(spark, name, stamped(_amounts(spark, sf, "o_orderstatus = 'F'"), "2026-03-02"))
    spec = {"name": "prices", "tasks": [{"name": "load", "type": "PERSISTENCE", "subtasks": [
        {"name": "upsert", "type": "INSERT", "parameters": {"tableName": name, "upsertMode": True}}]}]}
    changed = _amounts(spark, sf, "o_orderkey % 10 = 0 AND o_orderstatus = 'O'", 3).unionByName(_amounts(spark, sf, "o_orderkey % 10 = 0 AND o_orderstatus = 'P'"))
    run_job(spark, spec, changed.drop("Region"), "2026-03-03")
    return spark.table(name)


@query("C13_several_checks", """
    WITH good AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal > 0),
    batch AS (SELECT o_orderkey AS k, 'C' || o_custkey AS a, CASE WHEN o_orderkey % 3 <> 0 THEN 'C' || (o_custkey + 1) END AS b,
                     CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE 'C' || (o_custkey * 2) END AS c FROM orders)
    SELECT k, CASE WHEN a IN (SELECT id FROM good) THEN a ELSE '' END AS a, CASE WHEN b IS NULL OR b IN (SELECT id FROM good) THEN b ELSE '' END AS b,
           CASE WHEN c = ' ' OR c IN (SELECT id FROM good) THEN c ELSE '' END AS c,
           (CASE WHEN a IN (SELECT id FROM good) THEN 0 ELSE 1 END) + (CASE WHEN b IS NULL OR b IN (SELECT id FROM good) THEN 0 ELSE 1 END)
           + (CASE WHEN c = ' ' OR c IN (SELECT id FROM good) THEN 0 ELSE 1 END) AS cleared FROM batch""")
def c13_several(spark, sf):
    """Three fields against one set of ids, in one join."""
    people = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.concat(F.lit("C"), "c_custkey").alias("ID"), F.lit(DAY).cast("timestamp").alias("TIMESTAMP"))
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    batch = table(spark, sf, "orders").select(
        key.alias("k"), F.concat(F.lit("C"), customer).alias("a"), F.when(key % 3 != 0, F.concat(F.lit("C"), customer + 1)).alias("b"),
        F.when(key % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit("C"), customer * 2)).alias("c"))
    checks = [reference.Check(f, "people", people, log_column=f"_{f}") for f in "abc"]
    flagged = reference.flag_references(batch, checks, DAY, uid="k")
    cleared = sum((F.col(f"_{f}").isNotNull().cast("int") for f in "abc"), F.lit(0))
    return flagged.select("k", "a", "b", "c", cleared.alias("cleared"))
