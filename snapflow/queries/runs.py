"""Queries for job runs, the run log and file drops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.plans import job, runlog, shapes
from snapflow.queries import query, table
from snapflow.queries.links import DAY, customer_ids, order_batch, parent_tables
from snapflow.session import shared_path
from snapflow.streaming.filedrop import ingest_drops, outcomes

# ---------------------------------------------------------------- run log built from events


def _log(spark, sf):
    """Events as log lines: user and day make a run of jobs, the event type gives the level, some lines are a step's."""
    kind, user = F.col("event_type"), F.col("user_id")
    level = F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").when(kind == "view", "TRACE").otherwise("INFO")
    name = F.concat(F.lit("job-"), user % 40, F.when(user % 3 == 0, "-ES").when(user % 3 == 1, "_fr").otherwise("-import"))
    step = F.when(F.col("event_id") % 4 == 0, F.lit("load"))
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run"), name.alias("job"), F.when(step.isNotNull(), "persist").alias("task"),
        step.alias("step"), F.col("ts").alias("timestamp"), level.alias("level"), F.coalesce(step, name).alias("source"),
        F.concat("event_type", F.lit(" "), "event_id").alias("message"), "event_type", "value")


def _tasks(spark, sf):
    """One task per run, job and event type; it failed when its lowest value is below 1."""
    return _log(spark, sf).groupBy("run", "job", F.col("event_type").alias("task")).agg(
        F.when(F.min("value") < 1, "FAILED").otherwise("SUCCESS").alias("status"))


def _jobs(spark, sf):
    """One job per run and name with status, bounds and counters."""
    log = _log(spark, sf)
    per_job = log.groupBy("run", "job").agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("step").isNotNull()).alias("failed"), F.lit(0).cast("long").alias("skipped"))
    status = runlog.job_status(_tasks(spark, sf))
    counts = runlog.message_counts(log)
    joined = per_job.join(status, ["run", "job"]).join(counts, ["run", "job"], "left")
    return joined.select("run", "job", F.concat(F.lit("/drop/"), "run", F.lit("-"), "job", F.lit(".xlsx")).alias("file_path"),
                         F.lit("EXCEL").alias("file_type"), "status", "start_time", "end_time", "processed", "failed", "skipped",
                         F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"))


_LOG_SQL = """
    WITH log AS (SELECT strftime(ts, '%Y-%m-%d') AS run,
        'job-' || (user_id % 40) || CASE user_id % 3 WHEN 0 THEN '-ES' WHEN 1 THEN '_fr' ELSE '-import' END AS job,
        CASE WHEN event_id % 4 = 0 THEN 'load' END AS step, ts, event_type AS et, value AS v, event_id AS id,
        CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'view' THEN 'TRACE' ELSE 'INFO' END AS level FROM events),
    tasks AS (SELECT run, job, et AS task, CASE WHEN min(v) < 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM log GROUP BY run, job, et),
    states AS (SELECT run, job, CASE WHEN bool_and(status = 'SUCCESS') THEN 'SUCCESS' WHEN bool_and(status = 'FAILED') THEN 'FAILED'
                                     ELSE 'PARTIAL' END AS status FROM tasks GROUP BY run, job),
    jobs AS (SELECT run, job, any_value(s.status) AS status, min(ts) AS start_time, max(ts) AS end_time, count(*) AS processed,
                    count(step) AS failed, count(*) FILTER (step IS NULL AND level = 'ERROR') AS errors,
                    count(*) FILTER (step IS NULL AND level = 'WARN') AS warnings,
                    epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000 AS duration_ms
             FROM log JOIN states s USING (run, job) GROUP BY run, job)
"""


@query("G4_job_status", _LOG_SQL + "SELECT run, job, status FROM states")
def g4(spark, sf):
    return runlog.job_status(_tasks(spark, sf))


@query("G5_run_status", _LOG_SQL + """
    SELECT run, CASE WHEN bool_and(status = 'SUCCESS') THEN 'SUCCESS' WHEN bool_and(status = 'FAILED') THEN 'FAILED' ELSE 'PARTIAL' END AS status
    FROM jobs GROUP BY run""")
def g5(spark, sf):
    return runlog.run_status(_jobs(spark, sf))


@query("G6_run_totals", _LOG_SQL + """
    SELECT run, count(*) AS total_jobs, count(*) FILTER (status = 'SUCCESS') AS successful_jobs, count(*) FILTER (status = 'FAILED') AS failed_jobs,
           count(*) FILTER (status = 'PARTIAL') AS partial_jobs, CAST(sum(processed) AS BIGINT) AS total_processed,
           CAST(sum(failed) AS BIGINT) AS total_failed, CAST(0 AS BIGINT) AS total_skipped, CAST(sum(errors) AS BIGINT) AS total_errors,
           CAST(sum(warnings) AS BIGINT) AS total_warnings, count(*) FILTER (status = 'SUCCESS') / count(*) * 100.0 AS success_rate
    FROM jobs GROUP BY run""")
def g6(spark, sf):
    return runlog.run_totals(_jobs(spark, sf))


@query("G7_run_bounds", _LOG_SQL + """
    SELECT run, min(start_time) AS start_time, max(end_time) AS end_time,
           epoch_us(max(end_time)) // 1000 - epoch_us(min(start_time)) // 1000 AS duration_ms FROM jobs GROUP BY run""")
def g7(spark, sf):
    return runlog.run_bounds(_jobs(spark, sf))


@query("G8_job_summary", _LOG_SQL + """
    SELECT run, job, '/drop/' || run || '-' || job || '.xlsx' AS file_path, 'EXCEL' AS file_type, status, duration_ms, processed, failed,
           CAST(0 AS BIGINT) AS skipped, errors FROM jobs""")
def g8(spark, sf):
    return runlog.job_summary(_jobs(spark, sf))


@query("G9_errors_and_warnings", _LOG_SQL + """
    SELECT run, job, level, et || ' ' || id AS message FROM log WHERE step IS NULL AND level IN ('ERROR', 'WARN')""")
def g9(spark, sf):
    log = _log(spark, sf)
    both = runlog.messages(log, "ERROR").unionByName(runlog.messages(log, "WARN"))
    return both.select("run", "job", "level", "message")


@query("G10_execution_log", _LOG_SQL + """
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS "TIMESTAMP", level AS "SEVERITY", coalesce(step, job) AS "STEP", et || ' ' || id AS "MESSAGE" FROM log""")
def g10(spark, sf):
    return runlog.execution_log(_log(spark, sf))


@query("G11_log_by_dataset", _LOG_SQL + """
    SELECT dataset, level, count(*) AS n FROM (
        SELECT CASE WHEN job LIKE '%-import' THEN job ELSE left(job, length(job) - 3) END AS dataset, level FROM log)
    GROUP BY dataset, level""")
def g11(spark, sf):
    return runlog.log_by_dataset(_log(spark, sf)).groupBy("dataset", "level").agg(F.count(F.lit(1)).alias("n"))


@query("G12_worst_status", _LOG_SQL + """
    SELECT dataset, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' WHEN bool_or(status = 'PARTIAL') THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
    FROM (SELECT CASE WHEN job LIKE '%-import' THEN job ELSE left(job, length(job) - 3) END AS dataset, status FROM jobs) GROUP BY dataset""")
def g12(spark, sf):
    jobs = _jobs(spark, sf).withColumn("dataset", runlog.dataset_group("job"))
    return runlog.worst_status(jobs)


@query("G13_summary_csv", _LOG_SQL + """
    SELECT job AS "Job Name", '/drop/' || run || '-' || job || '.xlsx' AS "File Path", 'EXCEL' AS "File Type", status AS "Status",
           duration_ms AS "Duration (ms)", processed AS "Records Processed", failed AS "Records Failed" FROM jobs""")
def g13(spark, sf):
    """Written as CSV and read back."""
    jobs, path = _jobs(spark, sf), shared_path(spark, "csv")
    runlog.write_summary_csv(jobs, path)
    return spark.read.schema(runlog.summary_csv(jobs).schema).option("header", True).csv(path)


# ---------------------------------------------------------------- job runs

def _spec(prefix):
    return shapes.entity_job(
        "order-import", "Orders-XX", f"{prefix}_orders", "Order", id_parts=["Folder", "Number"], columns={"o_totalprice": "AMOUNT"},
        owners=["Owner"], people=f"{prefix}_people", log=f"{prefix}_log", parent=["Parent_Path", "Parent_Objects", "Parent_Type"],
        rules=[shapes.parent_rule("Part", f"{prefix}_parts", f"{prefix}_edges", "Part")])


def _create(spark, name, columns, partition=None):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet" + (f" PARTITIONED BY ({partition})" if partition else "")
              + f" LOCATION '{shared_path(spark, name)}'")


def _prepare(spark, sf, prefix):
    _create(spark, f"{prefix}_orders", "ID STRING, OWNER STRING, AMOUNT DOUBLE, NUMBER STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP")
    _create(spark, f"{prefix}_edges", "ID_1 STRING, ID_2 STRING, TIMESTAMP TIMESTAMP")
    _create(spark, f"{prefix}_log", "WHERE_A STRING, A STRING, WHERE_B STRING, B STRING, CAUSE STRING, ACTION STRING, TIMESTAMP TIMESTAMP")
    customer_ids(spark, sf).createOrReplaceTempView(f"{prefix}_people")
    parent_tables(spark, sf)("PARTS").createOrReplaceTempView(f"{prefix}_parts")


def _batch(spark, sf):
    """Orders that name a part by their number as parent; every other order names an unknown kind or none."""
    number = F.col("Number").cast("long")
    return order_batch(spark, sf).withColumns({
        "Parent_Path": F.lit("parts"), "Parent_Objects": F.floor(number / 4).cast("string"),
        "Parent_Type": F.when(number % 3 == 0, " Part ").when(number % 3 == 1, "Place"), "_row": number})


_RUN_SQL = f"""
    WITH good AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal > 0),
    parts AS (SELECT 'parts/' || p_partkey AS id FROM part WHERE p_size > 10),
    batch AS (SELECT o_orderpriority || '/' || o_orderkey AS id, o_orderkey AS k, o_totalprice,
        CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'C' || o_custkey END AS owner,
        'parts/' || (o_orderkey // 4) AS parent FROM orders),
    loaded AS (SELECT b.id AS "ID", CASE WHEN owner IS NULL THEN NULL WHEN g.id IS NULL THEN '' ELSE owner END AS "OWNER",
        o_totalprice AS "AMOUNT", CAST(k AS VARCHAR) AS "NUMBER", TIMESTAMP '{DAY}' AS "TIMESTAMP" FROM batch b LEFT JOIN good g ON b.owner = g.id)
"""


@query("G2_job_run", _RUN_SQL + "SELECT * FROM loaded")
def g2(spark, sf):
    """A whole spec, run twice for one day: the second run replaces the first."""
    _prepare(spark, sf, "g2")
    for _ in range(2):
        job.run_job(spark, _spec("g2"), _batch(spark, sf), DAY)
    return spark.table("g2_orders")


@query("G14_step_counters", _RUN_SQL + """
    SELECT 'cleared' AS counter, count(*) AS value FROM batch b LEFT JOIN good g ON b.owner = g.id WHERE owner <> '' AND g.id IS NULL
    UNION ALL SELECT 'processed', count(*) FROM batch UNION ALL SELECT 'inserted', count(*) FROM batch UNION ALL SELECT 'failed', 0
    UNION ALL SELECT 'updated', 0
    UNION ALL SELECT 'linked', count(*) FROM batch JOIN parts p ON parent = p.id WHERE k % 3 = 0
    UNION ALL SELECT 'missing', count(*) FROM batch LEFT JOIN parts p ON parent = p.id WHERE k % 3 = 0 AND p.id IS NULL
    UNION ALL SELECT 'unknown', count(*) FROM batch WHERE k % 3 = 1""")
def g14(spark, sf):
    _prepare(spark, sf, "g14")
    result = job.run_job(spark, _spec("g14"), _batch(spark, sf), DAY)
    return job.RunReport("one", [result], spark).counters().select("counter", "value")


@query("G2_full_load_job", """
    SELECT CAST(c_custkey AS VARCHAR) AS "ID", upper(c_name) AS "NAME", upper(c_name) || '/' || c_mktsegment AS "LABEL" FROM customer
    WHERE c_mktsegment <> 'FURNITURE'""")
def g2_full(spark, sf):
    """Full load: rows without a segment are dropped, text is upper-cased, a second run replaces the first."""
    _create(spark, "g2f_customer", "ID STRING, NAME STRING, LABEL STRING")
    spec = shapes.full_load_job("full", "Customers", "g2f_customer", {"Key": "ID"}, required="Segment", upper=True,
                                mappings=[{"dbColumn": "LABEL", "concatenate": ["Name", "Segment"], "separator": "/"}])
    batch = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Key"), F.concat(F.lit(" "), "c_name").alias("Name"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.lower("c_mktsegment")).otherwise(F.lit(" ")).alias("Segment"),
        F.col("c_custkey").alias("_row"))
    for _ in range(2):
        job.run_job(spark, spec, batch, DAY)
    return spark.table("g2f_customer")


@query("G2_lookup_load_job", """
    SELECT CAST(o_orderkey AS VARCHAR) AS "ID", CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS "OWNER"
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""")
def g2_lookup(spark, sf):
    """Contracts-like load: owner mail to owner id through the newest people snapshot, sentinel to NULL."""
    _create(spark, "g2l_contracts", "ID STRING, OWNER STRING")
    people = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("C"), "c_custkey", F.lit("@Example.org")).alias("mail"), F.col("c_custkey").alias("id"), F.lit(DAY).cast("timestamp").alias("timestamp"))
    older = people.withColumn("id", F.lit(-1).cast("long")).withColumn("timestamp", F.lit("2026-03-01").cast("timestamp"))
    people.unionByName(older).createOrReplaceTempView("g2l_people")
    spec = shapes.lookup_load_job("contracts", "Contracts", "g2l_contracts", "Owner", "g2l_people", "mail", "id", {"Key": "ID", "Owner": "OWNER"})
    batch = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Key"), F.when(F.col("o_orderstatus") == "P", F.lit(" Unknown")).otherwise(
            F.concat(F.lit("c"), "o_custkey", F.lit("@EXAMPLE.org "))).alias("Owner"), F.col("o_orderkey").alias("_row"))
    job.run_job(spark, spec, batch, DAY)
    return spark.table("g2l_contracts")


@query("G2_new_rows_job", """
    SELECT CAST(p_partkey AS VARCHAR) AS "ID", CASE WHEN p_size > 25 THEN p_name ELSE upper(p_name) END AS "NAME" FROM part""")
def g2_new(spark, sf):
    """Half of the parts are loaded first, then all of them are offered in capitals: only missing ids are taken."""
    _create(spark, "g2n_parts", "ID STRING, NAME STRING")
    spec = shapes.new_rows_job("new", "Parts", "g2n_parts", {"Key": "ID"})
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("Key"), F.col("p_name").alias("Name"), "p_size", F.col("p_partkey").alias("_row"))
    job.run_job(spark, spec, parts.filter("p_size > 25").drop("p_size"), DAY)
    job.run_job(spark, spec, parts.withColumn("Name", F.upper("Name")).drop("p_size"), DAY)
    return spark.table("g2n_parts")


@query("G2_sheets_upsert_job", f"""
    SELECT 'customer' AS sheet, CAST(c_custkey AS VARCHAR) AS "ID", CASE WHEN c_acctbal > 0 THEN upper(c_name) ELSE c_name END AS "NAME",
           CASE WHEN c_acctbal > 0 THEN TIMESTAMP '{DAY}' ELSE TIMESTAMP '2026-03-01' END AS "TIMESTAMP" FROM customer
    UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name, TIMESTAMP '{DAY}' FROM supplier""")
def g2_sheets(spark, sf):
    """Two sheets into two tables; a second dump changes the customers in credit."""
    for name in ("g2s_customer", "g2s_supplier"):
        _create(spark, name, "ID STRING, NAME STRING, TIMESTAMP TIMESTAMP")
    spec = shapes.sheets_upsert_job("chain", "ValueChain")
    people = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("Id"), F.col("c_name").alias("Name"), "c_acctbal", F.col("c_custkey").alias("_row"))
    firms = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("Id"), F.col("s_name").alias("Name"), F.col("s_suppkey").alias("_row"))
    job.run_job(spark, spec, {"g2s_customer": people.drop("c_acctbal")}, "2026-03-01")
    richer = people.filter("c_acctbal > 0").withColumn("Name", F.upper("Name")).drop("c_acctbal")
    job.run_job(spark, spec, {"g2s_customer": richer, "g2s_supplier": firms}, DAY)
    both = spark.table("g2s_customer").withColumn("sheet", F.lit("customer"))
    return both.unionByName(spark.table("g2s_supplier").withColumn("sheet", F.lit("supplier")))


@query("G2_jobs_at_once", """
    SELECT 'customers' AS job, 'SUCCESS' AS status, CAST(c_custkey AS VARCHAR) AS "ID" FROM customer
    UNION ALL SELECT 'suppliers', 'SUCCESS', CAST(s_suppkey AS VARCHAR) FROM supplier
    UNION ALL SELECT 'parts', 'SUCCESS', CAST(p_partkey AS VARCHAR) FROM part""")
def g2_at_once(spark, sf):
    """Three specs at once, two of which replace their table while the third fills its own day."""
    keys = {"customers": ("customer", "c_custkey"), "suppliers": ("supplier", "s_suppkey"), "parts": ("part", "p_partkey")}
    specs = []
    for name in keys:
        _create(spark, f"g2p_{name}", "ID STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP" if name == "parts" else None)
        clear = {"timestampColumn": "TIMESTAMP"} if name == "parts" else {}
        specs.append(shapes.job(name, name, [shapes.step("trim", "TRIM")], [
            shapes.step("clear", "TRUNCATE", tableName=f"g2p_{name}", **clear), shapes.step("load", "INSERT", tableName=f"g2p_{name}", mappings=[shapes.STAMP])]))

    def opened(spec):
        source, key = keys[spec["name"]]
        return table(spark, sf, source).select(F.col(key).cast("string").alias("Id"), F.col(key).alias("_row")), DAY, "N/A"

    for _ in range(2):
        report = job.run_jobs(spark, specs, opened, parallel=3)
    rows = reduce(DataFrame.unionByName, [spark.table(f"g2p_{n}").select(F.lit(n).alias("job"), "ID") for n in keys])
    return report.jobs().select("job", "status").join(rows, "job")


@query("H1_file_drop_ingestion", """
    SELECT CAST(o_orderkey AS VARCHAR) AS "ID", CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 1 END * o_totalprice AS "AMOUNT",
           CASE o_orderstatus WHEN 'O' THEN TIMESTAMP '2026-03-03' ELSE TIMESTAMP '2026-03-02' END AS "TIMESTAMP"
    FROM orders WHERE o_orderstatus <> 'P'""")
def h1(spark, sf):
    """A file whose job is through in part first and is loaded by the next call; a dump and its correction that arrive
    together, the correction later though its name sorts first: one job for their day."""
    drop, state, name = shared_path(spark, "drop"), shared_path(spark, "state"), "h1_orders"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spec = shapes.job("drop-import", "Orders", [shapes.step("trim", "TRIM")], [
        shapes.step("clear", "TRUNCATE", tableName=name, timestampColumn="TIMESTAMP"), shapes.step("insert", "INSERT", tableName=name, mappings=[shapes.STAMP])])
    orders = table(spark, sf, "orders")

    def put(file, status, factor):
        rows = orders.filter(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").cast("string").alias("Id"), (F.col("o_totalprice") * factor).alias("Amount"))
        target = shared_path(spark, "part")
        rows.coalesce(1).write.parquet(target)
        move(spark, target, f"{drop}/{file}.parquet")
        return rows.schema

    schema = put("2026-03-03-orders", "O", 1)
    first = ingest_drops(spark, spec, drop, state, schema=schema)  # the table is not there yet
    _create(spark, name, "ID STRING, AMOUNT DOUBLE, TIMESTAMP TIMESTAMP", "TIMESTAMP")
    put("2026-03-02-orders", "P", 1)
    put("2026-03-02-orders-corrected", "F", 3)
    second = ingest_drops(spark, spec, drop, state, schema=schema)
    third = ingest_drops(spark, spec, drop, state, schema=schema)
    ends = [[r.status for r in call] for call in (first, second, third)]
    if ends != [["PARTIAL"], ["SUCCESS"] * 2, []]:
        raise AssertionError(f"outcomes: {ends}")
    return spark.table(name)


@query("H1_drop_outcomes", """
    SELECT * FROM (VALUES ('2026-03-02-a.parquet', DATE '2026-03-02', 'SUPERSEDED'), ('2026-03-02-b.parquet', DATE '2026-03-02', 'SUCCESS'),
                          ('2026-03-03-a.parquet', DATE '2026-03-03', 'SUCCESS')) AS t (file, day, status)
    CROSS JOIN (SELECT count(*) AS loaded FROM part WHERE p_size <> 1)""")
def h1_outcomes(spark, sf):
    """The ledger after two days were loaded at once, beside the number of rows in the table."""
    drop, state, name = shared_path(spark, "drop"), shared_path(spark, "state"), "h1o_parts"
    _create(spark, name, "ID STRING, NAME STRING, TIMESTAMP TIMESTAMP", "TIMESTAMP")
    spec = shapes.job("part-import", "Parts", [shapes.step("trim", "TRIM")], [
        shapes.step("clear", "TRUNCATE", tableName=name, timestampColumn="TIMESTAMP"), shapes.step("insert", "INSERT", tableName=name, mappings=[shapes.STAMP])])
    parts = table(spark, sf, "part")
    for file, some in (("2026-03-02-a", "p_size = 1"), ("2026-03-02-b", "p_size BETWEEN 2 AND 20"), ("2026-03-03-a", "p_size > 20")):
        target = shared_path(spark, "part")
        rows = parts.filter(some).select(F.col("p_partkey").cast("string").alias("Id"), F.col("p_name").alias("Name"))
        rows.coalesce(1).write.parquet(target)
        move(spark, target, f"{drop}/{file}.parquet")
    ingest_drops(spark, spec, drop, state, schema=rows.schema, parallel=2)
    lines = outcomes(spark, state).select(F.element_at(F.split("path", "/"), -1).alias("file"), "day", "status")
    return lines.crossJoin(spark.table(name).agg(F.count("*").alias("loaded")))


def move(spark, folder, target):
    """Publish the one data file of a folder under its drop name, as a producer does."""
    jvm = spark.sparkContext._jvm
    source, goal = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(target)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(goal.getParent())
    part = next(s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    fs.rename(part, goal)
