"""Queries for the directory snapshot, the department hierarchy and role ownership.

The people tables are built from the benchmark tables: staff from customers, items from orders by priority,
assets from parts, processes and contracts from suppliers.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import functions as F

from snapflow.functions.text import extract_cn, item_label
from snapflow.plans import departments, directory, roles
from snapflow.queries import query, table
from snapflow.session import shared_path
from snapflow.session import small_frame

DAY = "2026-03-02"

# ---------------------------------------------------------------- directory


def directory_entries(spark, sf):
    """Exported directory entries: unit by segment, attributes with ``name: `` prefixes, some missing."""
    key, name = F.col("c_custkey"), F.col("c_name")
    dn = F.concat(F.lit("CN=C"), key, F.lit(",OU="), F.col("c_mktsegment"), F.lit(",OU=Users,DC=example,DC=org"))
    manager = F.when(key % 10 == 0, F.concat(F.lit(" C"), F.floor(key / 7))).otherwise(
        F.concat(F.lit("manager: CN=C"), F.floor(key / 7), F.lit(",OU=Users")))
    attributes = F.map_filter(F.create_map(
        F.lit("sAMAccountName"), F.concat(F.lit("sAMAccountName: C"), key),
        F.lit("givenName"), F.split_part(name, F.lit("#"), F.lit(1)),
        F.lit("sn"), F.when(key % 4 != 0, F.concat(F.lit("sn: "), F.split_part(name, F.lit("#"), F.lit(2)))),
        F.lit("mail"), F.concat(F.lit("mail: c"), key, F.lit("@example.org ")),
        F.lit("department"), F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("DEP"), "c_nationkey")),
        F.lit("manager"), manager), lambda k, v: v.isNotNull())
    return table(spark, sf, "customer").select(dn.alias("dn"), attributes.alias("attributes"))


def _units(spark, sf):
    entries = directory_entries(spark, sf)
    unit = "OU={},OU=Users,DC=example,DC=org".format
    return {
        "building": lambda: directory.map_attributes(directory.people_under(entries, unit("BUILDING"))),
        "one": lambda: directory.map_attributes(directory.people_under(entries, unit("machinery"), "samaccountname: c1")),
        "broken": lambda: spark.table("no_such_directory_export"),
        "furniture": lambda: directory.map_attributes(directory.people_under(entries, unit("FURNITURE"))),
        "users": lambda: directory.map_attributes(directory.people_under(entries, "OU=Users,DC=example,DC=org")),
    }


_ENTRIES = """
    WITH entries AS (SELECT c_mktsegment AS seg, c_custkey AS k, 'sAMAccountName: C' || c_custkey AS account,
        split_part(c_name, '#', 1) AS given_name, CASE WHEN c_custkey % 4 <> 0 THEN 'sn: ' || split_part(c_name, '#', 2) END AS last_name,
        'mail: c' || c_custkey || '@example.org ' AS mail, CASE WHEN c_acctbal >= 0 THEN 'DEP' || c_nationkey END AS department,
        CAST(NULL AS VARCHAR) AS title,
        CASE WHEN c_custkey % 10 = 0 THEN ' C' || (c_custkey // 7) ELSE 'manager: CN=C' || (c_custkey // 7) || ',OU=Users' END AS manager
      FROM customer)
"""
_PERSON = "account, given_name, last_name, mail, department, title, manager"


@query("D1_directory_union", _ENTRIES + f"""
    SELECT {_PERSON} FROM entries WHERE seg = 'BUILDING' UNION ALL
    SELECT {_PERSON} FROM entries WHERE seg = 'MACHINERY' AND k = 1 UNION ALL
    SELECT {_PERSON} FROM entries WHERE seg = 'FURNITURE' UNION ALL SELECT {_PERSON} FROM entries""")
def d1(spark, sf):
    return directory.union_extracts(_units(spark, sf)).rows


def unreadable(spark, schema):
    """A Parquet file that is none: planning accepts it, reading fails."""
    folder = shared_path(spark, "unreadable")
    spark.range(1).select(F.lit("not a table").alias("value")).coalesce(1).write.text(folder)
    return spark.read.schema(schema).parquet(folder)


@query("D1_directory_unreadable", _ENTRIES + f"SELECT {_PERSON} FROM entries WHERE seg = 'BUILDING'")
def d1_unreadable(spark, sf):
    """An extract whose file turns out unreadable while it is read does not stop the others."""
    units = _units(spark, sf)
    broken = ", ".join(f"{c} string" for c in directory.ATTRIBUTES)
    extract = directory.union_extracts({"torn": lambda: unreadable(spark, broken), "building": units["building"]})
    if list(extract.failures) != ["torn"]:
        raise AssertionError(f"failures: {extract.failures}")
    return extract.rows


@query("D2_attribute_mapping", _ENTRIES + f"SELECT {_PERSON} FROM entries")
def d2(spark, sf):
    return directory.map_attributes(directory_entries(spark, sf))


@query("D3_attribute_clean", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || ': b'
        WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS cleaned FROM orders""")
def d3(spark, sf):
    from snapflow.functions.text import clean_attr

    key = F.col("o_orderkey")
    raw = F.when(key % 3 == 0, F.concat(F.lit("status:\t"), "o_orderpriority", F.lit(": b "))).when(
        key % 3 == 1, F.concat(F.lit("  "), "o_orderpriority", F.lit("\n")))
    return table(spark, sf, "orders").select("o_orderkey", clean_attr(raw).alias("cleaned"))


@query("D4_extract_cn", """
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_type WHEN 2 THEN p_brand END AS cn FROM part""")
def d4(spark, sf):
    key = F.col("p_partkey")
    dn = (F.when(key % 4 == 0, F.concat(F.lit("OU=x,CN= "), "p_name", F.lit(" ,OU=CN=y,DC=z")))
          .when(key % 4 == 1, F.concat(F.lit("CN="), "p_type")).when(key % 4 == 2, F.concat(F.lit(" "), "p_brand", F.lit("\t"))))
    return table(spark, sf, "part").select("p_partkey", extract_cn(dn).alias("cn"))


@query("D5_full_name", """
    SELECT c_custkey, coalesce(nullif(trim(coalesce(g, '') || ' ' || coalesce(l, '')), ''), '') AS name FROM (
        SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS g, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS l
        FROM customer)""")
def d5(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select("c_custkey", directory.full_name(
        F.when(key % 3 != 0, F.col("c_mktsegment")), F.when(key % 5 != 0, F.col("c_name"))).alias("name"))


@query("D6_hr_day_load", _ENTRIES + f"""
    SELECT 'C' || k AS id, CASE WHEN last_name IS NULL THEN given_name ELSE given_name || ' ' || replace(last_name, 'sn: ', '') END AS name,
           'c' || k || '@example.org' AS mail, department, 'C' || (k // 7) AS ckmanager, title, TIMESTAMP '{DAY}' AS timestamp
    FROM entries""")
def d6(spark, sf):
    """Load every entry twice for one day; the second load replaces the first."""
    from snapflow.session import shared_path

    name = "d6_hr"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id STRING, name STRING, mail STRING, department STRING, ckmanager STRING, title STRING, "
              f"timestamp TIMESTAMP) USING parquet PARTITIONED BY (timestamp) LOCATION '{shared_path(spark, name)}'")
    people = directory.map_attributes(directory_entries(spark, sf))
    directory.load_hr(spark, people, DAY, name)
    directory.load_hr(spark, people, DAY, name)
    return spark.table(name)


# ---------------------------------------------------------------- people tables

ROLE_NUMBERS = {r.role: r.condition if r.kind == "holds" else 100 + i for i, r in enumerate(roles.RULES)}
UNLISTED = {"Process leader", "Head/Lead"}  # two rules the role table does not know


def people_tables(spark, sf):
    stamp = F.lit(DAY).cast("timestamp")
    before = F.lit("2026-03-01").cast("timestamp")

    def hr():
        c, key = table(spark, sf, "customer"), F.col("c_custkey")
        ids = F.concat(F.lit("C"), key)
        manager = F.when(key == 3, F.lit("C21")).when(key > 0, F.concat(F.lit("C"), F.floor(key / 7)))
        title = (F.when(key == c.select(F.min("c_custkey")).scalar(), F.lit("Country Manager V"))
                 .when(F.col("c_mktsegment") == "MACHINERY", F.lit("Tribe Lead IT"))
                 .when(F.col("c_mktsegment") == "BUILDING", F.lit("Head of Building"))
                 .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("Lead engineer"))
                 .when(F.col("c_mktsegment") == "FURNITURE", F.lit("Analyst")))
        today = c.select(ids.alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("DEP"), "c_nationkey").alias("department"),
                         manager.alias("ckmanager"), title.alias("title"), stamp.alias("timestamp"))
        return today.unionByName(today.filter("title = 'Analyst'").withColumn("title", F.lit("Tribe Lead old"))
                                 .withColumn("timestamp", before))

    def items(priority):
        o, key = table(spark, sf, "orders").filter(F.col("o_orderpriority") == priority), F.col("o_orderkey")
        status = F.col("o_orderstatus")
        return o.select(
            F.concat(F.lit("folder/"), "o_orderpriority", F.lit("/"), key).alias("id"),
            F.when(key % 5 != 0, F.concat(F.lit("Item "), key)).alias("name"), F.lit(None).cast("string").alias("identifier_url"),
            F.when(status == "F", "NOT APPLICABLE").when(status == "O", "APPLICABLE").alias("applicability"),
            F.when(key % 6 != 0, F.concat(F.lit("C"), "o_custkey")).otherwise(F.when(key % 12 == 0, F.lit(" "))).alias("owner"),
            F.when(key % 4 != 0, F.concat(F.lit("C"), F.floor(F.col("o_custkey") / 2))).alias("delegate"),
            F.when(F.col("o_totalprice") > 100000, stamp).otherwise(before).alias("timestamp"))

    def item(priority, prefix, status=None):
        base, key = items(priority), F.element_at(F.split("id", "/"), -1).cast("long")
        out = base.withColumnsRenamed({"owner": f"{prefix}_owner", "delegate": f"delegate_{prefix}_owner"})
        return out if status is None else out.withColumn("status", status(key))

    def by_applicability(no, yes, unknown=None):
        a = F.col("applicability")
        return lambda key: F.when(a == "NOT APPLICABLE", F.lit(no)).when(a == "APPLICABLE", F.lit(yes)).otherwise(F.lit(unknown))

    frames = {
        "hr": hr,
        "risk": lambda: item("1-URGENT", "risk"),
        "control": lambda: item("2-HIGH", "control", lambda k: F.when(k % 3 == 0, "INACTIVE").when(k % 3 == 1, "ACTIVE")),
        "issues": lambda: item("3-MEDIUM", "issue", by_applicability("CLOSED", "OPEN")),
        "action": lambda: item("4-NOT SPECIFIED", "action", by_applicability("CLOSED", "OPEN")),
        "events": lambda: item("5-LOW", "event", by_applicability("CASE CLOSED", "CASE OPEN", "CASE CLOSED"))
        .withColumnRenamed("event_owner", "assigned_to"),
        "arisprocess": lambda: table(spark, sf, "supplier").select(
            F.col("s_name").alias("name"), F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("C"), "s_suppkey")).alias("owner_ck"),
            stamp.alias("timestamp")),
        "cmdb": lambda: table(spark, sf, "part").select(
            F.col("p_partkey").alias("id"), F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("asset_owner"),
            F.when(F.col("p_size") > 10, stamp).otherwise(before).alias("timestamp")),
        "contracts": lambda: table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("C"), "s_nationkey")).alias("owner")),
        "roles": lambda: small_frame(
            spark, [(n, r) for r, n in ROLE_NUMBERS.items() if r not in UNLISTED], "id int, name string"),
        "roles_assignation": lambda: assignations(spark, sf),
        "department2": lambda: table(spark, sf, "nation").filter("n_regionkey > 0").select(
            F.concat(F.lit("DEP"), "n_nationkey").alias("ID"), F.lit("Business").alias("DEPARTMENT_TYPE"), F.lit("COO").alias("DOMAIN")),
    }
    return lru_cache(maxsize=None)(lambda name: frames[name]())


def assignations(spark, sf):
    """Rich customers lead a domain by nation, poor ones hold role 13 or 24, one person holds role 23."""
    c, nation = table(spark, sf, "customer"), F.col("c_nationkey")
    ck = F.concat(F.lit("C"), "c_custkey").alias("CK")
    leads = c.filter("c_acctbal > 9000").select(ck, (F.lit(26) + nation % 7).alias("ID"))
    officers = c.filter("c_acctbal < -500").select(ck, F.when(nation % 2 == 0, 13).otherwise(24).alias("ID"))
    head = c.filter("c_mktsegment = 'BUILDING'").agg(F.min("c_custkey").alias("c_custkey")).select(ck, F.lit(23).alias("ID"))
    return leads.unionByName(officers).unionByName(head)


_ROLE_VALUES = ", ".join("({}, '{}')".format(n, r) for r, n in ROLE_NUMBERS.items() if r not in UNLISTED)


def _item_sql(name, priority, prefix, status="NULL"):
    return f"""
    {name} AS (SELECT 'folder/' || o_orderpriority || '/' || o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN 'Item ' || o_orderkey END AS name,
        CASE o_orderstatus WHEN 'F' THEN 'NOT APPLICABLE' WHEN 'O' THEN 'APPLICABLE' END AS applicability,
        CASE WHEN o_orderkey % 6 <> 0 THEN 'C' || o_custkey WHEN o_orderkey % 12 = 0 THEN ' ' END AS {prefix}_owner,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'C' || (o_custkey // 2) END AS delegate_{prefix}_owner, {status} AS status
      FROM orders WHERE o_orderpriority = '{priority}' AND o_totalprice > 100000)"""


_BY_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'OPEN' END"
PEOPLE_SQL = f"""
    WITH RECURSIVE hr AS (SELECT 'C' || c_custkey AS id, c_custkey AS k, c_name AS name, 'DEP' || c_nationkey AS department,
        CASE WHEN c_custkey = 3 THEN 'C21' WHEN c_custkey > 0 THEN 'C' || (c_custkey // 7) END AS ckmanager,
        CASE WHEN c_custkey = (SELECT min(c_custkey) FROM customer) THEN 'Country Manager V' WHEN c_mktsegment = 'MACHINERY' THEN 'Tribe Lead IT'
             WHEN c_mktsegment = 'BUILDING' THEN 'Head of Building' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Lead engineer'
             WHEN c_mktsegment = 'FURNITURE' THEN 'Analyst' END AS title FROM customer),
    {_item_sql("risk", "1-URGENT", "risk")},
    {_item_sql("control", "2-HIGH", "control", "CASE o_orderkey % 3 WHEN 0 THEN 'INACTIVE' WHEN 1 THEN 'ACTIVE' END")},
    {_item_sql("issues", "3-MEDIUM", "issue", _BY_STATUS)},
    {_item_sql("action", "4-NOT SPECIFIED", "action", _BY_STATUS)},
    {_item_sql("incidents", "5-LOW", "event", "CASE WHEN o_orderstatus = 'O' THEN 'CASE OPEN' ELSE 'CASE CLOSED' END")},
    roles(id, name) AS (VALUES {_ROLE_VALUES}),
    assigned AS (SELECT 'C' || c_custkey AS ck, 26 + c_nationkey % 7 AS id FROM customer WHERE c_acctbal > 9000
        UNION ALL SELECT 'C' || c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 13 ELSE 24 END FROM customer WHERE c_acctbal < -500
        UNION ALL SELECT 'C' || min(c_custkey), 23 FROM customer WHERE c_mktsegment = 'BUILDING'),
    known AS (SELECT 'DEP' || n_nationkey AS id FROM nation WHERE n_regionkey > 0)
"""

# ---------------------------------------------------------------- departments

_LEADS = """
    , leads AS (SELECT ck, max(r.name) AS role FROM assigned a JOIN roles r ON a.id = r.id
                WHERE r.name LIKE '%\\_DomainLead' ESCAPE '\\' GROUP BY ck)
"""
_CHAIN = """
    , chain AS (SELECT id AS start, id AS node, 0 AS depth, [id] AS visited FROM hr
                UNION ALL SELECT start, ckmanager, depth + 1, list_append(visited, ckmanager) FROM chain JOIN hr ON node = id
                WHERE ckmanager IS NOT NULL AND NOT list_contains(visited, ckmanager)),
    chains AS (SELECT start, node, min(depth) AS depth FROM chain GROUP BY start, node)
"""
_NEAREST = _LEADS + _CHAIN + """
    , nearest AS (SELECT start AS node, arg_min(role, depth) AS role, min(depth) AS depth FROM chains JOIN leads ON node = ck GROUP BY start)
"""
_NEW = """
    , fresh AS (SELECT id, department FROM hr WHERE department NOT IN (SELECT id FROM known)),
    one_each AS (SELECT department, min(id) AS node FROM fresh GROUP BY department)
"""


@query("E1_domain_leads", PEOPLE_SQL + _LEADS + "SELECT ck, role FROM leads")
def e1(spark, sf):
    t = people_tables(spark, sf)
    return departments.domain_leads(t("roles_assignation"), t("roles"), t("hr"), DAY)


@query("E2_new_departments", PEOPLE_SQL + _NEW + "SELECT id, department FROM fresh")
def e2(spark, sf):
    t = people_tables(spark, sf)
    return departments.new_departments(t("hr"), t("department2"), DAY)


@query("E2_new_departments_null_id", PEOPLE_SQL + """
    SELECT id, department FROM hr WHERE department NOT IN (SELECT id FROM known UNION ALL SELECT NULL FROM region)""")
def e2_null(spark, sf):
    t = people_tables(spark, sf)
    with_null = t("department2").unionByName(t("department2").withColumn("ID", F.lit(None).cast("string")))
    return departments.new_departments(t("hr"), with_null, DAY)


@query("E3_manager_chain", PEOPLE_SQL + _CHAIN + "SELECT start, node, depth FROM chains")
def e3(spark, sf):
    hr = people_tables(spark, sf)("hr")
    everyone = hr.select(F.col("id").alias("start"))
    return departments.manager_chains(everyone, departments.manager_edges(hr, DAY))


@query("E4_nearest_lead", PEOPLE_SQL + _NEAREST + "SELECT node, role, depth FROM nearest")
def e4(spark, sf):
    t = people_tables(spark, sf)
    leads = departments.domain_leads(t("roles_assignation"), t("roles"), t("hr"), DAY)
    return departments.nearest_leads(departments.manager_edges(t("hr"), DAY), leads)


@query("E5_classify_departments", PEOPLE_SQL + _NEAREST + _NEW + """
    SELECT department AS "ID", CASE split_part(role, '_', 1) WHEN 'CIO' THEN 'IT' ELSE 'Business' END AS "DEPARTMENT_TYPE",
           split_part(role, '_', 1) AS "DOMAIN" FROM one_each JOIN nearest USING (node)""")
def e5(spark, sf):
    t = people_tables(spark, sf)
    return departments.update_departments(t("hr"), t("department2"), t("roles"), t("roles_assignation"), DAY)[0]


@query("E5_department_counts", PEOPLE_SQL + _NEAREST + _NEW + """
    SELECT (SELECT count(*) FROM one_each) AS departments_processed,
           (SELECT count(*) FROM one_each JOIN nearest USING (node)) AS departments_inserted""")
def e5_counts(spark, sf):
    t = people_tables(spark, sf)
    return departments.update_departments(t("hr"), t("department2"), t("roles"), t("roles_assignation"), DAY)[1]


# ---------------------------------------------------------------- roles

# The rules of plans/roles.py, as SQL.
_APPLIES = "(applicability <> 'NOT APPLICABLE' OR applicability IS NULL)"
_ON = "(status <> 'INACTIVE' OR status IS NULL)"
_CEO = "SELECT id FROM hr WHERE lower(title) = 'country manager v'"


def _holders(n):
    return f"SELECT id FROM hr WHERE id IN (SELECT ck FROM assigned WHERE id = {n})"


RULE_SQL = {
    "CEO": _CEO,
    "Domain owner": f"SELECT id FROM hr WHERE ckmanager = ({_CEO})",
    "TribeLead": "SELECT id FROM hr WHERE lower(title) LIKE '%tribe lead%'",
    "Head/Lead": "SELECT id FROM hr WHERE (lower(title) LIKE '%lead%' OR lower(title) LIKE '%head%') AND NOT lower(title) LIKE '%tribe lead%'",
    "Risk owner": f"SELECT risk_owner FROM risk WHERE {_APPLIES}",
    "Risk owner delegate": f"SELECT delegate_risk_owner FROM risk WHERE {_APPLIES}",
    "Control owner": f"SELECT control_owner FROM control WHERE {_APPLIES} AND {_ON}",
    "Control owner delegate": f"SELECT delegate_control_owner FROM control WHERE {_APPLIES} AND {_ON}",
    "Issue owner": "SELECT issue_owner FROM issues WHERE status = 'OPEN'",
    "Issue owner delegate": "SELECT delegate_issue_owner FROM issues WHERE status = 'OPEN'",
    "Action owner": "SELECT action_owner FROM action WHERE status <> 'CLOSED'",
    "Action owner delegate": "SELECT delegate_action_owner FROM action WHERE status <> 'CLOSED'",
    "Process leader": "SELECT 'C' || s_suppkey FROM supplier WHERE s_acctbal >= 0",
    "Asset owner": "SELECT hr.id FROM part JOIN hr ON 'customer#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') = lower(hr.name) WHERE p_size > 10",
    "Event owner": "SELECT event_owner FROM incidents WHERE status = 'CASE OPEN'",
    "CoE IT Risk Officer": _holders(13),
    "BCO Lead": _holders(23),
    "BCOSPOC": "SELECT id FROM hr WHERE ckmanager = (SELECT ck FROM assigned WHERE id = 23)",
    "OCR CoE Lead": _holders(24),
    "COO_DomainLead": _holders(26),
    "RB_DomainLead": _holders(27),
    "HR_DomainLead": _holders(28),
    "WB_DomainLead": _holders(29),
    "CFO_DomainLead": _holders(30),
    "CRO_DomainLead": _holders(31),
    "CIO_DomainLead": _holders(32),
    "Business Contract owner": "SELECT 'C' || s_nationkey FROM supplier WHERE s_acctbal >= 0",
}


def _owners_of(role):
    quoted = role.replace("'", "''")
    return f"SELECT DISTINCT '{quoted}' AS role, owner FROM ({RULE_SQL[role]}) t(owner) WHERE trim(owner) <> ''"


_OWNED = ", owned AS (" + " UNION ALL ".join(_owners_of(r) for r in RULE_SQL) + ")\n"


def _register_rule(number, rule):
    slug = re.sub(r"[^a-z0-9]+", "_", rule.role.lower())

    @query(f"R{number:02d}_{slug}", PEOPLE_SQL + _owners_of(rule.role))
    def run(spark, sf):
        return roles.run_rules(people_tables(spark, sf), DAY, [rule]).owners


for _number, _rule in enumerate(roles.RULES, start=1):
    _register_rule(_number, _rule)


@query("F1_role_ids", PEOPLE_SQL + """
    SELECT role, max(id) AS role_id, count(*) AS n_people FROM (
        SELECT r.name AS role, r.id FROM roles r JOIN assigned a ON r.id = a.id) GROUP BY role""")
def f1(spark, sf):
    """Role ids with the people assigned to each."""
    t = people_tables(spark, sf)
    ids = roles.role_ids(t("roles"))
    held = t("roles_assignation").groupBy(F.col("ID").alias("role_id")).agg(F.count(F.lit(1)).alias("n_people"))
    return ids.join(held, "role_id").select("role", "role_id", "n_people")


@query("F2_rule_owners", PEOPLE_SQL + _OWNED + "SELECT role, owner FROM owned")
def f2(spark, sf):
    return roles.run_rules(people_tables(spark, sf), DAY).owners


@query("F3_owner_roles", PEOPLE_SQL + _OWNED + f"""
    SELECT TIMESTAMP '{DAY}' AS timestamp, owner AS owner_id, r.id AS role_id FROM owned JOIN roles r ON owned.role = r.name""")
def f3(spark, sf):
    return roles.owner_roles(people_tables(spark, sf), DAY).owners


@query("F3_owner_roles_unreadable", PEOPLE_SQL + _OWNED + f"""
    SELECT TIMESTAMP '{DAY}' AS timestamp, owner AS owner_id, r.id AS role_id FROM owned JOIN roles r ON owned.role = r.name
    WHERE owned.role NOT LIKE 'Risk owner%'""")
def f3_unreadable(spark, sf):
    """Rules over a table that turns out unreadable while it is read are left out, and only those."""
    t = people_tables(spark, sf)
    torn = unreadable(spark, t("risk").schema)
    run = roles.owner_roles(lambda name: torn if name == "risk" else t(name), DAY)
    if sorted(run.failures) != ["Risk owner", "Risk owner delegate"]:
        raise AssertionError(f"failures: {run.failures}")
    return run.owners


@query("F4_replace_owner_roles", PEOPLE_SQL + _OWNED + f"""
    SELECT TIMESTAMP '{DAY}' AS timestamp, owner AS owner_id, r.id AS role_id FROM owned JOIN roles r ON owned.role = r.name
    UNION ALL SELECT TIMESTAMP '2026-03-01', id, 1 FROM hr""")
def f4(spark, sf):
    """The day is replaced, the day before stays."""
    from snapflow.operators.snapshot import append
    from snapflow.session import shared_path

    name, t = "f4_owner_role", people_tables(spark, sf)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (owner_id STRING, role_id INT, timestamp TIMESTAMP) USING parquet "
              f"PARTITIONED BY (timestamp) LOCATION '{shared_path(spark, name)}'")
    staff = t("hr").filter(f"timestamp = '{DAY}'").select(F.col("id").alias("owner_id"), F.lit(1).alias("role_id"))
    for day in ("2026-03-01", DAY):
        append(spark, name, staff.withColumn("timestamp", F.lit(day).cast("timestamp")))
    roles.replace_owner_roles(spark, t, DAY, name)
    return spark.table(name)


@query("F5_owner_counts", PEOPLE_SQL + _OWNED + """
    SELECT r.id AS role_id, count(owner) AS owners FROM roles r LEFT JOIN owned ON owned.role = r.name GROUP BY r.id""")
def f5(spark, sf):
    return roles.ownership_counts(people_tables(spark, sf), DAY)


@query("F5_result_counts", PEOPLE_SQL + _OWNED + """
    SELECT (SELECT count(*) FROM roles) AS roles_processed, (SELECT count(*) FROM owned JOIN roles r ON owned.role = r.name) AS total_records""")
def f5_result(spark, sf):
    t = people_tables(spark, sf)
    return roles.result_counts(roles.ownership_counts(t, DAY, run=roles.run_rules(t, DAY)))


@query("F6_item_label", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN 'Item ' || o_orderkey || ' (' || o_orderkey || ')' END AS label
    FROM orders""")
def f6(spark, sf):
    key = F.col("o_orderkey")
    name = F.when(key % 5 != 0, F.concat(F.lit("Item "), key))
    item_id = F.concat(F.lit("a/b c/"), F.when(key % 7 == 0, F.lit("")).otherwise(key.cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", item_label(name, item_id).alias("label"))
