"""Department classification by the nearest domain lead in the manager hierarchy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.text import has_text
from snapflow.operators.joins import probe, text_ids
from snapflow.operators.mapping import conform
from snapflow.operators.snapshot import append, on_day
from snapflow.session import discard, settled

# Fixed values.
DOMAIN_LEAD_ROLES = [
    "COO_DomainLead", "RB_DomainLead", "HR_DomainLead", "WB_DomainLead",
    "CFO_DomainLead", "CRO_DomainLead", "CIO_DomainLead",
]


def domain_leads(roles_assignation: DataFrame, roles: DataFrame, hr: DataFrame, day: dt.date | str) -> DataFrame:
    """``(ck, role)``: one lead role per person of the day; of several, the largest name."""
    lead_roles = roles.filter(F.col("name").isin(DOMAIN_LEAD_ROLES)).select(F.col("id").alias("_role_id"), "name")
    holders = roles_assignation.select(F.col("CK").alias("ck"), F.col("ID").alias("_role_id")).join(lead_roles, "_role_id")
    one_role = holders.groupBy("ck").agg(F.max("name").alias("role"))
    present = on_day(hr, "timestamp", day).select(F.col("id").alias("ck"))
    return one_role.join(present, "ck", "left_semi")


def new_departments(hr: DataFrame, departments: DataFrame, day: dt.date | str, null_aware: bool = True) -> DataFrame:
    """Distinct ``(id, department)`` of the day whose department is not classified yet.

    ``null_aware``: a NULL id in ``departments`` suppresses every row, as SQL ``NOT IN`` does. The test is
    one scalar, so the join itself stays a plain anti join that shuffles instead of needing a broadcast.
    """
    staff = on_day(hr, "timestamp", day).filter(F.col("department").isNotNull()).select("id", "department")
    if null_aware:
        nulls = departments.select(F.count_if(F.col("ID").isNull())).scalar()
        staff = staff.filter(nulls == 0)
    return probe(staff, text_ids(departments, "ID"), F.col("department"), "_id", "left_anti").distinct()


def manager_edges(hr: DataFrame, day: dt.date | str) -> DataFrame:
    """``(node, parent)``, one row per person of the day; a blank manager is no manager.
    A person listed several times gets the smallest manager."""
    edges = on_day(hr, "timestamp", day).filter(F.col("id").isNotNull()).groupBy(F.col("id").alias("node")).agg(
        F.min("ckmanager").alias("parent"))
    return edges.select("node", F.when(has_text("parent"), F.col("parent")).alias("parent"))


def manager_chains(starts: DataFrame, edges: DataFrame, max_nodes: int | None = None, scratch: list[str] | None = None) -> DataFrame:
    """``(start, node, depth)``: every start with its managers up the tree, itself at depth 0.

    A chain ends at a missing or unknown manager or at a node seen before, however long it is; ``max_nodes`` cuts it
    earlier if given.

    Only the wanted starts are followed. Jump pointers double each round: a pointer of round k leads 2**k levels up,
    one row per person, and moves every known node of a chain that many levels at once, so 50 levels take six joins.
    The work ends with the round that adds no new node to any chain, which also ends cycles.
    """
    mine: list[str] = [] if scratch is None else scratch
    wanted = starts.select("start").filter("start IS NOT NULL").distinct()
    known = settled(wanted.select("start", F.col("start").alias("node"), F.lit(0).alias("depth")), mine)
    jumps, reach = edges.filter("parent IS NOT NULL").select("node", "parent"), 1
    while max_nodes is None or reach < max_nodes:
        above = jumps.select(F.col("node").alias("_below"), "parent")
        moved = probe(known, above, F.col("node"), "_below").filter("parent IS NOT NULL").select(
            "start", F.col("parent").alias("node"), (F.col("depth") + reach).alias("depth"))
        fresh = moved.groupBy("start", "node").agg(F.min("depth").alias("depth")).join(
            known.select("start", "node"), ["start", "node"], "left_anti")
        if max_nodes is not None:
            fresh = fresh.filter(F.col("depth") < max_nodes)
        fresh = settled(fresh, mine)
        if fresh.isEmpty():
            break
        known, reach = known.unionByName(fresh), 2 * reach
        beyond = jumps.select(F.col("node").alias("_below"), F.col("parent").alias("_next"))
        jumps = settled(probe(jumps, beyond, F.col("parent"), "_below").filter("_next IS NOT NULL").select("node", F.col("_next").alias("parent")), mine)
    if scratch is None:
        known = settled(known)
        discard(edges.sparkSession, mine)
    return known


def nearest_leads(edges: DataFrame, leads: DataFrame, max_nodes: int | None = None, scratch: list[str] | None = None) -> DataFrame:
    """``(node, role, depth)``: nearest lead at or above each person; within ``max_nodes`` nodes, if given.

    The answer of a person without a lead of their own is the answer of their manager, so pointers double:
    after round k a person has looked 2**k levels up, and 50 levels take six joins. Only people still looking
    are joined and written again. Above whoever is d levels below their lead stand people at every smaller distance,
    so the work ends with the round that finds no lead: nobody is further away, and who is still looking has none,
    which also ends cycles.
    """
    mine: list[str] = [] if scratch is None else scratch
    looking = F.col("role").isNull() & F.col("pointer").isNotNull()
    state = settled(probe(edges, leads.select("ck", "role"), F.col("node"), "ck").select(
        "node", F.when(F.col("role").isNull(), F.col("parent")).alias("pointer"), F.lit(1).alias("hops"),
        "role", F.when(F.col("role").isNotNull(), F.lit(0)).alias("depth")), mine)
    done, active, looked = state.filter(~looking), state.filter(looking), 1
    while (max_nodes is None or looked < max_nodes) and not active.isEmpty():
        above = done.unionByName(active).select(
            F.col("node").alias("_above"), F.struct("pointer", "hops", "role", "depth").alias("_up"))
        moved = settled(probe(active, above, F.col("pointer"), "_above").select(
            "node", F.when(F.col("_up.role").isNull(), F.col("_up.pointer")).alias("pointer"),
            (F.col("hops") + F.coalesce("_up.hops", F.lit(0))).alias("hops"),
            F.col("_up.role").alias("role"), (F.col("hops") + F.col("_up.depth")).alias("depth")), mine)
        if moved.filter(F.col("role").isNotNull()).isEmpty():
            break
        done, active = done.unionByName(moved.filter(~looking)), moved.filter(looking)
        looked *= 2
    found = done.filter(F.col("role").isNotNull()).select("node", "role", "depth")
    if max_nodes is not None:
        found = found.filter(F.col("depth") < max_nodes)
    if scratch is None:
        found = settled(found)
        discard(edges.sparkSession, mine)
    return found


def classify(new_staff: DataFrame, nearest: DataFrame) -> DataFrame:
    """``(ID, DEPARTMENT_TYPE, DOMAIN)`` for each new department, from its smallest employee id.
    Departments without a lead above that employee give no row."""
    one_each = new_staff.groupBy("department").agg(F.min("id").alias("node"))
    domain = F.split_part("role", F.lit("_"), F.lit(1))
    return one_each.join(nearest, "node").select(
        F.col("department").alias("ID"), F.when(domain == "CIO", "IT").otherwise("Business").alias("DEPARTMENT_TYPE"),
        domain.alias("DOMAIN"))


def update_departments(hr: DataFrame, departments: DataFrame, roles: DataFrame, roles_assignation: DataFrame,
                       day: dt.date | str, null_aware: bool = True, scratch: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows to append to the department table, and the counts (processed, inserted) as a one-row frame."""
    staff = settled(new_departments(hr, departments, day, null_aware), scratch)
    leads, rounds = domain_leads(roles_assignation, roles, hr, day), []
    inserts = settled(classify(staff, nearest_leads(manager_edges(hr, day), leads, scratch=rounds)), scratch)
    discard(hr.sparkSession, rounds)
    counts = staff.select(F.count_distinct("department").alias("departments_processed")).withColumn(
        "departments_inserted", inserts.select(F.count(F.lit(1))).scalar())
    return inserts, counts


def load_departments(spark: SparkSession, day: dt.date | str, hr: str = "hr", departments: str = "department2",
                     roles: str = "roles", roles_assignation: str = "roles_assignation") -> tuple[int, int]:
    """Classify the day's new departments and append them; returns how many were looked at and inserted."""
    scratch: list[str] = []
    inserts, counts = update_departments(spark.table(hr), spark.table(departments), spark.table(roles), spark.table(roles_assignation),
                                         day, scratch=scratch)
    result = counts.first()
    append(spark, departments, conform(inserts, spark.table(departments).schema))
    discard(spark, scratch)
    return result["departments_processed"], result["departments_inserted"]
