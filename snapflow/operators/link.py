"""Parent links: edges for parents found that day, log rows for the rest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.text import has_text, jtrim
from snapflow.operators.clean import value_of
from snapflow.operators.joins import id_set, probe
from snapflow.operators.reference import log_entry, row_id
from snapflow.operators.snapshot import as_date, on_day


def _by_rule(rules: Sequence[dict], pick: Callable[[int, dict], Column]) -> Column:
    """Value of the first rule whose type equals the row's; rules come from the spec, so this stays a CASE."""
    if not rules:
        return F.lit(None)
    return F.coalesce(*[F.when(F.col("_type") == r["parentType"], pick(i, r)) for i, r in enumerate(rules)])


def resolve_parents(df: DataFrame, tables: Callable[[str], DataFrame], rules: Sequence[dict] | None,
                    day: dt.date | str, id_column: str, parent_path: str, parent_objects: str, parent_type: str,
                    separator: str = "/", check_id: str = "ID", ts_column: str = "TIMESTAMP") -> DataFrame:
    """``(_rule, _type, id, parent_id, _found)`` for every row that names a parent type.

    The ids of all check tables form one distinct set keyed by table, so the batch is joined once however
    many rules there are. ``_rule`` is NULL for a type no rule knows.
    """
    rules = list(rules or [])
    path, objects = value_of(df, parent_path).cast("string"), value_of(df, parent_objects).cast("string")
    kind = value_of(df, parent_type).cast("string")
    named = df.filter(has_text(kind)).select(
        jtrim(kind).alias("_type"), row_id(df, id_column).alias("id"),
        F.concat(F.coalesce(path, F.lit("")), F.lit(separator), F.coalesce(objects, F.lit(""))).alias("parent_id"))
    routed = named.withColumn("_rule", _by_rule(rules, lambda i, r: F.lit(i)).cast("int"))
    if not rules:
        return routed.withColumn("_found", F.lit(False))
    check_tables = sorted({r["checkTable"] for r in rules})
    table_no = {t: i for i, t in enumerate(check_tables)}
    ids = [on_day(tables(t), ts_column, day).select(
        F.concat(F.lit(f"{table_no[t]}:"), F.col(check_id).cast("string")).alias("_parent")) for t in check_tables]
    parents = id_set(reduce(DataFrame.unionByName, ids), "_parent", "_parent")
    key = F.concat(_by_rule(rules, lambda i, r: F.lit(f"{table_no[r['checkTable']]}:")), F.col("parent_id"))
    joined = probe(routed, parents, key, "_parent")
    return joined.withColumn("_found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def edges(links: DataFrame, rules: Sequence[dict], relation_table: str, day: dt.date | str,
          id1: str = "ID_1", id2: str = "ID_2", ts_column: str = "TIMESTAMP") -> list[DataFrame]:
    """Edge frames of one relation table, one per rule that feeds it. A rule's extra columns may override the keys."""
    out = []
    for i, rule in enumerate(rules):
        if rule["relationTable"] != relation_table:
            continue
        values = {id1: F.col("id"), id2: F.col("parent_id"), ts_column: F.lit(as_date(day)).cast("timestamp")}
        values |= {k: F.lit(v) for k, v in (rule.get("extraColumns") or {}).items()}
        out.append(links.filter((F.col("_rule") == i) & F.col("_found"))
                   .select(*[v.alias(k) for k, v in values.items()]))
    return out


def _entity(rules: Sequence[dict]) -> Column:
    return _by_rule(rules, lambda i, r: F.lit(r.get("parentEntityType", r["checkTable"])))


def missing_log(links: DataFrame, rules: Sequence[dict], day: dt.date | str, entity_type: str = "Unknown") -> DataFrame:
    """Log rows of known types whose parent does not exist that day."""
    entry = log_entry(_entity(rules), F.col("parent_id"), entity_type, F.col("id"), "Unknown",
                      "relationship not loaded", day)
    return links.filter(F.col("_rule").isNotNull() & ~F.col("_found")).select(F.inline(F.array(entry)))


def unknown_log(links: DataFrame, day: dt.date | str, entity_type: str = "Unknown") -> DataFrame:
    """Log rows of types no rule knows."""
    entry = log_entry("Unknown", F.col("_type"), entity_type, F.col("id"), "Unknown", "relationship not loaded", day)
    return links.filter(F.col("_rule").isNull()).select(F.inline(F.array(entry)))
