"""Role ownership: 27 named rules over the day's snapshots.

Rules are data. Rules of one kind over one table share a single scan: each row yields the roles it
satisfies, instead of one pass per rule.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.text import has_text
from snapflow.operators.joins import tagged
from snapflow.operators.snapshot import as_date, on_day, overwrite_day
from snapflow.plans.parallel import at_once
from snapflow.session import discard, settled, small_frame


@dataclass(frozen=True)
class Rule:
    """One role. ``kind`` says how ``condition`` is meant:

    * ``filter``: rows of ``table`` passing a SQL condition, owner taken from ``owner``;
    * ``manager_is``: people whose manager is the one id a subquery gives (``condition`` is its table,
      filter and column); several ids make the rule fail;
    * ``holds``: people assigned the role number ``condition``;
    * ``name_match``: people whose name is in column ``condition`` of the day's ``table`` rows.
    """

    role: str
    table: str
    owner: str
    kind: str = "filter"
    condition: object = "true"
    by_day: bool = True


_APPLIES = "(applicability != 'NOT APPLICABLE' OR applicability IS NULL)"
_ACTIVE = "(status != 'INACTIVE' OR status IS NULL)"
_CEO = "lower(title) = 'country manager v'"

# Role names, constants and role numbers.
RULES = [
    Rule("CEO", "hr", "id", condition=_CEO),
    Rule("Domain owner", "hr", "id", "manager_is", ("hr", _CEO, "id")),
    Rule("TribeLead", "hr", "id", condition="lower(title) LIKE '%tribe lead%'"),
    Rule("Head/Lead", "hr", "id", condition="(lower(title) LIKE '%lead%' OR lower(title) LIKE '%head%') "
                                            "AND NOT lower(title) LIKE '%tribe lead%'"),
    Rule("Risk owner", "risk", "risk_owner", condition=_APPLIES),
    Rule("Risk owner delegate", "risk", "delegate_risk_owner", condition=_APPLIES),
    Rule("Control owner", "control", "control_owner", condition=f"{_APPLIES} AND {_ACTIVE}"),
    Rule("Control owner delegate", "control", "delegate_control_owner", condition=f"{_APPLIES} AND {_ACTIVE}"),
    Rule("Issue owner", "issues", "issue_owner", condition="status = 'OPEN'"),
    Rule("Issue owner delegate", "issues", "delegate_issue_owner", condition="status = 'OPEN'"),
    Rule("Action owner", "action", "action_owner", condition="status != 'CLOSED'"),
    Rule("Action owner delegate", "action", "delegate_action_owner", condition="status != 'CLOSED'"),
    Rule("Process leader", "arisprocess", "owner_ck"),
    Rule("Asset owner", "cmdb", "id", "name_match", "asset_owner"),
    Rule("Event owner", "events", "assigned_to", condition="status = 'CASE OPEN'"),
    Rule("CoE IT Risk Officer", "hr", "id", "holds", 13),
    Rule("BCO Lead", "hr", "id", "holds", 23),
    Rule("BCOSPOC", "hr", "id", "manager_is", ("roles_assignation", "ID = 23", "CK")),
    Rule("OCR CoE Lead", "hr", "id", "holds", 24),
    Rule("COO_DomainLead", "hr", "id", "holds", 26),
    Rule("RB_DomainLead", "hr", "id", "holds", 27),
    Rule("HR_DomainLead", "hr", "id", "holds", 28),
    Rule("WB_DomainLead", "hr", "id", "holds", 29),
    Rule("CFO_DomainLead", "hr", "id", "holds", 30),
    Rule("CRO_DomainLead", "hr", "id", "holds", 31),
    Rule("CIO_DomainLead", "hr", "id", "holds", 32),
    Rule("Business Contract owner", "contracts", "owner", by_day=False),
]

Tables = Callable[[str], DataFrame]
GROUPS_AT_ONCE = 4  # rule groups that are run and written at a time


@dataclass
class Ownership:
    owners: DataFrame
    failures: dict[str, str] = field(default_factory=dict)


def _read(tables: Tables, name: str, day: dt.date | str, by_day: bool = True) -> DataFrame:
    return on_day(tables(name), "timestamp", day) if by_day else tables(name)


def _filter_group(rules: Sequence[Rule], tables: Tables, day) -> DataFrame:
    """All filter rules of one table in one scan."""
    hits = [F.when(F.expr(str(r.condition)), F.struct(F.lit(r.role).alias("role"), F.col(r.owner).cast("string").alias("owner")))
            for r in rules]
    rows = _read(tables, rules[0].table, day, rules[0].by_day)
    return rows.select(F.inline(F.filter(F.array(*hits), lambda h: h["owner"].isNotNull())))


def _single(rule: Rule, tables: Tables, day) -> DataFrame:
    """The scalar of a manager rule with how many rows it had. One row, whatever the table holds."""
    name, condition, column = rule.condition
    base = _read(tables, name, day, by_day=name != "roles_assignation").filter(condition)
    return base.agg(F.count(F.lit(1)).alias("n"), F.max(column).alias("manager")).select(F.lit(rule.role).alias("role"), "n", "manager")


def _manager_group(rules: Sequence[Rule], tables: Tables, day) -> DataFrame:
    """One scalar row per rule, so the side sent to every task is as long as the rule list."""
    singles = reduce(DataFrame.unionByName, [_single(r, tables, day) for r in rules]).filter("n = 1")
    people = _read(tables, "hr", day).select(F.col("id").cast("string").alias("owner"), F.col("ckmanager").alias("manager"))
    return people.join(F.broadcast(singles), "manager").select("role", "owner")


def _holder_group(rules: Sequence[Rule], tables: Tables, day) -> DataFrame:
    """All assignment rules in one join: the role number picks the role name by CASE."""
    number = F.col("ID")
    role = F.coalesce(*[F.when(number == r.condition, F.lit(r.role)) for r in rules])
    held = (tables("roles_assignation").filter(number.isin([r.condition for r in rules]))
            .select(F.col("CK").alias("id"), role.alias("role")).distinct())
    return _read(tables, "hr", day).select("id").distinct().join(held, "id").select("role", F.col("id").cast("string").alias("owner"))


def _name_group(rules: Sequence[Rule], tables: Tables, day) -> DataFrame:
    """People named in a column, ignoring case.

    Names are de-duplicated before the join, so a name on many rows meets each of its people once. The
    tagged key keeps both join inputs plain exchanges, which lets adaptive execution split a hot name.
    """
    people = _read(tables, "hr", day).select(tagged(F.lower("name")).alias("_name"), F.col("id").cast("string").alias("owner"))
    named = reduce(DataFrame.unionByName, [
        _read(tables, r.table, day).select(F.lower(str(r.condition)).alias("_n")).distinct()
        .withColumn("role", F.lit(r.role)) for r in rules])
    named = named.select(tagged(F.col("_n")).alias("_name"), "role")
    return people.join(named, "_name").select("role", "owner")


_BUILDERS = {"filter": _filter_group, "manager_is": _manager_group, "holds": _holder_group, "name_match": _name_group}


def _groups(rules: Sequence[Rule]) -> list[list[Rule]]:
    grouped: dict[tuple, list[Rule]] = {}
    for r in rules:
        key = (r.kind, r.table, r.by_day) if r.kind == "filter" else (r.kind,)
        grouped.setdefault(key, []).append(r)
    return list(grouped.values())


def _ran(rules: Sequence[Rule], tables: Tables, day, failures: dict[str, str], scratch: list[str] | None) -> list[DataFrame]:
    """The written rows of a rule group; if the group fails, in planning or in running, those of the rules that run alone."""
    try:
        return [settled(_BUILDERS[rules[0].kind](rules, tables, day).filter(has_text("owner")), scratch)]
    except Exception as e:  # noqa: BLE001 - one broken rule must not stop the others
        if len(rules) == 1:
            failures[rules[0].role] = f"{type(e).__name__}: {e}"
            return []
        return [frame for r in rules for frame in _ran([r], tables, day, failures, scratch)]


def _rule_rows(tables: Tables, day: dt.date | str, rules: Sequence[Rule], scratch: list[str] | None) -> Ownership:
    """Non-blank ``(role, owner)`` of every rule that can run, repeats included, and why the others cannot."""
    tables = lru_cache(maxsize=None)(tables)  # one analysed frame per table, however many rules read it
    failures: dict[str, str] = {}
    groups = _groups(rules)
    answers = at_once(SparkSession.active(), lambda group: _ran(group, tables, day, failures, scratch), groups, GROUPS_AT_ONCE)
    parts = [frame for frames in answers for frame in frames]
    if not parts:
        raise ValueError(f"no rule can run: {failures}")
    managers = [r for r in rules if r.kind == "manager_is" and r.role not in failures]
    if managers:
        for row in reduce(DataFrame.unionByName, [_single(r, tables, day) for r in managers]).filter("n > 1").collect():  # one row per rule
            failures[row["role"]] = f"its subquery has {row['n']} rows"
    return Ownership(reduce(DataFrame.unionByName, parts), failures)


def run_rules(tables: Tables, day: dt.date | str, rules: Sequence[Rule] = tuple(RULES), scratch: list[str] | None = None) -> Ownership:
    """Distinct non-blank ``(role, owner)`` of every rule that can run.

    Each group of rules is run and written by itself. A rule that fails (a missing table, an unreadable file, a manager
    rule whose subquery has several rows) is reported and left out; the others still run. Nothing runs twice but the
    group of a failed rule.
    """
    run = _rule_rows(tables, day, rules, scratch)
    return Ownership(run.owners.distinct(), run.failures)


def role_ids(roles: DataFrame) -> DataFrame:
    """``(role, role_id)``; a repeated name keeps the largest id."""
    return roles.filter("name IS NOT NULL").groupBy(F.col("name").alias("role")).agg(F.max("id").alias("role_id"))


def _ids_of(rules: Sequence[Rule], tables: Tables) -> DataFrame:
    """Role ids of the rules' names: one row per rule at most, so it can be sent to every task."""
    return F.broadcast(role_ids(tables("roles").filter(F.col("name").isin([r.role for r in rules]))))


def owner_roles(tables: Tables, day: dt.date | str, rules: Sequence[Rule] = tuple(RULES), scratch: list[str] | None = None) -> Ownership:
    """``(timestamp, owner_id, role_id)`` of the day. Rules whose name is not in ``roles`` are skipped."""
    run = _rule_rows(tables, day, rules, scratch)
    rows = run.owners.join(_ids_of(rules, tables), "role").select(
        F.lit(as_date(day)).cast("timestamp").alias("timestamp"), F.col("owner").alias("owner_id"), "role_id")
    return Ownership(rows.distinct(), run.failures)


def ownership_counts(tables: Tables, day: dt.date | str, rules: Sequence[Rule] = tuple(RULES), run: Ownership | None = None) -> DataFrame:
    """``(role_id, owners)`` for every rule that ran, rules without owners included.

    ``run`` takes what ``run_rules`` has already found, so that counting runs no rule again.
    """
    run = run_rules(tables, day, rules) if run is None else run
    found = run.owners.groupBy("role").agg(F.count(F.lit(1)).alias("n"))
    names = small_frame(run.owners.sparkSession, [(r.role,) for r in rules if r.role not in run.failures], "role string")
    listed = names.join(_ids_of(rules, tables), "role").join(found, "role", "left")
    return listed.select("role_id", F.coalesce("n", F.lit(0)).alias("owners"))


def result_counts(counts: DataFrame) -> DataFrame:
    """How many rules ran and how many owner rows they gave."""
    return counts.agg(F.count(F.lit(1)).alias("roles_processed"), F.coalesce(F.sum("owners"), F.lit(0)).alias("total_records"))


def replace_owner_roles(spark: SparkSession, tables: Tables, day: dt.date | str, target: str = "owner_role",
                        rules: Sequence[Rule] = tuple(RULES)) -> dict[str, str]:
    """Replace the day in the owner-role table, even when no owner was found; returns the failed rules."""
    scratch: list[str] = []
    run = owner_roles(tables, day, rules, scratch)
    overwrite_day(spark, target, run.owners, "timestamp", day)
    discard(spark, scratch)
    return run.failures
