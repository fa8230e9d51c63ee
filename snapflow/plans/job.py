"""Job specs: bind, run, log.

A spec is a plain dict in the shape of a job file::

    {"name": ..., "enabled": True, "parameters": {...}, "tasks": [
        {"name": ..., "type": "TRANSFORMATION", "stopOnFailure": True, "subtasks": [
            {"name": ..., "type": "TRIM", "parameters": {...}}]}]}

Steps run in list order; the ``order`` keys are ignored. Transformations only extend the plan. Work happens
where something is written: loading, reference checks with their log, links. The batch is settled (reliable
checkpoint) when several writes read it. A cleared day or table is only remembered until the next step: an INSERT
that fills it replaces the old rows in one write, so readers never meet the gap, and a job that breaks off in between
leaves the old rows.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.files import DATE
from snapflow.operators import clean, link, load, mapping, reference, snapshot
from snapflow.plans import directory, runlog
from snapflow.plans.parallel import at_once
from snapflow.result import StepResult
from snapflow.session import discard, observed, settled, small_frame

TASK_TYPES = ("TRANSFORMATION", "PERSISTENCE")
DEFAULT_TABLE = "snapshot_rows"
SOURCE_COLUMNS = ("_file", "_sheet_index", "_sheet", "_row", "_path", "_uid", "_arrived")
KEY_PROPERTY = "snapflow.primaryKey"


# ---------------------------------------------------------------- specs


@dataclass
class Step:
    name: str
    type: str
    params: dict


@dataclass
class Task:
    name: str
    type: str
    stop_on_failure: bool
    steps: list[Step]


def load_spec(text: str) -> dict:
    """Parse a YAML job file."""
    try:
        import yaml
    except ImportError as e:
        raise ImportError("job files need PyYAML; pass the spec as a dict instead") from e
    return yaml.safe_load(text)


def bind(spec: dict) -> list[Task]:
    """Tasks with parameters merged job, task, step; the innermost wins. Unknown types are refused here."""
    tasks = []
    for t in spec.get("tasks") or []:
        kind = t["type"].upper()
        if kind not in TASK_TYPES:
            raise ValueError(f"unknown task type {t['type']}")
        steps = []
        for s in t.get("subtasks") or []:
            step_kind = s["type"].upper()
            if step_kind not in STEPS:
                raise ValueError(f"unknown step type {s['type']}")
            merged = {**(spec.get("parameters") or {}), **(t.get("parameters") or {}), **(s.get("parameters") or {})}
            steps.append(Step(s["name"], step_kind, merged))
        tasks.append(Task(t["name"], kind, bool(t.get("stopOnFailure", False)), steps))
    return tasks


def selected(specs: Iterable[dict], names: Iterable[str] = ()) -> list[dict]:
    """Enabled specs, limited to ``names`` when any are given."""
    wanted = set(names)
    return [s for s in specs if s.get("enabled", True) and (not wanted or s["name"] in wanted)]


def ingest_day(file_name: str, today: dt.date | None = None) -> dt.date:
    """First date in a file name, else today. The column form is ``functions.files.ingest_date``."""
    found = re.search(DATE, file_name.rsplit("/", 1)[-1], flags=re.ASCII)
    try:
        return dt.date.fromisoformat(found.group()) if found else today or dt.date.today()
    except ValueError:
        return today or dt.date.today()


# ---------------------------------------------------------------- running


@dataclass
class JobRun:
    """State and log of one running job. Log lines are per step, so they stay few whatever the data size."""

    spark: SparkSession
    name: str
    rows: DataFrame
    day: dt.date
    order_by: tuple[str, ...]
    table_override: str | None = None
    log: list[tuple] = field(default_factory=list)
    counters: list[tuple] = field(default_factory=list)
    task: str | None = None
    step: str | None = None
    pending_logs: list[tuple[str | None, str]] = field(default_factory=list)
    pending_checks: list[reference.Check] = field(default_factory=list)
    check_counts: list[tuple] = field(default_factory=list)
    clearing: tuple[str, str | None] | None = None
    lines: list[DataFrame] = field(default_factory=list)
    lines_scratch: list[str] = field(default_factory=list)
    pending_counters: list[tuple] = field(default_factory=list)
    reads: set[str] = field(default_factory=set)
    lazy: bool = True
    counted: bool = False
    consumers_left: int = 0
    step_type: str = ""
    processed: int = 0
    failed: int = 0
    scratch: list[str] = field(default_factory=list)
    steps: list[tuple] = field(default_factory=list)

    def say(self, level: str, message: str, scope: str = "step") -> None:
        task = self.task if scope != "job" else None
        step = self.step if scope == "step" else None
        self.log.append((self.name, task, step, dt.datetime.now(dt.UTC), level,
                         {"job": self.name, "task": self.task, "step": self.step}[scope], message))

    def count(self, counter: str, value: int) -> None:
        self.counters.append((self.name, self.task, self.step, self.step_type, counter, int(value)))

    def watch(self, observation: Observation, report: Callable[["JobRun", dict], None]) -> None:
        """Report counters of a lazy step once an action ran over the rows."""
        self.pending_counters.append((self.task, self.step, self.step_type, observation, report))

    def read_counters(self) -> None:
        task, step, kind = self.task, self.step, self.step_type
        for self.task, self.step, self.step_type, observation, report in self.pending_counters:
            report(self, observed(observation))
        self.pending_counters, (self.task, self.step, self.step_type) = [], (task, step, kind)

    def settle(self) -> None:
        """Compute the batch once, with the reference checks that are due, write their log, report the counters."""
        if not self.lazy:
            return
        # The written id tells rows apart where file and row number repeat; it is as stable as the file it sits in.
        rounds = reference.check_rounds(self.pending_checks)
        rows = self.rows.withColumn("_uid", F.monotonically_increasing_id())
        for checks in rounds:
            if len(checks) == 1:
                c = checks[0]
                rows = reference.flag_reference(rows, c.reference, c.field, self.day, c.reference_id, c.ts_column, c.id_column, c.entity_type, c.log_column)
            else:
                rows = reference.flag_references(settled(rows, self.scratch), checks, self.day)
        if self.pending_checks:
            counts = Observation()
            rows = rows.observe(counts, F.count(F.lit(1)).alias("rows"), *[F.count(c.log_column).alias(c.log_column) for c in self.pending_checks])
            for (task, step, kind, report), c in zip(self.check_counts, self.pending_checks):
                self.pending_counters.append((task, step, kind, counts, lambda r, seen, c=c, report=report: report(r, seen.get("rows", 0), seen.get(c.log_column, 0))))
        frame = settled(rows, self.scratch)
        self.read_counters()
        for log_table in dict.fromkeys(t for t, _ in self.pending_logs):
            entries = reference.log_rows(frame, [c for t, c in self.pending_logs if t == log_table])
            if log_table:
                snapshot.append(self.spark, log_table, fit(self.spark, log_table, entries))
            else:
                self.lines.append(settled(entries, self.lines_scratch))
        self.rows = frame.drop(*[c for _, c in self.pending_logs])
        self.pending_logs, self.pending_checks, self.check_counts, self.reads, self.lazy, self.counted = [], [], [], set(), False, True

    def reading(self, table: str) -> None:
        """Say that the plan reads a table. What was to be cleared in it goes first."""
        if self.clearing and snapshot.full_name(self.spark, table) == snapshot.full_name(self.spark, self.clearing[0]):
            self.clear()
        self.reads.add(snapshot.full_name(self.spark, table))

    def clear(self) -> None:
        """Clear now what no INSERT has replaced."""
        if self.clearing is None:
            return
        (target, ts), self.clearing = self.clearing, None
        if snapshot.full_name(self.spark, target) in self.reads:  # the pending plan still reads what is about to go
            self.settle()
        if ts:
            snapshot.clear_day(self.spark, target, ts, self.day)
        else:
            snapshot.clear_all(self.spark, target)

    def touch(self, rows: DataFrame) -> None:
        self.rows, self.lazy = rows, True

    def table(self, name: str, schema: str | None = None) -> str:
        return f"{schema}.{name}" if schema else name


def fit(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    return mapping.conform(rows, spark.table(table).schema)


StepFunction = Callable[[JobRun, dict], None]
STEPS: dict[str, tuple[str, StepFunction]] = {}


def step(name: str, kind: str = "TRANSFORMATION"):
    """Register a step type; this is also how a user adds one of their own."""
    def register(fn: StepFunction) -> StepFunction:
        STEPS[name] = (kind, fn)
        return fn
    return register


def _transformed(run: JobRun, result: StepResult) -> None:
    for warning in result.warnings:
        run.say("WARN", warning)
    if not result.warnings:
        run.touch(result.rows)


@step("TRIM")
def _trim(run: JobRun, p: dict) -> None:
    _transformed(run, clean.trim(run.rows))


@step("UPPERCASE")
def _uppercase(run: JobRun, p: dict) -> None:
    _transformed(run, clean.uppercase(run.rows))


@step("CONCATENATE")
def _concatenate(run: JobRun, p: dict) -> None:
    _transformed(run, clean.concatenate(run.rows, p.get("sourceColumns"), p.get("targetColumn"), p.get("separator", "")))


@step("DEDUPLICATE")
def _deduplicate(run: JobRun, p: dict) -> None:
    result = clean.deduplicate(run.rows, p.get("keyColumn"), run.order_by)
    _transformed(run, result)
    if result.counters:
        before: dict = {}
        run.watch(result.counters["in"], lambda r, c: before.update(c))

        def report(r: JobRun, c: dict) -> None:
            kept = c.get("rows", 0)
            r.count("removed", before.get("rows", 0) - kept)
            r.say("INFO", f"{p['keyColumn']}: {kept} distinct rows kept, {before.get('rows', 0) - kept} repeats dropped")
        run.watch(result.counters["out"], report)


@step("FILTER_NULL")
def _filter_null(run: JobRun, p: dict) -> None:
    result = clean.filter_null(run.rows, p.get("column"))
    _transformed(run, result)
    if result.counters:
        def report(r: JobRun, c: dict) -> None:
            removed = c.get("rows", 0) - c.get("kept", 0)
            r.count("removed", removed)
            r.say("INFO", f"{p['column']}: {c.get('kept', 0)} rows have a value, {removed} without one dropped")
        run.watch(result.counters["filter"], report)


@step("LOOKUP")
def _lookup(run: JobRun, p: dict) -> None:
    name = p.get("referenceTable")
    table = run.spark.table(name) if name else run.rows
    result = clean.lookup(run.rows, table, p.get("sourceColumn"), p.get("targetColumn") if name else None,
                          p.get("referenceKeyColumn"), p.get("referenceValueColumn"), p.get("timestampColumn"),
                          p.get("nullValues") or [])
    _transformed(run, result)
    if result.counters:
        run.reading(name)

        def report(r: JobRun, c: dict) -> None:
            hit, total = c.get("resolved", 0), c.get("rows", 0)
            r.count("resolved", hit)
            r.count("nulled", total - hit)
            r.say("SUMMARY", f"{p['targetColumn']} from {name} by {p['sourceColumn']}: {hit} found, {total - hit} emptied")
        run.watch(result.counters["lookup"], report)


def _target(run: JobRun, p: dict) -> str:
    return run.table_override or p.get("tableName", DEFAULT_TABLE)


@step("TRUNCATE", "PERSISTENCE")
def _truncate(run: JobRun, p: dict) -> None:
    """Clear the day, or the table. Only noted here: see ``JobRun.clear`` and the INSERT step."""
    target, ts = _target(run, p), p.get("timestampColumn")
    run.clear()
    columns = run.spark.table(target).columns  # a table that is not there fails now
    if ts and snapshot.resolve(run.spark.table(target), ts) not in columns:
        raise ValueError(f"{target} has no column {ts}")
    run.clearing = (target, ts)
    run.say("INFO", f"empties {target}" + (f" of {run.day}" if ts else ""))


@step("SELECT", "PERSISTENCE")
def _select(run: JobRun, p: dict) -> None:
    run.clear()  # the query may look at the table
    reference.check_query(run.spark, p.get("query", "SELECT 1"))
    run.say("INFO", "check query ran")


@step("VALIDATE_REFERENCE", "PERSISTENCE")
def _validate(run: JobRun, p: dict) -> None:
    """Consecutive checks pile up; the step after them runs all of them at once and writes the log once."""
    name = run.table(p["referenceTable"], p.get("schema"))
    column, field_column = f"_reject_{len(run.pending_logs)}", p["fieldColumn"]
    run.reading(name)
    run.pending_checks.append(reference.Check(
        field_column, name, run.spark.table(name), p.get("referenceIdColumn", "ID"), p.get("timestampColumn", "TIMESTAMP"), p.get("idColumn"),
        p.get("currentEntityType", "Unknown"), column))
    log_table = p.get("etlLogTable")
    run.pending_logs.append((run.table(log_table, p.get("schema")) if log_table else None, column))
    run.lazy = True

    def report(r: JobRun, rows: int, cleared: int) -> None:
        r.count("processed", rows)
        r.count("cleared", cleared)
        r.say("SUMMARY", f"{field_column} against {name}: {cleared} unknown values emptied")
    run.check_counts.append((run.task, run.step, run.step_type, report))


def _primary_key(run: JobRun, target: str, p: dict) -> list[str]:
    if p.get("primaryKey"):
        return list(p["primaryKey"])
    found = run.spark.sql(f"SHOW TBLPROPERTIES {target}").filter(F.col("key") == KEY_PROPERTY).collect()
    return [c.strip() for c in found[0]["value"].split(",")] if found else []


def _plan_mappings(run: JobRun, target: str, p: dict) -> list[mapping.Mapping]:
    explicit = mapping.parse(p.get("mappings"))
    if not p.get("autoMap", True):
        return explicit
    columns = run.spark.table(target).columns if run.spark.catalog.tableExists(target) else []
    headers = [c for c in run.rows.columns if c not in run.order_by and c not in SOURCE_COLUMNS]
    plan = mapping.auto_map(headers, columns, explicit)
    for warning in plan.warnings():
        run.say("WARN", warning)
    return plan.mappings


@step("INSERT", "PERSISTENCE")
def _insert(run: JobRun, p: dict) -> None:
    """Append, skip existing, upsert, or replace what a TRUNCATE before it cleared. Rows the table would refuse are split
    off and counted."""
    target, id_column = _target(run, p), p.get("idColumn", "ID")
    upserting, skipping = p.get("upsertMode") is True, p.get("skipExisting") is True
    key = _primary_key(run, target, p)
    if run.pending_logs or run.consumers_left > 1 or key or upserting or skipping:
        run.settle()
    maps = _plan_mappings(run, target, p)
    replacing = _replaced(run, target, maps, upserting or skipping or not maps)
    schema = run.spark.table(target).schema
    rows, updates, updated = run.rows, None, 0
    if upserting or skipping:
        name = run.table(target, p.get("schema"))
        keyed = run.rows.withColumn("_id_text", clean.value_of(run.rows, mapping.source_of_column(id_column, maps)).cast("string"))
        if upserting:
            ids = keyed.select(F.col("_id_text").alias("_id")).filter(F.col("_id").isNotNull()).distinct()
            held = settled(load.held_places(run.spark.table(name), ids, id_column, snapshot.partition_columns(run.spark, name)), run.scratch)
            rows, updates = (part.drop("_id_text") for part in load.split_by_ids(keyed, "_id_text", held))
        else:
            rows = load.new_rows(keyed, run.spark.table(name), "_id_text", id_column).drop("_id_text")
    if not maps:
        run.say("SUMMARY", f"nothing for {target}: no column has a mapping")
        return
    order = [c for c in (*run.order_by, "_uid") if c in rows.columns] or list(run.order_by)
    projected = mapping.project(rows, maps, run.day, carry=order)
    required = [*load.limits_of(schema)[0], *p.get("requiredColumns", [])]  # plain file tables do not keep NOT NULL
    existing = _kept(run, target, replacing) if key else None
    marked = load.mark_rejects(projected, schema, key, order, existing=existing, required=required)
    counts = Observation()
    marked = marked.observe(counts, F.count_if(F.col(load.REASON).isNull()).alias("ok"), F.count(load.REASON).alias("bad"),
                            *[F.count_if(F.col(load.REASON) == r).alias(r) for r in load.REASONS])
    if p.get("rejectTable"):  # good and refused rows are both written: decide once
        marked = settled(marked, run.scratch)
        rejects = run.table(p["rejectTable"], p.get("schema"))
        snapshot.append(run.spark, rejects, fit(run.spark, rejects, load.reject_rows(marked, order, run.name, target, run.day)))
    good = load.accepted(marked, schema)
    if updates is not None:
        updated = _apply_updates(run, target, updates, held, maps, order, id_column, good)
    elif replacing is None:
        snapshot.append(run.spark, target, good)
    elif replacing:
        snapshot.overwrite_day(run.spark, target, good, replacing, run.day)
    else:
        snapshot.replace_all(run.spark, target, good)
    run.read_counters()
    run.counted = True
    seen = observed(counts)
    ok, bad = seen.get("ok", 0), seen.get("bad", 0)
    run.count("inserted", ok)
    run.count("failed", bad)
    for reason in load.REASONS:
        if seen.get(reason):
            run.count(f"failed_{reason}", seen[reason])
    run.count("updated", updated)
    run.processed += ok + updated
    run.failed += bad
    if bad:
        run.say("WARN", f"{target} refuses {bad} rows: " + ", ".join(f"{seen[r]} by {r}" for r in load.REASONS if seen.get(r)))
    run.say("SUMMARY", f"{target}, {len(maps)} columns: {ok} rows added, {updated} changed, {bad} refused")


def _replaced(run: JobRun, target: str, maps: list[mapping.Mapping], alone: bool) -> str | None:
    """What the coming write replaces: a day (its column), the whole table (an empty text), or nothing (None).

    Rows can replace a cleared day where all of them are stamped with it. Any other clearing that is due happens now.
    """
    if run.clearing is None:
        return None
    cleared, ts = run.clearing
    same = snapshot.full_name(run.spark, cleared) == snapshot.full_name(run.spark, target)
    stamped = ts is None or any(m.target.upper() == ts.upper() and (m.generate or "").upper() == "TIMESTAMP" for m in maps)
    if alone or not same or not stamped:
        run.clear()
        return None
    run.clearing = None
    return ts or ""


def _kept(run: JobRun, target: str, replacing: str | None) -> DataFrame | None:
    """Rows of the table that stay beside the ones being written."""
    current = run.spark.table(target)
    if replacing is None:
        return current
    return current.filter(~F.col(replacing).eqNullSafe(snapshot.day_value(current, replacing, run.day))) if replacing else None


def _apply_updates(run: JobRun, target: str, updates: DataFrame, held: DataFrame, maps: list[mapping.Mapping], order: list[str],
                   id_column: str, inserts: DataFrame) -> int:
    """Write an upsert and return how many batch rows were updates.

    Plain files cannot change in place. Where the update leaves the partition columns alone, only the partitions
    that hold an updated id are read and rewritten; otherwise the table is. Without updates the new rows are just appended.
    """
    n = updates.count()
    if n and not any(m.target.upper() == id_column.upper() for m in maps):
        raise ValueError(f"{id_column} identifies rows but nothing is mapped to it")
    if n and len(maps) == 1:
        run.say("WARN", f"{id_column} is the one mapped column, so rows keep their values")
    if n == 0 or len(maps) == 1:
        snapshot.append(run.spark, target, inserts)
        return n
    changes = mapping.project(updates, maps, run.day, carry=order)
    current, partitions = run.spark.table(target), snapshot.partition_columns(run.spark, target)
    if partitions and not {p.upper() for p in partitions} & {m.target.upper() for m in maps}:
        places = {tuple(r) for r in held.drop("_id").distinct().collect()}  # one line per partition
        affected = snapshot.within(current, places, partitions)
        snapshot.replace_partitions(run.spark, target, load.updated_rows(affected, changes, id_column, order))
        snapshot.append(run.spark, target, inserts)
    else:
        snapshot.replace_all(run.spark, target, load.updated_rows(current, changes, id_column, order).unionByName(inserts))
    return n


@step("LINK_PARENT", "PERSISTENCE")
def _link(run: JobRun, p: dict) -> None:
    run.clear()
    if run.pending_logs or run.consumers_left > 1:
        run.settle()
    rules, schema = p.get("rules") or [], p.get("schema")
    ts, entity = p.get("timestampColumn", "TIMESTAMP"), p.get("currentEntityType", "Unknown")
    known, counts = F.col("_rule").isNotNull(), Observation()
    resolved = link.resolve_parents(
        run.rows, lambda t: run.spark.table(run.table(t, schema)), rules, run.day, p.get("idColumn"), p.get("parentPathColumn"),
        p.get("parentObjectsColumn"), p.get("parentTypeColumn"), p.get("separator", "/"), p.get("checkIdColumn", "ID"), ts)
    links = settled(resolved.observe(
        counts, F.count_if(F.col("_found")).alias("linked"), F.count_if(known & ~F.col("_found")).alias("missing"),
        F.count_if(~known).alias("unknown")), run.scratch, by=("_found", "_rule"))  # each write below opens its own folders
    run.read_counters()
    run.counted = True
    for name in dict.fromkeys(r["relationTable"] for r in rules):
        target = run.table(name, schema)
        parts = [fit(run.spark, target, part) for part in link.edges(links, rules, name, run.day, p.get("id1Column", "ID_1"), p.get("id2Column", "ID_2"), ts)]
        snapshot.append(run.spark, target, reduce(DataFrame.unionByName, parts))
    lines = link.unknown_log(links, run.day, entity)
    if rules:
        lines = lines.unionByName(link.missing_log(links, rules, run.day, entity))
    if p.get("etlLogTable"):
        log_table = run.table(p["etlLogTable"], schema)
        snapshot.append(run.spark, log_table, fit(run.spark, log_table, lines))
    else:
        run.lines.append(settled(lines, run.lines_scratch))
    c = {"linked": 0, "missing": 0, "unknown": 0, **observed(counts)}
    for counter in ("linked", "missing", "unknown"):
        run.count(counter, c[counter])
    run.say("SUMMARY", f"parents: {c['linked']} linked, {c['missing']} absent, {c['unknown']} of a type without rule")


BUILT_IN = frozenset(STEPS)


# ---------------------------------------------------------------- one job


@dataclass
class JobResult:
    name: str
    status: str
    file_path: str
    file_type: str
    start: dt.datetime | None
    end: dt.datetime | None
    log: list[tuple]
    tasks: list[tuple]
    counters: list[tuple]
    processed: int = 0
    failed: int = 0
    steps: list[tuple] = field(default_factory=list)
    lines: list[DataFrame] = field(default_factory=list)  # reject-log rows of steps that name no log table
    scratch: list[str] = field(default_factory=list)  # where they are written; yours to ``discard``


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


def _run_tasks(run: JobRun, tasks: list[Task], status: dict[str, tuple[str, int, int]]) -> bool:
    """Run the tasks in order; returns whether one failed. A failed step fails its task."""
    broken = False
    ahead = [s.type for t in tasks for s in t.steps]
    for task in tasks:
        run.task, run.step = task.name, None
        run.say("INFO", "task begins", "task")
        before = (run.processed, run.failed)
        outcome = "SUCCESS"
        try:
            for s in task.steps:
                ahead.pop(0)
                run.step, run.step_type, begun = s.name, s.type, _now()
                run.consumers_left = 1 + sum(k in ("INSERT", "LINK_PARENT", "VALIDATE_REFERENCE") for k in ahead)
                run.say("INFO", "step begins")
                try:
                    kind, fn = STEPS[s.type]
                    if kind == task.type:
                        if run.pending_checks and s.type != "VALIDATE_REFERENCE":
                            run.settle()
                        if s.type not in BUILT_IN:  # a step of the user's may read any table
                            run.clear()
                        fn(run, s.params)
                    else:
                        run.say("WARN", f"{s.type} is no step of a {task.type.lower()} task")
                except Exception as e:
                    run.say("ERROR", f"step broke off: {e}")
                    run.say("INFO", "step ends: FAILED")
                    run.steps.append((run.name, task.name, s.name, s.type, "FAILED", begun, _now()))
                    raise
                run.say("INFO", "step ends: SUCCESS")
                run.steps.append((run.name, task.name, s.name, s.type, "SUCCESS", begun, _now()))
            run.step = None
            if run.pending_checks:
                run.settle()
        except Exception as e:  # noqa: BLE001 - a task failure is a result, not a crash
            broken, outcome = True, "FAILED"
            run.step = None
            run.say("ERROR", f"task broke off: {e}", "task")
        run.say("INFO", f"task ends: {outcome}", "task")
        _, processed, failed = status[task.name]
        status[task.name] = (outcome, processed + run.processed - before[0], failed + run.failed - before[1])
        if outcome == "FAILED" and task.stop_on_failure:
            run.say("ERROR", f"nothing runs after {task.name}", "job")
            break
    if not broken:
        run.clear()
    elif run.clearing:
        run.say("WARN", f"{run.clearing[0]} keeps its rows: nothing was loaded in their place", "job")
    if not broken and run.pending_counters:
        run.rows.write.format("noop").mode("overwrite").save()  # nothing wrote the rows; counters need one pass
        run.read_counters()
    return broken


def _order(rows: DataFrame, order_by: Iterable[str]) -> tuple[str, ...]:
    """The order of a batch: row numbers count within a file and sheet, so those come first where they are known."""
    given = tuple(order_by)
    return tuple(c for c in ("_file", "_sheet_index") if c in rows.columns and c not in given) + given if given == ("_row",) else given


def run_job(spark: SparkSession, spec: dict, batches: DataFrame | dict[str, DataFrame], day: dt.date | str,
            order_by: Iterable[str] = ("_row",), file_path: str = "N/A") -> JobResult:
    """Run one job over a batch, or over one batch per sheet (then the sheet name is the target table)."""
    name, start = spec["name"], _now()
    log: list[tuple] = [(name, None, None, start, "INFO", name, "job begins")]
    status: dict[str, tuple[str, int, int]] = {}
    counters: list[tuple] = []
    steps: list[tuple] = []
    lines: list[DataFrame] = []
    kept: list[str] = []
    processed = failed = 0
    tasks: list[Task] = []
    try:
        tasks = bind(spec)
        for t in tasks:
            status[t.name] = ("PENDING", 0, 0)
        broken = False
        sheets = batches if isinstance(batches, dict) else {None: batches}
        for sheet, rows in sheets.items():
            run = JobRun(spark, name, rows, snapshot.as_date(day), _order(rows, order_by), sheet)
            if sheet is not None and rows.isEmpty():
                run.say("WARN", f"no rows in sheet {sheet}", "job")
            else:
                read = Observation()
                run.rows = rows.observe(read, F.count(F.lit(1)).alias("rows"))
                run.watch(read, lambda r, c: r.say("INFO", f"{c.get('rows', 0)} rows in the batch", "job"))
                broken |= _run_tasks(run, tasks, status)
            discard(spark, run.scratch)
            log += run.log
            counters += run.counters
            steps += run.steps
            lines += run.lines
            kept += run.lines_scratch
            processed += run.processed
            failed += run.failed
        states = [s for s, _, _ in status.values()]
        outcome = "SUCCESS" if not broken else "FAILED" if all(s == "FAILED" for s in states) else "PARTIAL"
    except Exception as e:  # noqa: BLE001
        log.append((name, None, None, _now(), "ERROR", name, f"job broke off: {e}"))
        outcome = "FAILED"
    end = _now()
    log.append((name, None, None, end, "INFO", name, f"job ends: {outcome}"))
    return JobResult(name, outcome, file_path, spec.get("fileType", "EXCEL").upper(), start, end, log,
                     [(name, t, *v) for t, v in status.items()], counters, processed, failed, steps, lines, kept)


@dataclass
class RunReport:
    """Logs and counters of a run as frames with the shapes of ``runlog``. Sizes follow the specs, not the data."""

    run: str
    results: list[JobResult]
    spark: SparkSession

    def log(self) -> DataFrame:
        return small_frame(self.spark, [(self.run, *line) for r in self.results for line in r.log], runlog.LOG)

    def tasks(self) -> DataFrame:
        return small_frame(self.spark, [(self.run, *t) for r in self.results for t in r.tasks], runlog.TASKS)

    def steps(self) -> DataFrame:
        return small_frame(self.spark, [(self.run, *s) for r in self.results for s in r.steps], runlog.STEPS)

    def counters(self) -> DataFrame:
        return small_frame(self.spark, [(self.run, *c) for r in self.results for c in r.counters], runlog.COUNTERS)

    def jobs(self) -> DataFrame:
        lines = []
        for r in self.results:
            levels = [line[4] for line in r.log if line[1] is None and line[2] is None]
            lines.append((self.run, r.name, r.file_path, r.file_type, r.status, r.start, r.end, r.processed, r.failed, 0,
                          levels.count("ERROR"), levels.count("WARN")))
        return small_frame(self.spark, lines, runlog.JOBS)


Opened = tuple  # rows or rows by sheet, day, file path, and where an opener wrote rows: paths to discard after the job


def run_directory_import(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], day: dt.date | str,
                         table: str = "hr", name: str = "directory-import") -> JobResult:
    """Load the people of the day from directory extracts; no people at all makes the job PARTIAL."""
    start, log, n = _now(), [(name, None, None, _now(), "INFO", name, "job begins")], 0
    try:
        extract = directory.union_extracts(sources)
        log += [(name, None, None, _now(), "WARN", name, f"no people from {s}: {e}") for s, e in extract.failures.items()]
        people = extract.rows if extract.rows is not None else small_frame(spark, [], ", ".join(f"{c} string" for c in directory.ATTRIBUTES))
        counts = Observation()
        directory.load_hr(spark, people.observe(counts, F.count(F.lit(1)).alias("rows")), day, table)
        n = observed(counts).get("rows", 0)
        log.append((name, None, None, _now(), "INFO", name, f"{n} rows loaded into {table}"))
        status = "SUCCESS" if n else "PARTIAL"
    except Exception as e:  # noqa: BLE001
        log.append((name, None, None, _now(), "ERROR", name, f"import broke off: {e}"))
        status = "FAILED"
    end = _now()
    log.append((name, None, None, end, "INFO", name, f"job ends: {status}"))
    return JobResult(name, status, "N/A", "TABLE", start, end, log, [], [], n)


def run_jobs(spark: SparkSession, specs: Iterable[dict], open_batch: Callable[[dict], Opened | None],
             names: Iterable[str] = (), order_by: Iterable[str] = ("_row",), before: Iterable[JobResult] = (), parallel: int = 1) -> RunReport:
    """Run the selected specs, up to ``parallel`` of them at once. ``open_batch`` gives rows, day and file path; None skips the
    job, an error fails it. ``before`` are results of imports that ran first and belong into the same report.

    The report lists jobs in the order of the specs. Jobs that run at once see each other's tables as they happen to be;
    writes to one table take turns. Specs that depend on each other belong into separate calls.
    """
    order_by = tuple(order_by)

    def run(spec: dict) -> JobResult:
        kind = spec.get("fileType", "EXCEL").upper()
        try:
            opened = open_batch(spec)
        except Exception as e:  # noqa: BLE001 - one job must not stop the others
            at = _now()
            return JobResult(spec["name"], "FAILED", "N/A", kind, None, at, [(spec["name"], None, None, at, "ERROR", spec["name"], f"no batch: {e}")], [], [])
        if opened is None:
            at = _now()
            return JobResult(spec["name"], "SKIPPED", "N/A", kind, None, at, [(spec["name"], None, None, at, "WARN", spec["name"], "left out: its dump is not there")], [], [])
        rows, day, path, *scratch = opened
        result = run_job(spark, spec, rows, day, order_by, path)
        for written in scratch:
            discard(spark, written)
        return result

    return RunReport(uuid.uuid4().hex, [*before, *at_once(spark, run, selected(specs, names), parallel)], spark)


def open_dump(spark: SparkSession, directory: str | None = None) -> Callable[[dict], Opened]:
    """Opener for a folder of dated dumps: newest file of the spec's dataset, its date, its sheets.
    Without a folder the spec names the file itself."""
    from snapflow.sources.files import resolve_dump
    from snapflow.sources.workbook import read_sheets, read_workbook
    from snapflow.sources.xmlrows import read_xml

    def opener(spec: dict) -> Opened:
        wanted = spec["source"]["location"]["path"]
        path = resolve_dump(spark, directory, wanted) if directory else wanted
        day = ingest_day(path)
        if spec.get("fileType", "EXCEL").upper() == "XML":
            rows = read_xml(spark, path, (spec.get("parameters") or {}).get("rowTag"))
            return rows.withColumn("_row", F.monotonically_increasing_id()), day, path
        if spec.get("processAllSheets", False):
            scratch: list[str] = []
            return read_sheets(spark, path, scratch), day, path, scratch
        return read_workbook(spark, path, sheet_index=max(0, spec.get("sheetIndex", 0))), day, path
    return opener
