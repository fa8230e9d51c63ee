"""Builders for the usual shapes of ingestion jobs.

Each returns a plain spec dict for ``plans.job``. A data set is described by its dump name, its table and the
columns that need care; the order of the steps is the builder's.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

STAMP = {"dbColumn": "TIMESTAMP", "autoGenerate": "TIMESTAMP"}


def step(name: str, kind: str, **parameters) -> dict:
    return {"name": name, "type": kind, "parameters": parameters}


def job(name: str, dataset: str, clean: Sequence[dict], persist: Sequence[dict], stop: bool = True, **extra) -> dict:
    """A spec with a cleaning and a persisting task."""
    tasks = [{"name": task, "order": i, "type": kind, "stopOnFailure": stop, "subtasks": list(steps)}
             for i, (task, kind, steps) in enumerate((("clean-data", "TRANSFORMATION", clean), ("persist-data", "PERSISTENCE", persist)), 1) if steps]
    return {"name": name, "enabled": True, "fileType": "EXCEL", "batchSize": 500,
            "source": {"type": "RESOURCES", "location": {"path": dataset}}, "tasks": tasks, **extra}


def renames(columns: Mapping[str, str]) -> list[dict]:
    """Explicit mappings from batch header to table column."""
    return [{"excelColumn": header, "dbColumn": column} for header, column in columns.items()]


def people_checks(fields: Iterable[str], entity: str, people: str = "HR", log: str = "ETL_LOG") -> list[dict]:
    return [step(f"validate-{f}", "VALIDATE_REFERENCE", fieldColumn=f, referenceTable=people, referenceIdColumn="ID",
                 timestampColumn="TIMESTAMP", idColumn="ID", etlLogTable=log, currentEntityType=entity) for f in fields]


def parent_rule(kind: str, table: str, relation: str, entity: str | None = None, **extra) -> dict:
    rule = {"parentType": kind, "checkTable": table, "relationTable": relation}
    return rule | ({"parentEntityType": entity} if entity else {}) | ({"extraColumns": extra} if extra else {})


def entity_job(name: str, dataset: str, table: str, entity: str, id_parts: Sequence[str] = ("Folder_Path", "Identifier"),
               columns: Mapping[str, str] | None = None, owners: Iterable[str] = (), rules: Sequence[dict] = (),
               parent: Sequence[str] = ("Parent_Path", "Parent_Objects", "Parent_Object_Types"),
               people: str = "HR", log: str = "ETL_LOG", **extra) -> dict:
    """Daily snapshot of an entity: trim, build the id, replace the day, check owners, load, link to parents."""
    key = {"sourceColumns": list(id_parts), "separator": "/"}
    persist = [step("replace-day", "TRUNCATE", tableName=table, timestampColumn="TIMESTAMP"),
               *people_checks(owners, entity, people, log),
               step("load", "INSERT", tableName=table, autoMap=True, mappings=[
                   {"dbColumn": "ID", "concatenate": list(id_parts), "separator": "/"}, STAMP, *renames(columns or {})])]
    if rules:
        persist.append(step("link-parent", "LINK_PARENT", idColumn="ID", parentPathColumn=parent[0], parentObjectsColumn=parent[1],
                            parentTypeColumn=parent[2], separator="/", etlLogTable=log, currentEntityType=entity, rules=list(rules)))
    return job(name, dataset, [step("trim", "TRIM"), step("build-id", "CONCATENATE", targetColumn="ID", **key)], persist, **extra)


def full_load_job(name: str, dataset: str, table: str, columns: Mapping[str, str] | None = None, required: str | None = None,
                  upper: bool = False, checks: Sequence[dict] = (), mappings: Sequence[dict] = (), **extra) -> dict:
    """A table that only holds the newest dump: trim, drop rows without ``required``, empty the table, check, load."""
    clean = [step("trim", "TRIM")]
    clean += [step("upper", "UPPERCASE")] if upper else []
    clean += [step("required", "FILTER_NULL", column=required)] if required else []
    return job(name, dataset, clean, [
        step("empty", "TRUNCATE", tableName=table), *checks,
        step("load", "INSERT", tableName=table, autoMap=True, mappings=[*renames(columns or {}), *mappings])], **extra)


def lookup_load_job(name: str, dataset: str, table: str, column: str, reference: str, key: str, value: str,
                    columns: Mapping[str, str], sentinels: Sequence[str] = ("Unknown", ""), **extra) -> dict:
    """Full load with explicit mappings only, after one column was replaced by what a reference table holds for it."""
    resolve = step("resolve", "LOOKUP", sourceColumn=column, targetColumn=column, referenceTable=reference, referenceKeyColumn=key,
                   referenceValueColumn=value, timestampColumn="timestamp", nullValues=list(sentinels))
    return job(name, dataset, [step("trim", "TRIM"), resolve], [
        step("empty", "TRUNCATE", tableName=table),
        step("load", "INSERT", tableName=table, autoMap=False, mappings=renames(columns))], **extra)


def new_rows_job(name: str, dataset: str, table: str, columns: Mapping[str, str] | None = None, trim: bool = True, **extra) -> dict:
    """Only ids the table does not hold yet are added."""
    return job(name, dataset, [step("trim", "TRIM")] if trim else [], [
        step("load", "INSERT", tableName=table, autoMap=True, skipExisting=True, idColumn="ID", mappings=renames(columns or {}))], **extra)


def sheets_upsert_job(name: str, dataset: str, **extra) -> dict:
    """One table per sheet: known ids are updated, new ones inserted."""
    return job(name, dataset, [step("trim", "TRIM")], [
        step("upsert", "INSERT", tableName="_FROM_SHEET_", autoMap=True, upsertMode=True, idColumn="ID", mappings=[STAMP])],
        processAllSheets=True, **extra)
