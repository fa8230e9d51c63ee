"""Which batch column feeds which table column, and the one projection that applies it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.functions.text import concat_nonblank, normalize_header
from snapflow.operators.clean import value_of
from snapflow.operators.snapshot import as_date

DEFAULT = "CURRENT_DEFAULT"  # where a table's schema keeps a column's default, as SQL


@dataclass(frozen=True)
class Mapping:
    """One table column: copied from a header, generated, or concatenated."""

    target: str
    source: str | None = None
    generate: str | None = None
    parts: tuple[str, ...] = ()
    separator: str = ""

    @staticmethod
    def of(spec: dict) -> "Mapping":
        return Mapping(spec["dbColumn"], spec.get("excelColumn"), (spec.get("autoGenerate") or "").strip() or None,
                       tuple(spec.get("concatenate") or ()), spec.get("separator") or "")


@dataclass
class MappingPlan:
    mappings: list[Mapping]
    unmatched_headers: list[str] = field(default_factory=list)
    unmapped_columns: list[str] = field(default_factory=list)

    def warnings(self) -> list[str]:
        out = []
        if self.unmatched_headers:
            out.append(f"headers without a table column, ignored: {self.unmatched_headers}")
        if self.unmapped_columns:
            out.append(f"table columns without a mapping, left at their default: {self.unmapped_columns}")
        return out


def parse(specs: object) -> list[Mapping]:
    """Mapping specs of a job step; anything that is not a list of dicts counts as none."""
    return [Mapping.of(m) for m in specs if isinstance(m, dict)] if isinstance(specs, list) else []


def auto_map(headers: Sequence[str], table_columns: Sequence[str], explicit: Sequence[Mapping] = ()) -> MappingPlan:
    """Pair headers with table columns by their UPPER_SNAKE form; explicit mappings win and come last.

    Two headers with the same form would fill one column, which is refused here by name.
    """
    columns = [c.upper() for c in table_columns]
    taken = {m.target.upper() for m in explicit}
    source_of: dict[str, str] = {}
    unmatched = []
    for header in headers:
        name = normalize_header(header)
        if name is None or name in taken:
            continue
        if name not in columns:
            unmatched.append(header)
        elif name in source_of:
            raise ValueError(f"headers '{source_of[name]}' and '{header}' both map to column {name}")
        else:
            source_of[name] = header
    auto = [Mapping(name, header) for name, header in source_of.items()]
    covered = taken | set(source_of)
    return MappingPlan([*auto, *explicit], unmatched, [c for c in columns if c not in covered])


def expression(df: DataFrame, m: Mapping, day: dt.date | str) -> Column:
    if m.generate:
        kind = m.generate.upper()
        if kind == "TIMESTAMP":
            return F.lit(as_date(day)).cast("timestamp")
        return F.expr("uuid()") if kind == "UUID" else F.lit(None)
    if m.parts:
        return concat_nonblank([value_of(df, c) for c in m.parts], m.separator)
    return value_of(df, m.source)


def project(df: DataFrame, mappings: Sequence[Mapping], day: dt.date | str, carry: Sequence[str] = ()) -> DataFrame:
    """The mapped columns under their table names, uncast; ``carry`` keeps batch columns such as the row order."""
    return df.select(*[expression(df, m, day).alias(m.target) for m in mappings], *carry)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring mapped columns to a table's columns, order and types; an unmapped column gets its DEFAULT, else NULL.
    A value that does not convert becomes NULL too, so call it after bad rows are split off."""
    have = {c.upper(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.upper()]}`").try_cast(f.dataType) if f.name.upper() in have
         else F.expr(f.metadata.get(DEFAULT, "NULL")).cast(f.dataType)).alias(f.name) for f in schema.fields])


def source_of_column(target: str, mappings: Sequence[Mapping]) -> str:
    """Batch column that feeds a table column; a column without a copied source reads the column of its own name."""
    return next((m.source for m in mappings if m.target.upper() == target.upper() and m.source), target)
