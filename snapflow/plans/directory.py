"""Directory (HR) snapshot: union of directory extracts, attribute cleaning, day load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.text import clean_attr, extract_cn, jtrim
from snapflow.operators.snapshot import as_date, overwrite_day
from snapflow.session import settled

# Person column -> directory attribute.
ATTRIBUTES = {
    "account": "sAMAccountName",
    "given_name": "givenName",
    "last_name": "sn",
    "mail": "mail",
    "department": "department",
    "title": "title",
    "manager": "manager",
}


@dataclass
class Extract:
    """Union of the extracts that could be read, and why the others could not."""

    rows: DataFrame | None
    failures: dict[str, str] = field(default_factory=dict)


def people_under(entries: DataFrame, base: str, account: str | None = None) -> DataFrame:
    """Entries below an organisational unit, optionally of one account. DNs and accounts ignore case."""
    dn = F.lower("dn")
    inside = dn.endswith("," + base.lower()) | (dn == base.lower())
    if account is None:
        return entries.filter(inside)
    held = F.lower(F.try_element_at("attributes", F.lit(ATTRIBUTES["account"])))
    return entries.filter(inside & (held == account.lower()))


def map_attributes(entries: DataFrame) -> DataFrame:
    """Seven person columns from an attribute map; a missing attribute is NULL."""
    return entries.select(*[F.try_element_at("attributes", F.lit(a)).cast("string").alias(c) for c, a in ATTRIBUTES.items()])


def union_extracts(sources: Mapping[str, Callable[[], DataFrame]], scratch: list[str] | None = None) -> Extract:
    """Concatenate the extracts, duplicates kept. A source that cannot be planned or read contributes nothing.

    Each extract is read and written by itself, so a file that turns out unreadable fails its own extract only.
    """
    frames, failures = [], {}
    for name, read in sources.items():
        try:
            frames.append(settled(read().select(*ATTRIBUTES), scratch))
        except Exception as e:  # noqa: BLE001 - one broken source must not stop the others
            failures[name] = f"{type(e).__name__}: {e}"
    return Extract(reduce(DataFrame.unionByName, frames) if frames else None, failures)


def full_name(given: Column | str, last: Column | str) -> Column:
    """``given last``, trimmed; a missing part is skipped."""
    return jtrim(F.concat_ws(" ", given, last))


def hr_rows(people: DataFrame, day: dt.date | str) -> DataFrame:
    """HR rows of the day from person rows."""
    clean = people.select(*[clean_attr(c).alias(c) for c in ATTRIBUTES])
    return clean.select(
        F.col("account").alias("id"), full_name("given_name", "last_name").alias("name"), "mail", "department",
        extract_cn("manager").alias("ckmanager"), "title", F.lit(as_date(day)).cast("timestamp").alias("timestamp"))


def load_hr(spark: SparkSession, people: DataFrame, day: dt.date | str, table: str = "hr") -> None:
    """Replace the day in the HR table, in one partition overwrite; no people still clears the day."""
    overwrite_day(spark, table, hr_rows(people, day), "timestamp", day)
