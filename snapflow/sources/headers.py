"""Header detection for raw cell tables: rows of untyped cells, the header somewhere among the first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.text import has_text
from snapflow.operators.joins import probe


def header_rows(raw: DataFrame, sheet: Sequence[str] = ("_file", "_sheet"), order: str = "_row",
                cells: str = "cells") -> DataFrame:
    """One row per sheet: ``_header_row`` and ``headers``, from its first row with a visible cell.

    A blank header cell at position i is named ``column_i``; trailing absent cells end the header.
    """
    filled = raw.filter(F.exists(cells, lambda c: has_text(c)))
    first = filled.groupBy(*sheet).agg(F.min_by(cells, order).alias("_cells"), F.min(order).alias("_header_row"))
    names = F.transform("_cells", lambda c, i: F.when(
        has_text(c), F.regexp_replace(c, r"^\p{javaWhitespace}+|\p{javaWhitespace}+$", ""))
        .otherwise(F.concat(F.lit("column_"), i.cast("string"))))
    return first.select(*sheet, "_header_row", names.alias("headers"))


def header_places(headers: DataFrame, key: str) -> DataFrame:
    """``key, n, columns, far``: per sheet the number of header cells and, by name, the positions that bear it, first position first.

    A name of the form ``column_<j>`` with j beyond the header also names the cell at j; ``far`` lists those cells.
    """
    n = F.size("headers").alias("n")
    cells = headers.select(key, n, F.posexplode("headers").alias("i", "name"))
    j = F.regexp_extract("name", r"^column_(0|[1-9]\d*)$", 1).try_cast("int")
    cells = cells.withColumn("j", F.when(j >= F.col("n"), j))
    named = cells.groupBy(key, "name").agg(F.sort_array(F.collect_list("i")).alias("places"), F.max("j").alias("j"), F.max("n").alias("n"))
    places = F.when(F.col("j").isNotNull(), F.concat("places", F.array("j"))).otherwise(F.col("places"))
    return named.groupBy(key).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.get("places", F.lit(0)).alias("at"), "name", places.alias("places")))).alias("columns"),
                                  F.collect_list("j").alias("far"))


def with_headers(raw: DataFrame, sheet: Sequence[str] = ("_file", "_sheet"), order: str = "_row",
                 cells: str = "cells") -> DataFrame:
    """Data rows as a map ``header -> cell``; absent cells have no key, of equal headers the last one stays.

    Cells beyond the header are named ``column_<index>``. Rows up to the header row are dropped. Which columns share a
    name is found once per sheet, so a row takes time in proportion to its cells.
    """
    key = F.to_json(F.struct(*sheet))
    headers = header_rows(raw, sheet, order, cells).select(key.alias("_key"), "_header_row", "headers")
    told = headers.select("_key", "_header_row").join(header_places(headers, "_key"), "_key")
    joined = probe(raw, told, key, "_key").filter(F.col(order) > F.col("_header_row"))
    cell = lambda i: F.get(cells, i)
    last = lambda c: F.get(F.filter(F.transform(F.reverse(c["places"]), cell), lambda x: x.isNotNull()), F.lit(0))
    inside = F.transform("columns", lambda c: F.struct(
        c["name"].alias("key"), F.when(F.size(c["places"]) == 1, cell(F.get(c["places"], F.lit(0)))).otherwise(last(c)).alias("value")))
    beyond = F.transform(F.filter(F.transform(cells, lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: (x["i"] >= F.col("n")) & ~F.array_contains("far", x["i"])),
                         lambda x: F.struct(F.concat(F.lit("column_"), x["i"].cast("string")).alias("key"), x["c"].alias("value")))
    pairs = F.filter(F.concat(inside, beyond), lambda p: p["value"].isNotNull())
    return joined.select(*sheet, order, F.map_from_entries(pairs).alias("values"))
