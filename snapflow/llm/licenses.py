"""Licence texts by canonical digest.

A text is put into a canonical form (lower case, copyright lines dropped, equivalent spellings made one, punctuation and
white space one space) and its SHA-256 is joined to the digests of known licence texts in the same form. Whole documents,
single lines and paragraphs are looked up, so that a licence file, a licence statement inside other text, and a known
text of several lines or paragraphs inside a larger document are found. Paragraphs are parted by lines without a letter
or digit; a text of several paragraphs is found where all of its paragraphs follow each other.

Entire texts of common licences are carried as digests in ``license_digests.csv``, one line per paragraph.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Spellings that count as equal, and known statements and texts by licence.
SPELLINGS = [
    ("licence", "license"), ("organisation", "organization"), ("noncommercial", "non commercial"), ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("merchantibility", "merchantability"), ("https", "http"),
]
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
BROADCAST_ROWS = 100_000
NOT_WORD = r"[^\p{L}\p{N}]+"
PARAGRAPH_BREAK = r"\n[^\p{L}\p{N}]*\n"
WRAPPED = r"\A[^\p{L}\p{N}]*[\p{L}\p{N}][^\n]*\n[^\n]*[\p{L}\p{N}]"  # words on two lines; tried once, at the start
DIGESTS = Path(__file__).with_name("license_digests.csv")
LOOKUP = "license string, digest string, variant string, k int, n int"


def without_copyright(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")


def canonical(lowered: Column) -> Column:
    """Canonical form of a text that went through ``without_copyright``."""
    out = F.trim(F.regexp_replace(lowered, NOT_WORD, " "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def _digest(unit: Column) -> Column:
    return F.sha2(canonical(unit).cast("binary"), 256)


def lookup(texts: DataFrame) -> DataFrame:
    """``license, digest, variant, k, n`` of ``license, text``: a row for the entire text, where ``k`` is null, and one for
    each of its ``n`` paragraphs."""
    bare = texts.select("license", without_copyright(F.col("text")).alias("text"))
    whole = bare.select("license", _digest(F.col("text")).alias("digest"), "text")
    parts = F.filter(F.split("text", PARAGRAPH_BREAK), lambda p: p.rlike(r"[\p{L}\p{N}]"))
    paragraphs = whole.select("license", F.col("digest").alias("variant"), parts.alias("p")).select(
        "license", "variant", F.size("p").alias("n"), F.posexplode("p").alias("k", "unit"))
    return whole.select("license", "digest", F.lit(None).cast("string").alias("variant"), F.lit(None).cast("int").alias("k"), F.lit(None).cast("int").alias("n")).unionByName(
        paragraphs.select("license", _digest(F.col("unit")).alias("digest"), "variant", "k", "n")).distinct()


def known(spark) -> DataFrame:
    """The lookup table of the texts above and of the digests file: a fixed, small number of rows."""
    with DIGESTS.open() as f:
        held = [(r["license"], r["digest"], r["variant"] or None, int(r["k"]) if r["k"] else None, int(r["n"]) if r["n"] else None) for r in csv.DictReader(f)]
    return lookup(spark.createDataFrame(KNOWN, "license string, text string")).union(spark.createDataFrame(held, LOOKUP)).distinct()


def find(docs: DataFrame, licenses: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, scope, license, units`` for each licence a document holds.

    ``scope`` is ``whole`` if the entire document is the licence text, ``line`` for lines that are one, ``paragraph`` for
    texts of several lines or paragraphs inside a larger document (``units`` counts them). Null texts and units without a
    letter or digit match nothing. Rows that repeat an id add up; a text known under several licences gives a row for
    each. Texts are not shuffled, only matches are grouped. ``licenses`` without paragraphs (``license, digest``) finds
    whole texts and lines only.
    """
    if "k" not in licenses.columns:
        licenses = licenses.select("license", "digest", *[F.lit(None).cast(t).alias(c) for c, t in (("variant", "string"), ("k", "int"), ("n", "int"))])
    lowered = docs.select(F.col(f"`{id_column}`").alias("doc_id"), without_copyright(F.col(f"`{text_column}`")).alias("text")).filter(F.col("text").isNotNull())
    unit = lambda scope, at, text: F.struct(F.lit(scope).alias("scope"), at.cast("int").alias("at"), text.alias("unit"))
    units = lowered.select("doc_id", F.xxhash64("text").alias("key"), F.explode(F.concat(
        F.array(unit("whole", F.lit(None), F.col("text"))),
        F.transform(F.split("text", "\n"), lambda line: unit("line", F.lit(None), line)),
        F.transform(F.split("text", PARAGRAPH_BREAK), lambda p, i: unit("paragraph", i, p)))).alias("u")).select("doc_id", "key", "u.*")
    digests = units.select("doc_id", "key", "scope", "at", F.when(F.col("scope") == "paragraph", F.col("unit").rlike(WRAPPED)).alias("wrapped"), _digest(F.col("unit")).alias("digest"))
    # The table above is a handful of rows; a caller's own table of more than BROADCAST_ROWS is shuffled instead.
    few = licenses.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    matches = digests.join(F.broadcast(licenses) if few else licenses, "digest").filter(
        F.when(F.col("scope") == "paragraph", (F.col("n") > 1) | ((F.col("n") == 1) & F.col("wrapped"))).otherwise(F.col("k").isNull()))
    place = ["doc_id", "key", "scope", "license", "start"]
    runs = (matches.withColumn("start", F.col("at") - F.col("k")).groupBy(*place, "variant", "n", "k").agg(F.count("*").alias("rows"))
            .groupBy(*place, "variant", "n").agg(F.count("*").alias("met"), F.min("rows").alias("units")).filter(F.col("met") == F.coalesce("n", F.lit(1)))
            .groupBy(*place).agg(F.max("units").alias("units"), F.max("n").alias("n")))
    # What a document that is a licence text holds is that text; a text without its title, within one that has it, is not counted again.
    entire = F.max(F.col("scope") == "whole").over(Window.partitionBy("doc_id", "key"))
    before = Window.partitionBy("doc_id", "key", "scope", "license").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("start") + F.col("n")).over(before) > F.col("start"), F.lit(False))
    return (runs.select("*", entire.alias("entire"), reached.alias("within")).filter(((F.col("scope") != "paragraph") | ~F.col("entire")) & ~F.col("within"))
            .groupBy("doc_id", "scope", "license").agg(F.sum("units").alias("units")))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql() -> str:
    """The same lookup over ``documents`` for DuckDB."""
    def form(x: str) -> str:
        out = f"trim(regexp_replace({x}, '{NOT_WORD}', ' ', 'g'))"
        for old, new in SPELLINGS:
            out = f"replace({out}, '{old}', '{new}')"
        return f"sha256({out})"

    bare = lambda x: f"regexp_replace(lower({x}), '{COPYRIGHT_LINE}', chr(10), 'g')"
    table = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)
    return f"""
    WITH k AS (SELECT DISTINCT license, {form(bare('t'))} AS digest FROM (VALUES {table}) v(license, t)),
    d AS (SELECT doc_id, {bare('text')} AS t FROM documents WHERE text IS NOT NULL),
    u AS (SELECT doc_id, 'whole' AS scope, t AS unit FROM d
          UNION ALL SELECT doc_id, 'line' AS scope, unnest(string_split(t, chr(10))) AS unit FROM d)
    SELECT doc_id, scope, license, count(*) AS units FROM u JOIN k ON {form('unit')} = k.digest GROUP BY ALL"""
