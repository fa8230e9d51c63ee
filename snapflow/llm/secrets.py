"""Secrets in text, by DataFrame functions only: fixed patterns, and character Markov models for the rest.

Patterns give the base spans. Other long tokens are judged by two first-order character models, one of random
strings and one of ordinary identifiers: the log-likelihood ratio of a token's character pairs decides. Positions
come from the pieces between matches, so a text is scanned a fixed number of times and nothing is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.common import hash_sample, id_and_text

# The three base patterns, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs are maximal, so a least length in the pattern equals dropping short matches
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_=-]{20,}"
LEAN = 20.0  # occurrences that the general frequency of a character counts for
IDENTIFIER = r"[A-Za-z0-9+/_=-]{5,}"
SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratios (random over ordinary) of character pairs, row by row over ``ALPHABET``."""

    ratios: tuple[float, ...]
    total: float = 12.0  # a secret's least summed ratio, in nats
    mean: float = 0.4  # and least ratio per pair


def _running_sums(lengths: Column) -> Column:
    """Prefix sums by doubling: each round adds the value 1, 2, 4, ... places back."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(28)]), lambda s: s < F.size(lengths))
    return F.aggregate(steps, lengths, lambda done, s: F.transform(
        done, lambda x, i: x + F.when(i >= s, F.get(done, i - s)).otherwise(0)))


def _matches(df: DataFrame, pattern: str, into: str) -> DataFrame:
    """Add array<struct<start, end, hit>> of leftmost non-overlapping matches, in code points; null if there is none."""
    hits, pieces, ends = f"{into}_hits", f"{into}_pieces", f"{into}_ends"
    some = F.col("text").rlike(pattern)
    return (
        df.withColumn(hits, F.when(some, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
        .withColumn(pieces, F.when(F.col(hits).isNotNull(), F.transform(F.split("text", pattern, -1), lambda p: F.length(p))))
        .withColumn(ends, F.when(F.col(hits).isNotNull(), _running_sums(
            F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda gap, hit: gap + F.length(hit)))))
        .withColumn(into, F.when(F.col(hits).isNotNull(), F.zip_with(ends, hits, lambda end, hit: F.struct(
            (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))))
        .drop(hits, pieces, ends))


def _as_spans(found: Column, kind: int) -> Column:
    return F.coalesce(F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))).cast(SPAN), F.array().cast(SPAN))


def _pairs(strings: DataFrame, column: str, label: int) -> DataFrame:
    """Character pairs inside each string, as a place in the ratio table."""
    size = len(ALPHABET)
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(F.col(column), i, F.lit(1))) - 1
    return (strings.filter(F.length(column) > 1)
            .select(column, F.explode(F.sequence(F.lit(1), F.length(column) - 1)).alias("i"))
            .select((at(F.col("i")) * size + at(F.col("i") + 1)).alias("pair"), F.lit(label).alias("label")))


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = 2000, random_strings: int = 6000) -> Markov:
    """Fit both models.

    Ordinary identifiers: words of 5 or more characters from at most ``rows`` documents, base spans cut out, as they are
    and in capitals (so that capitals alone do not look random).
    Random strings: base spans of the same documents, and ``random_strings`` digests written in hex, Base64 and
    upper-case letters with digits. Pair counts come back as one row per pair of ``ALPHABET``, a fixed number.
    With no document at all the ordinary model is uniform.
    """
    spark = docs.sparkSession
    all_docs = id_and_text(docs, id_column, text_column)
    ids = hash_sample(all_docs.select("doc_id").distinct(), "doc_id", rows)
    sample = all_docs.join(F.broadcast(ids), "doc_id", "left_semi")  # at most `rows` ids
    marked = f"{ASSIGN}|{ACCESS}|{HEX}"
    words = sample.select(F.explode(F.regexp_extract_all(F.regexp_replace("text", marked, " "), F.lit(IDENTIFIER), F.lit(0))).alias("s"))
    words = words.select(F.explode(F.array("s", F.upper("s"), F.initcap("s"))).alias("s"))
    known = sample.select(F.explode(F.regexp_extract_all("text", F.lit(f"{ACCESS}|{HEX}"), F.lit(0))).alias("s"))
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    base64 = F.substring(F.base64(F.unhex(digest)), 1, 40)
    made = spark.range(random_strings).select(
        F.when(F.col("id") % 3 == 0, F.substring(digest, 1, 40)).when(F.col("id") % 3 == 1, base64)
        .otherwise(F.upper(F.regexp_replace(base64, "[+/=]", "7"))).alias("s"))
    counts = (_pairs(words, "s", 0).union(_pairs(known.union(made), "s", 1)).groupBy("pair")
              .agg(F.sum(1 - F.col("label")).alias("ordinary"), F.sum("label").alias("random")).collect())
    size = len(ALPHABET)
    table = {r["pair"]: (r["ordinary"], r["random"]) for r in counts}
    pairs = [[[table.get(a * size + b, (0, 0))[k] for b in range(size)] for a in range(size)] for k in (0, 1)]

    def conditional(model: list[list[int]]) -> list[list[float]]:
        """Second character given the first, leaning on how common the second is where the first was rarely seen."""
        common = [sum(row[b] for row in model) + 0.5 for b in range(size)]
        total = sum(common)
        return [[(row[b] + LEAN * common[b] / total) / (sum(row) + LEAN) for b in range(size)] for row in model]

    ordinary, random = map(conditional, pairs)
    return Markov(tuple(round(math.log(random[a][b] / ordinary[a][b]), 4) for a in range(size) for b in range(size)))


def _ratio(token: Column, table: Column) -> Column:
    """Summed log-likelihood ratio of a token's pairs."""
    size = len(ALPHABET)
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pairs = F.zip_with(codes, F.slice(codes, F.lit(2), F.length(token)), lambda a, b: a * size + b)
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.coalesce(F.get(table, p), F.lit(0.0)))


def find(docs: DataFrame, model: Markov, text_column: str = "text", into: str = "secrets") -> DataFrame:
    """Add ``into``: array<struct<start, kind, end>>, sorted; kind is a place in ``KINDS``, offsets are code points.

    Base spans of different kinds may overlap and all stay; a Markov span is added only where it overlaps no base
    span. A null or empty text has none. Every row is judged by itself; other columns stay, and a column that already
    has the name ``into`` is replaced.
    """
    names = [c for c in docs.columns if c != into]
    own = {c: f"_in{i}" for i, c in enumerate(names)}
    df = docs.select(*[F.col(f"`{c}`").alias(own[c]) for c in names], F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    for pattern, kind in ((ASSIGN, "_assign"), (ACCESS, "_access"), (HEX, "_hex"), (TOKEN, "_token")):
        df = _matches(df, pattern, kind)
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1))
    long_enough = F.filter(F.zip_with("_assign", values, lambda m, v: F.when(F.length(v) >= ASSIGN_VALUE, m)), lambda m: m.isNotNull())
    table = F.split(F.lit(",".join(map(str, model.ratios))), ",").cast("array<double>")  # folded to one constant
    odd = F.filter("_token", lambda m: _ratio(m["hit"], table) >= F.greatest(F.lit(model.total), model.mean * (F.length(m["hit"]) - 1)))
    df = (df.withColumn("_base", F.array_sort(F.concat(
        _as_spans(F.when(F.col("_assign").isNotNull(), long_enough), 0), _as_spans(F.col("_access"), 1), _as_spans(F.col("_hex"), 2))))
        .withColumn("_odd", F.when(F.col("_token").isNotNull(), odd)))
    free = F.filter("_odd", lambda m: ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    df = df.withColumn("_spans", F.when(F.col("_odd").isNull(), F.col("_base")).otherwise(F.array_sort(F.concat("_base", _as_spans(free, 3)))))
    return df.select(*[F.col(own[c]).alias(c) for c in names], F.col("_spans").alias(into))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans are replaced once. No span: the text as it is."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done, s):
        fresh = s["start"] >= done["at"]
        return F.struct(
            F.when(fresh, F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark)))
            .otherwise(done["out"]).alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    whole = F.aggregate(spans, start, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
