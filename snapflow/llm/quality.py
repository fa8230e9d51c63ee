"""Document quality by weak supervision, with DataFrame functions only.

Each rule looks at one property of a text and votes good or bad, or abstains where the property says little. No rule
decides alone. Expectation-maximisation finds, from the votes of all documents and without labels, how often each rule
is right: about good documents, and about each kind of bad one, since a text full of signs and a text that repeats
itself fail different rules. The posterior probability of being good then weighs a document's votes by these
accuracies. Votes are counted by pattern, of which there is a fixed number, so the rounds never touch the documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.session import settled

# White space between words, and the symbols that are counted.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 5  # words that are compared for repeats
LEAST_WORDS, REPEATED = 10, 20  # base rule: fewer words, or more than so many per cent repeated, fail

ROUNDS, SETTLED = 40, 1e-3  # EM ends when no accuracy moves by more
# Before the first round: shares of good and bad documents, and how often a vote is "good" on a good document, on a bad
# document of the rule's own kind, and on a bad document of another kind. They count for so many documents throughout.
START_BAD, START_GOOD, START_OWN, START_OTHER, WEIGHT = 0.2, 0.98, 0.4, 0.95, 20.0


@dataclass(frozen=True)
class Rule:
    """Votes on ``value``: good within ``good``, bad outside ``bad``, and abstains in between or without a value."""

    name: str
    kind: str
    value: str
    good: tuple[float, float]
    bad: tuple[float, float]


ANY = math.inf
RULES = (
    Rule("symbols", "noise", "try_divide(n_symbols, n_words)", (0, 0.03), (0, 0.15)),
    Rule("plain_words", "noise", "try_divide(n_plain, n_words)", (0.95, 1), (0.8, 1)),
    Rule("words_with_letters", "noise", "try_divide(n_lettered, n_words)", (0.95, 1), (0.8, 1)),
    Rule("capitals", "noise", "try_divide(n_capitals, n_letters)", (0, 0.15), (0, 0.3)),
    Rule("marks", "noise", "try_divide(n_marks, n_words)", (0, 0.05), (0, 0.2)),
    Rule("repeated_lines", "repetition", "try_divide(n_dup_lines, n_lines)", (0, 0.1), (0, 0.3)),
    Rule("repeated_words", "repetition", "try_divide(n_repeat_words, n_words)", (0, 0.05), (0, 0.2)),
    Rule("vocabulary", "repetition", "CASE WHEN n_words >= 30 THEN n_distinct / sqrt(n_words) END", (2.5, ANY), (1.5, ANY)),
    Rule("length", "shape", "n_words", (40, ANY), (10, ANY)),
    Rule("word_length", "shape", "try_divide(word_chars, n_words)", (3, 10), (2, 14)),
    Rule("sentences", "shape", "CASE WHEN n_words >= 30 THEN n_stops / n_words END", (0.02, 0.4), (0.005, 0.6)),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeated(words: Column) -> Column:
    """How many words stand in a window of five that the text holds at least twice.

    Hashes of all windows settle the common case, in which none repeats. Else the windows with repeated hashes are
    compared word by word.
    """
    def twice(sorted_windows: Column, key: str) -> Column:
        return F.filter(sorted_windows, lambda w, i: F.coalesce(w[key] == F.get(sorted_windows, i - 1)[key], F.lit(False))
                        | F.coalesce(w[key] == F.get(sorted_windows, i + 1)[key], F.lit(False)))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda s, g: s + g)

    def compared(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        like = _let(placed, lambda w: twice(w, "h"))
        windows = F.array_sort(F.transform(like, lambda w: F.struct(F.slice(words, w["at"] + 1, F.lit(WINDOW)).alias("words"), w["at"].alias("at"))))
        equal = _let(windows, lambda w: F.array_sort(F.transform(twice(w, "words"), lambda x: x["at"])))
        return _let(equal, covered)

    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(compared(h)))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_plain", "n_lettered", "n_capitals", "n_letters", "n_marks", "n_distinct", "n_stops")


def measured(text: Column) -> Column:
    """A struct of ``COUNTS`` of a text; a null text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    split = F.array_remove(F.split(F.translate(text, BLANKS, "\x20" * len(BLANKS)), "\x20", -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    by_words = _let(split, lambda w: F.struct(
        F.size(w).alias("n_words"), _repeated(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).alias("n_distinct"),
        F.size(F.filter(w, lambda x: x.rlike(r"^\p{L}[\p{L}'’-]*[.,;:!?]?$"))).alias("n_plain"), F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).alias("n_lettered"), F.size(F.filter(w, lambda x: x.rlike(r"[.!?。]$"))).alias("n_stops")))
    by_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    by_text = F.struct((F.length(text) - _count(text, BLANKS)).alias("word_chars"), _count(text, SYMBOLS).alias("n_symbols"), _count(text, "!?").alias("n_marks"),
                       letters.alias("n_letters"), (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("n_capitals"))
    return F.struct(by_words.alias("words"), by_lines.alias("lines"), by_text.alias("text"))


GOOD, BAD, NONE = 0, 1, 2


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """Per rule ``3 * place of the rule + vote``."""
    def vote(rule: Rule) -> Column:
        value = F.expr(rule.value)
        within = lambda bounds: value.between(F.lit(float(bounds[0])), F.lit(float(bounds[1])))
        return F.when(value.isNull(), NONE).when(within(rule.good), GOOD).when(~within(rule.bad), BAD).otherwise(NONE)
    return F.array(*[vote(r) + 3 * j for j, r in enumerate(rules)])


@dataclass(frozen=True)
class Model:
    """Per class, the good one first: its share of the documents, and by rule how often a vote on it is "good"."""

    shares: tuple[float, ...]
    good_votes: tuple[tuple[float, ...], ...]


def start(rules: tuple[Rule, ...] = RULES) -> Model:
    """Good documents, and one class of bad ones per kind of rule: rules are mostly right about their own kind."""
    kinds = list(dict.fromkeys(r.kind for r in rules))
    return Model((1 - START_BAD, *[START_BAD / len(kinds)] * len(kinds)),
                 (tuple(START_GOOD for _ in rules), *[tuple(START_OWN if r.kind == k else START_OTHER for r in rules) for k in kinds]))


def _weights(model: Model, votes: Column) -> list[Column]:
    """How likely each class is together with these votes."""
    def weight(share: float, good_votes: tuple[float, ...]) -> Column:
        told = F.lit([x for good in good_votes for x in (math.log(good), math.log(1 - good), 0.0)])
        return F.exp(F.aggregate(votes, F.lit(math.log(share)), lambda total, v: total + F.get(told, v)))
    return [weight(s, v) for s, v in zip(model.shares, model.good_votes)]


def posterior(model: Model, votes: Column) -> Column:
    """Probability that a document with these votes is good."""
    return _let(F.array(*_weights(model, votes)), lambda w: F.get(w, F.lit(0)) / F.aggregate(w, F.lit(0.0), lambda s, x: s + x))


def train(patterns: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """Expectation-maximisation over ``votes, n``: vote patterns with their number of documents.

    The starting values count for ``WEIGHT`` documents all along: a rule that never votes keeps them, and so does a table
    without documents.
    """
    first = model = start(rules)
    classes, places = range(len(first.shares)), range(len(rules))
    inside = lambda x: min(1 - 1e-6, max(1e-6, round(x, 9)))
    for _ in range(ROUNDS):
        weighed = patterns.select("votes", "n", F.array(*_weights(model, F.col("votes"))).alias("w"))
        shared = weighed.select("votes", F.transform("w", lambda w: F.col("n") * w / F.aggregate("w", F.lit(0.0), lambda s, x: s + x)).alias("d"))
        sums = shared.select(F.explode("votes").alias("v"), "d").groupBy("v").agg(F.array(*[F.sum(F.get("d", F.lit(c))) for c in classes]).alias("d"))
        seen = {r["v"]: r["d"] for r in sums.collect()}  # three lines per rule at most
        of = lambda j, v, c: seen[3 * j + v][c] if 3 * j + v in seen else 0.0
        own = [sum(of(0, v, c) for v in (GOOD, BAD, NONE)) for c in classes]
        after = Model(
            tuple(inside((own[c] + WEIGHT * first.shares[c]) / (sum(own) + WEIGHT)) for c in classes),
            tuple(tuple(inside((of(j, GOOD, c) + WEIGHT * first.good_votes[c][j]) / (of(j, GOOD, c) + of(j, BAD, c) + WEIGHT)) for j in places) for c in classes))
        moved = max(abs(a - b) for old, new in zip((model.shares, *model.good_votes), (after.shares, *after.good_votes)) for a, b in zip(old, new))
        model = after
        if moved <= SETTLED:
            break
    return model


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5, scratch: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``COUNTS``, ``votes``, ``base_failed``, ``quality`` and ``kept``.

    Words are runs of characters other than ASCII white space, as they are. ``n_repeat_words`` counts words that stand in a
    window of five words found twice or more in the text, ``n_dup_lines`` lines with a word that equal an earlier line.
    ``base_failed``: fewer than 10 words, or more than 20 % repeated ones. ``quality`` is the posterior probability, from
    the votes of all rows; ``kept`` are rows with at least ``least`` of it that pass the base rule.

    Repeated rows each count and each give a row. A null or empty text has no words and fails the base rule; a null id is
    returned as it is. No rows give none. Other columns are not read. ``scratch`` collects the folders written.
    """
    scratch = [] if scratch is None else scratch
    counted = docs.select(F.col(f"`{id_column}`").alias("doc_id"), measured(F.col(f"`{text_column}`")).alias("m"))
    counted = settled(counted.select("doc_id", "m.words.*", "m.lines.*", "m.text.*"), scratch)
    counted = counted.select("doc_id", *[F.col(c).cast("long").alias(c) for c in COUNTS]).withColumn("votes", votes())
    model = train(settled(counted.groupBy("votes").agg(F.count("*").alias("n")), scratch))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed).withColumn("quality", posterior(model, F.col("votes")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
