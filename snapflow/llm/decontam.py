"""Benchmark passages in training text, by spaced seeds, with DataFrame functions only.

A seed hashes five of seven or eight neighbouring words; fixed masks say which are ignored, so a changed word between
the chosen ones does not hide a passage. Training windows and benchmark windows are joined on the hash. Around a hit, the
words of both sides are compared place by place along the hit's diagonal, and a stretch in which at least four fifths
of the words agree is a leak.

With the first three masks below every stretch of 8 or 9 words with one substitution, and of 10 to 13 words with two, is
hit by a seed: no pair that the threshold admits is missed. Items of 5 to 7 words are leaks only where all their words
agree; the last mask serves those that are too short for the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ((0, 1, 2, 5, 6), (0, 2, 3, 4, 6), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4))
SHORT = 3  # the mask that is used for items of fewer words than the others need
LEAST_WORDS, TOLERANT = 5, 8  # fewer words are no evidence and never reported; from so many on, a fifth may differ
STRETCH, SIMILARITY = 13, 0.8
BROADCAST_WINDOWS = 500_000  # benchmark windows up to which they are sent to every task: about 16 MB of hashes


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seed(mask: int, at: Column) -> Column:
    return F.xxhash64(F.lit(mask), *[F.get("words", at + i) for i in MASKS[mask]])


def _span(mask: int) -> int:
    return MASKS[mask][-1] + 1


def _windows(df: DataFrame, carry: list[str], masks: list[int]) -> DataFrame:
    """One row per place and mask: ``carry``, ``at``, ``mask``, ``seed``."""
    least = min(map(_span, masks))
    placed = df.filter(F.size("words") >= least).select(*carry, "words", F.explode(F.sequence(F.lit(0), F.size("words") - least)).alias("at"))
    # No window over the end; a condition behind the explode leaves all of this in one generated loop.
    seeds = F.array(*[F.struct(F.lit(m).alias("mask"), F.when(F.col("at") <= F.size("words") - _span(m), _seed(m, F.col("at"))).alias("seed")) for m in masks])
    return placed.select(*carry, "words", "at", F.explode(seeds).alias("w")).select(*carry, "words", "at", "w.*").filter(F.col("seed").isNotNull())


def _before(mask: Column) -> Column:
    """The seed one place earlier; null at the first place."""
    earlier = F.coalesce(*[F.when(mask == m, _seed(m, F.col("at") - 1)) for m in range(len(MASKS))])
    return F.when(F.col("at") > 0, earlier)


def _agreeing(mine: Column, theirs: Column) -> Column:
    return F.zip_with(mine, theirs, lambda a, b: F.when(a == b, 1).otherwise(0))


def find(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         item_column: str = "item_id", item_text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Leaks: ``doc_id, text_key, text_length, item_id, stretch, agreeing, covered``, one row per text and benchmark item.

    ``agreeing`` of the ``stretch`` words of the best stretch agree (13 words, or the whole item if it is shorter);
    ``covered`` counts the item's words that agree along the best diagonal. ``text_key`` and ``text_length`` name the whole
    text, also where ids are null or repeat; equal rows give one. Null and empty texts, and items of fewer than 5 words,
    give nothing; items of 5 to 7 words count where all of them agree. Equal items are reported under each of their ids.

    The benchmark's windows are counted first. Up to ``broadcast_windows`` they are sent to every task and the texts are
    not shuffled at all; beyond, windows are shuffled with their hashes only and texts are joined back for the comparison.
    """
    items = benchmark.select(F.col(f"`{item_column}`").alias("item_id"), words(F.col(f"`{item_text}`")).alias("words")).filter(F.size("words") >= LEAST_WORDS).distinct()
    # Whether there are such short items is asked once; texts are not cut for a mask that no item has.
    brief = F.size("words") < min(_span(m) for m in range(SHORT))
    masks = [*range(SHORT), *([SHORT] if items.filter(brief).take(1) else [])]
    seeds = _windows(items, ["item_id"], masks).filter((F.col("mask") != SHORT) | brief).select("item_id", F.col("at").alias("item_at"), F.col("mask").alias("item_mask"), "seed", _before(F.col("mask")).alias("item_before"))
    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")).filter(F.col("text").isNotNull())
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), F.length("text").alias("text_length"), words(F.col("text")).alias("words"))
    small = seeds.limit(broadcast_windows + 1).count() <= broadcast_windows
    windows = _windows(texts, ["doc_id", "text_key", "text_length"], masks)

    # A run of hits on one diagonal is looked at once: where the window before it, on both sides, does not match.
    first = F.col("item_before").isNull() | F.col("before").isNull() | (F.col("item_before") != F.col("before"))
    diagonal = (F.col("at") - F.col("item_at")).alias("shift")
    long_items = items.select("item_id", F.col("words").alias("item_words"))
    if small:
        hits = (windows.join(F.broadcast(seeds), "seed").withColumn("before", _before(F.col("mask"))).filter(first)
                .select("doc_id", "text_key", "text_length", "item_id", diagonal, "words").join(F.broadcast(long_items), "item_id"))
    else:
        narrow = windows.select("doc_id", "text_key", "text_length", "at", "seed", _before(F.col("mask")).alias("before"))
        hits = (narrow.join(seeds, "seed").filter(first).select("text_key", "text_length", "item_id", diagonal).distinct()
                .join(texts, ["text_key", "text_length"]).join(long_items, "item_id"))

    mine = F.slice("words", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("item_words"))
    theirs = F.slice("item_words", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("words"))
    length = F.least(F.size("mine"), F.size("theirs"))
    aligned = (hits.withColumn("mine", mine).withColumn("theirs", theirs)
               .withColumn("agree", _agreeing(F.slice("mine", F.lit(1), length), F.slice("theirs", F.lit(1), length)))
               .withColumn("stretch", F.least(F.lit(STRETCH), F.size("item_words")))
               .filter(F.size("agree") >= F.col("stretch")))
    sums = F.transform(F.sequence(F.lit(1), F.size("agree") - F.col("stretch") + 1),
                       lambda i: F.aggregate(F.slice("agree", i, F.col("stretch")), F.lit(0), lambda s, x: s + x))
    found = (aligned.withColumn("agreeing", F.array_max(sums))
             .withColumn("covered", F.aggregate("agree", F.lit(0), lambda s, x: s + x))
             .filter(F.col("agreeing") >= F.when(F.col("stretch") < TOLERANT, F.col("stretch")).otherwise(F.ceil(F.col("stretch") * SIMILARITY))))
    return found.groupBy("doc_id", "text_key", "text_length", "item_id").agg(
        F.max("stretch").alias("stretch"), F.max("agreeing").alias("agreeing"), F.max("covered").alias("covered"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no leak, with all their columns; null texts stay.

    Rows are told apart by their whole text, so null and repeated ids do no harm.
    """
    leaked = find(docs, benchmark, id_column, text_column).select(F.col("text_key").alias("_key"), F.col("text_length").alias("_length")).distinct()
    text = F.col(f"`{text_column}`")
    same = (F.xxhash64(text) == leaked["_key"]) & (F.length(text) == leaked["_length"])
    return docs.join(leaked, same, "left_anti")
