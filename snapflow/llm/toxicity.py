"""Toxic text by averaged subword embeddings.

A word is the bag of its character n-grams; a window of a few words is the average of their embeddings, which a
linear softmax judges. Embeddings and softmax are trained jointly by gradient steps. A document is as toxic as its
most toxic window, so training takes each document's most toxic window so far (multiple-instance learning), and a
document's length does not dilute what it holds. A misspelling shares most n-grams with the word it comes from.

With the weights fixed, embedding and softmax fold into one number per n-gram bucket: scoring a text is a sum over
its distinct words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.llm.common import hash_sample, id_and_text, small_batches, texts
from snapflow.session import discard, settled

BATCH_BYTES = 2 << 20  # text taken at a time: its n-grams take some forty times as much
BUCKETS, SIZE, GRAMS, WINDOW, THRESHOLD = 1 << 18, 8, (3, 4, 5), 3, 0.3
RUN = 64  # words that stay together where a long training text is cut
# Every ASCII byte but letters and digits is a space; A-Z in lower case.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every word, bounded by < and >, and the word it belongs to, words in order."""
    marked = "".join([f"<{w.decode(errors='replace').lower()}>" for w in words])
    data = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
    word = np.cumsum(data == ord("<"), dtype=np.int32) - np.int32(1)
    buckets, owners = [], []
    code = data * np.uint32(0x9E3779B1)
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = (code[:len(data) - n + 1] ^ (code[:len(data) - n + 1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + data[n - 1:] * np.uint32(0xC2B2AE35)
        if n in GRAMS:
            inside = word[:len(code)] == word[n - 1:]
            mixed = code[inside]
            buckets.append((mixed ^ mixed >> np.uint32(13)) * np.uint32(0x27D4EB2F) >> np.uint32(14))
            owners.append(word[:len(code)][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    bucket, owner = np.concatenate(buckets).astype(np.int32), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order], owner[order]


class Bags:
    """Tokens of some texts over their distinct words."""

    def __init__(self, batch: list[bytes]):
        at: dict[bytes, int] = {}
        ids, lengths = [], []
        for text in batch:
            words = text.translate(_FOLD).split()
            lengths.append(len(words))
            ids.append(np.fromiter((at.setdefault(w, len(at)) for w in words), np.int64, len(words)))
        self.words = list(at)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.stops = np.cumsum(lengths).astype(np.int64)
        self.starts = self.stops - np.array(lengths, np.int64)
        self.bucket, self.owner = grams(self.words)
        self.counts = np.bincount(self.owner, minlength=len(self.words))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def windows(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Average weight of the window that ends at each token, and where that window begins."""
        by_word = np.bincount(self.owner, weights=weights[self.bucket], minlength=len(self.words))
        sums = np.concatenate([[0], np.cumsum(by_word[self.ids])])
        sizes = np.concatenate([[0], np.cumsum(self.counts[self.ids])])
        ends = np.arange(1, len(self.ids) + 1)
        begins = np.maximum(np.repeat(self.starts, self.stops - self.starts), ends - WINDOW)
        return (sums[ends] - sums[begins]) / np.maximum(sizes[ends] - sizes[begins], 1), begins

    def most(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: its highest window average and that window's bounds; 0 and no window for a text without words."""
        best, lo, hi = np.zeros(len(self.stops)), self.starts.copy(), self.starts.copy()
        full = np.flatnonzero(self.stops > self.starts)
        if len(full):
            average, begins = self.windows(weights)
            best[full] = np.maximum.reduceat(average, self.starts[full])
            hit = average == np.repeat(best, self.stops - self.starts)
            at = np.flatnonzero(hit)
            end = at[np.searchsorted(at, self.starts[full])]  # the first window that reaches the maximum
            lo[full], hi[full] = begins[end], end + 1
        return best, lo, hi

    def of(self, lo: int, hi: int) -> np.ndarray:
        """All n-gram buckets of a run of tokens."""
        return np.concatenate([self.bucket[self.first[i]:self.first[i + 1]] for i in self.ids[lo:hi]] or [np.zeros(0, np.int32)])


@dataclass
class Model:
    weights: np.ndarray  # per bucket: difference of the two classes' logits
    bias: float

    def scores(self, batch: list[bytes]) -> np.ndarray:
        """Probability of the toxic class; a text without words has the bias alone."""
        best, _, _ = Bags(batch).most(self.weights)
        return 1 / (1 + np.exp(-np.clip(best + self.bias, -50, 50)))


def fit(batch: list[bytes], toxic: np.ndarray, rounds: int = 24, rate: float = 4.0, seed: int = 7) -> Model:
    """Train on whole texts; with one class only, the constant answer of that class's share."""
    n, share = len(batch), (toxic.sum() + 0.5) / (len(batch) + 1)
    prior = float(np.log(share / (1 - share)))
    if n == 0 or toxic.min() == toxic.max():
        return Model(np.zeros(BUCKETS, np.float32), prior)
    bags, random = Bags(batch), np.random.default_rng(seed)
    # Start: the first dimension of an embedding is the log-odds of its n-gram's presence in toxic texts.
    seen = np.zeros((2, BUCKETS))
    for i in range(n):
        seen[int(toxic[i]), np.unique(bags.bucket[np.concatenate([np.arange(bags.first[w], bags.first[w + 1]) for w in np.unique(bags.ids[bags.starts[i]:bags.stops[i]])] or [np.zeros(0, np.int64)])])] += 1
    odds = np.log((seen[1] + 0.2) / (toxic.sum() + 0.4)) - np.log((seen[0] + 0.2) / (n - toxic.sum() + 0.4))
    odds[(seen.sum(axis=0) < 2)] = 0
    embedding = random.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32)
    embedding[:, 0] += odds.astype(np.float32)
    softmax = random.normal(0, 0.05, (SIZE, 2)).astype(np.float32)
    softmax[0] += (-0.5, 0.5)
    bias = np.array([0.0, prior], np.float32)
    for turn in range(rounds):
        difference = embedding @ (softmax[:, 1] - softmax[:, 0])
        _, lo, hi = bags.most(difference)
        step = rate * (1 - turn / rounds)
        order = random.permutation(n)
        for k in range(0, n, 128):
            chosen = order[k:k + 128]
            parts = [bags.of(lo[i], hi[i]) for i in chosen]
            sizes = np.array([max(len(p), 1) for p in parts])
            ids, rows = np.concatenate(parts), np.repeat(np.arange(len(chosen)), [len(p) for p in parts])
            mean = np.stack([np.bincount(rows, weights=embedding[ids, d], minlength=len(chosen)) for d in range(SIZE)], axis=1) / sizes[:, None]
            logits = mean @ softmax + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), toxic[chosen].astype(int)] -= 1
            p /= len(chosen)
            back = (p @ softmax.T) / sizes[:, None]
            softmax -= 0.1 * step * (mean.T @ p + 1e-4 * softmax)
            bias -= 0.1 * step * p.sum(axis=0)
            np.add.at(embedding, ids, (-20 * step * back[rows]).astype(np.float32))
    return Model((embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", rows: int = 4000, words: int = 4_000_000) -> Model:
    """Fit on at most ``rows`` labelled documents, half of them toxic if there are as many, whose ids hash smallest.

    Rows without id, label or text and labels without a document take no part; an id labelled twice counts as toxic if one
    label says so, and of several texts of one id the one that hashes smallest is used. Whole texts are used as long as
    they have ``words`` words together; beyond that the longest ones are cut to runs of ``RUN`` words, chosen by hash in the
    tasks, as many from each as the bound leaves. So the driver holds at most ``words`` words.
    """
    marks = labels.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{label_column}`").cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.select(F.col(f"`{id_column}`").alias("doc_id")).filter(docs[text_column].isNotNull()).distinct()
    known = marks.join(ids, "doc_id", "left_semi")
    chosen = hash_sample(known.filter("toxic = 1"), "doc_id", rows // 2).union(hash_sample(known.filter("toxic = 0"), "doc_id", rows - rows // 2))
    texts_of = (id_and_text(docs.filter(docs[text_column].isNotNull()), id_column, text_column).join(F.broadcast(chosen), "doc_id")  # at most `rows` ids
                .groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")))
    scratch: list[str] = []
    texts_of = settled(texts_of, scratch)
    lengths = [r["n"] for r in texts_of.select(F.size(F.split(F.trim(F.col("text")), r"\s+")).alias("n")).collect()]
    most = _cap(lengths, words)
    picked = _cut(texts_of, most).toArrow().sort_by([("doc_id", "ascending")])
    discard(docs.sparkSession, scratch)
    clean = known.filter("toxic = 0").count()
    toxic = np.array(picked.column("toxic").to_pylist(), np.int64)
    model = fit([t.encode() for t in picked.column("text").to_pylist()], toxic)
    # The sample holds more toxic documents than the table: put the odds of the classes back.
    if 0 < toxic.sum() < len(toxic) and clean:
        model.bias += float(np.log((known.count() - clean) / clean) - np.log(toxic.sum() / (len(toxic) - toxic.sum())))
    return model


def _cap(lengths: list[int], words: int) -> int | None:
    """The most words a text may keep so that all together have no more than ``words``; None if no text has to be cut."""
    left, open_texts = words, len(lengths)
    for n in sorted(lengths):
        if n * open_texts > left:
            return max(RUN, left // open_texts)
        left, open_texts = left - n, open_texts - 1
    return None


def _cut(rows: DataFrame, most: int | None) -> DataFrame:
    """Texts of more than ``most`` words reduced to the runs of ``RUN`` words whose hashes are smallest, in their order."""
    if most is None:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = []
            for text in texts(batch):
                w = text.split()
                if len(w) > most:
                    runs = [b" ".join(w[i:i + RUN]) for i in range(0, len(w), RUN)]
                    best = sorted(sorted(range(len(runs)), key=lambda i: (zlib.crc32(runs[i]), i))[:max(1, most // RUN)])
                    text = b"\n".join(runs[i] for i in best)
                out.append(text.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(out, pa.string())], ["doc_id", "toxic", "text"])

    return rows.select("doc_id", "toxic", "text").mapInArrow(run, rows.select("doc_id", "toxic", "text").schema)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; a null text is an empty one, which has the score of no words.

    Repeated rows each give a row, null ids stay, other columns are left behind.
    """
    rows = id_and_text(docs, id_column, text_column)
    held = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket: 1 MB
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("score double, predicted int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most=BATCH_BYTES):
            s = held.value.scores(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_column, BATCH_BYTES):
            data = [t or b"" for t in texts(batch, text_column)]
            yield batch.filter(pa.array(held.value.scores(data) < threshold))

    return docs.mapInArrow(run, docs.schema)
