"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector over hashed byte n-grams. Every language has several centroids, found by
spherical k-means on a bounded sample; the nearest by cosine names the language, and a text farther from it than
almost all of its own training texts is marked as rejected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.llm.common import id_and_text, small_batches, texts

DIMENSIONS = 8192
ORDERS = (1, 2, 3)
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
# ASCII letters in lower case; every other ASCII byte is a space; bytes of other letters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def vectors(batch: list[bytes]) -> np.ndarray:
    """Hashed n-gram counts, one row per text. White space is one space; a text is bounded by spaces."""
    out = np.zeros((len(batch), DIMENSIONS), np.float32)
    for i, text in enumerate(batch):
        data = np.frombuffer(b" " + b" ".join(text.translate(_FOLD).split()) + b" ", np.uint8).astype(np.uint32)
        code = np.zeros(len(data), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            code = code[:len(data) - n + 1] * np.uint32(257) + data[n - 1:] + np.uint32(1) if n > 1 else data + np.uint32(1)
            if n in ORDERS and len(code):
                slots = (code * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(19)
                out[i] += np.bincount(slots, minlength=DIMENSIONS)
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each
    owner: np.ndarray  # row -> place in languages
    least: np.ndarray  # cosine below which a text is rejected, by row

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the language, cosine, and whether the text is rejected; equal cosines go to the first centroid."""
        near = self.weighted(counts) @ self.centroids.T
        best = near.argmax(axis=1)
        cosine = np.clip(near[np.arange(len(near)), best], 0, 1)
        return self.owner[best], cosine, cosine < self.least[best]


def _clusters(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, seeded by the texts farthest from the seeds before them."""
    seeds = [v.mean(axis=0)]
    for _ in range(min(k, len(v)) - 1):
        seeds.append(v[np.max(v @ np.array(seeds).T, axis=1).argmin()])
    centres = np.array(seeds)
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    for _ in range(rounds):
        mine = (v @ centres.T).argmax(axis=1)
        centres = np.array([v[mine == c].mean(axis=0) if (mine == c).any() else centres[c] for c in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


def train(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
          rows_per_language: int = 400, rows: int = 8000, clusters: int = 4) -> Model | None:
    """Fit idf and centroids; None when no row has both a letter and a language.

    Document frequencies are counted over all rows with a language and a letter, in the tasks. The centroids are fitted on at
    most ``rows_per_language`` documents of a language and ``rows`` in all: the ids whose hashes are smallest, found by one
    threshold per language. A document is an id and a language; of several texts the one that hashes smallest is
    used, so a repeated id is one document. The tasks send back n-gram counts, whose size does not depend on the
    length of a text.
    """
    tagged = labelled.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), F.col(f"`{lang_column}`").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = tagged.select("doc_id", "lang").distinct().withColumn("h", F.xxhash64("doc_id"))
    # Hashes are even, so about twice the wanted number lies below this share of their range.
    counts = hashed.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("first"))
    kept = counts.orderBy("first", "lang").limit(rows).withColumn("share", F.least(F.lit(1.0), F.lit(2.0 * rows_per_language + 100) / F.col("n")))
    below = F.when(F.col("share") < 1, (F.col("share") * 2.0**64 - 2.0**63).cast("long")).otherwise(F.lit(2**63 - 1))
    near = hashed.join(F.broadcast(kept.select(F.col("lang").alias("_lang"), below.alias("_below"))), F.col("lang") == F.col("_lang")).filter("h <= _below")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")  # some 900 rows of a language
    ranked = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= rows_per_language)
    chosen = ranked.orderBy("at", "h", "lang").limit(rows).select("doc_id", "lang")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang"))
    sample = (tagged.join(F.broadcast(chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))), same, "left_semi")  # at most `rows` rows
              .groupBy("doc_id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")).select("text", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, most=2 << 20):
            lettered = [(t, lang) for t, lang in zip(texts(batch), batch.column("lang").to_pylist()) if _LETTER.search(t.decode())]
            packed = [zlib.compress(v.astype(np.uint32).tobytes(), 1) for v in vectors([t for t, _ in lettered])]
            yield pa.RecordBatch.from_arrays([pa.array([x for _, x in lettered], pa.string()), pa.array(packed, pa.binary())], ["lang", "counts"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in small_batches(batches, most=2 << 20):
            for at in range(0, batch.num_rows, 256):
                lettered = [t for t in texts(batch.slice(at, 256)) if _LETTER.search(t.decode())]
                seen += (vectors(lettered) > 0).sum(axis=0)
                n += len(lettered)
        where = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(where, -1).astype(np.int32)), pa.array(np.append(seen[where], n))], ["slot", "n"])

    found = sample.mapInArrow(run, "lang string, counts binary").orderBy("lang", "counts").collect()  # at most `rows`, each of fixed size
    if not found:
        return None
    frequencies = {r["slot"]: r["n"] for r in tagged.select("text").mapInArrow(tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()}  # a line per dimension
    counts = np.array([np.frombuffer(zlib.decompress(r["counts"]), np.uint32) for r in found], np.float32)
    langs = np.array([r["lang"] for r in found])
    idf = np.log((1 + frequencies[-1]) / (1 + np.array([frequencies.get(d, 0) for d in range(DIMENSIONS)]))).astype(np.float32) + 1
    model = Model(sorted(set(langs)), idf, np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros(0))
    v, centroids, owner, least = model.weighted(counts), [], [], []
    for place, lang in enumerate(model.languages):
        mine = v[langs == lang]
        for centre in _clusters(mine, clusters):
            centroids.append(centre)
            owner.append(place)
    model.centroids, model.owner = np.array(centroids, np.float32), np.array(owner)
    near = v @ model.centroids.T
    best, cosine = near.argmax(axis=1), near.max(axis=1)
    overall = np.quantile(cosine, 0.01) * 0.8
    model.least = np.array([np.quantile(cosine[best == c], 0.01) * 0.8 if (best == c).sum() >= 20 else overall for c in range(len(centroids))])
    return model


def identify(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` per row; score is the cosine to the nearest centroid.

    A null text, a text without a letter, and every text when there is no model, is ``und`` with score 0, rejected.
    Whole texts are read, repeated rows each give a row, and other columns are left behind.
    """
    rows = id_and_text(docs, id_column, text_column)
    held = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters rows of DIMENSIONS numbers
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("lang_pred string, score double, rejected boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for whole in small_batches(batches):
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                data = texts(batch)
                known = np.array([model is not None and _LETTER.search(t.decode()) is not None for t in data], bool)
                lang, score, rejected = np.full(len(data), UNKNOWN, object), np.zeros(len(data)), np.ones(len(data), bool)
                if known.any():
                    place, cosine, far = model.predict(vectors([t for t, k in zip(data, known) if k]))
                    lang[known], score[known], rejected[known] = np.array(model.languages, object)[place], cosine, far
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                                 ["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, schema)
