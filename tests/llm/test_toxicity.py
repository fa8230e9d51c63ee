import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import toxicity
from snapflow.llm.common import fold

BAD = ["idiot", "worthless", "scumbag"]


def made(n, seed, bad=BAD):
    rng = random.Random(seed)
    syllables = ["re", "an", "tion", "ing", "the", "ou", "er", "li", "mo", "sta"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 150))]
        toxic = i % 3 == 0
        for _ in range(1 + len(words) // 60 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = made(600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(9999, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    return toxicity.train(docs, labels, rows=500)


def test_unseen_texts(model):
    rows = made(300, 2)
    scores = model.scores([r[1].encode() for r in rows])
    truth = np.array([r[2] for r in rows])
    assert scores[truth == 1].min() >= toxicity.THRESHOLD and (scores[truth == 0] >= toxicity.THRESHOLD).mean() <= 0.02


def test_misspellings_share_subwords(model):
    rows = made(200, 3, bad=["idiott", "worthles", "scumbags", "idiots"])
    caught = model.scores([r[1].encode() for r in rows if r[2]]) >= toxicity.THRESHOLD
    assert caught.mean() >= 0.9


def test_length_does_not_dilute(model):
    clean = " ".join(r[1] for r in made(900, 4) if not r[2])
    assert model.scores([clean.encode()])[0] < toxicity.THRESHOLD <= model.scores([f"{clean} worthless {clean}".encode()])[0]


def test_rows(spark, model):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "idiot", 3), (3, "!!! ---", 4), (4, "you idiot", 5), (4, "you idiot", 5), (5, "the liing", 6)],
                                 "doc_id long, text string, score int")
    got = sorted((r["doc_id"] or 0, r["predicted"]) for r in toxicity.score(docs, model).collect())
    assert got == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 0)]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5]
    assert toxicity.score(docs.limit(0), model).count() == toxicity.keep_clean(docs.limit(0), model).count() == 0


def test_one_class_or_none_gives_the_prior(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    nothing = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    all_clean = toxicity.train(docs, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    assert np.ptp(nothing.scores([b"", b"a b"])) == 0 and all_clean.scores([b"a b"])[0] < toxicity.THRESHOLD


def test_held_out_on_the_tables(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels.filter(fold("doc_id", 4) != 2))
    held = toxicity.score(docs.filter(fold("doc_id", 4) == 2), model).join(labels, "doc_id")
    c = held.selectExpr("count_if(toxic = 1 AND predicted = 1)", "count_if(toxic = 1)", "count_if(toxic = 0 AND predicted = 1)", "count_if(toxic = 0)").first()
    assert c[0] >= 0.8 * c[1] and c[2] <= 0.03 * c[3]  # a tenth of the toxic labels have nothing toxic in the text


def test_repeated_ids_and_long_training_texts(spark):
    """One id on thousands of rows is one text; a text of many megabytes is cut to runs, and the model still learns."""
    rows = made(400, 5)
    long = " ".join(r[1] for r in made(400, 6) if not r[2])
    docs = [r[:2] for r in rows] + [(4, rows[4][1])] * 4000 + [(5000, (long + " ") * 60)]
    labels = [(r[0], r[2]) for r in rows] + [(5000, 0)]
    d, m = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    assert len(docs[-1][1]) > 5_000_000
    model = toxicity.train(d, m, rows=390, words=60_000)
    fresh = made(200, 7)
    scores, truth = model.scores([r[1].encode() for r in fresh]), np.array([r[2] for r in fresh])
    assert (scores[truth == 1] >= toxicity.THRESHOLD).mean() >= 0.95 and (scores[truth == 0] >= toxicity.THRESHOLD).mean() <= 0.05


def test_the_bound_on_words(spark):
    assert toxicity._cap([5, 5, 5], 100) is None and toxicity._cap([10, 1000, 1000], 410) == 200 and toxicity._cap([], 10) is None
    texts = spark.createDataFrame([(1, 0, " ".join(f"w{i}" for i in range(1000))), (2, 1, "short one")], "doc_id long, toxic int, text string")
    cut = {r["doc_id"]: r["text"].split() for r in toxicity._cut(texts, 200).collect()}
    assert cut[2] == ["short", "one"] and len(cut[1]) == 3 * toxicity.RUN and cut[1] == sorted(cut[1], key=lambda w: int(w[1:]))


def test_scores_against_plain_sums(spark):
    """The folded weights give what averaging n-gram by n-gram gives."""
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), -0.5)
    for text in ("", "Idiot", "one two THREE four, five", "a b c d e f g " * 30):
        words = [w for w in text.encode().translate(toxicity._FOLD).split()]
        best = 0.0 if not words else max(
            np.mean(np.concatenate([model.weights[toxicity.grams([w])[0]] for w in words[max(0, i - toxicity.WINDOW + 1):i + 1]])) for i in range(len(words)))
        assert model.scores([text.encode()])[0] == pytest.approx(1 / (1 + np.exp(-(best + model.bias))), abs=1e-5)
