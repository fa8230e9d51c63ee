import zlib

import numpy as np
from pyspark.sql import functions as F

from snapflow.llm import langid
from snapflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_langid"](spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    known = spark.createDataFrame([(i, "the cat and the dog sat on the mat", "en") for i in range(9)] + [(10 + i, "der hund und die katze saßen auf der matte", "de") for i in range(9)]
                                  + [(30, "123", "xx"), (31, None, "yy"), (32, "unknown tongue", None), (None, "the cat sat", "en"), (1, "the cat and the dog", "en")], "doc_id long, text string, lang string")
    model = langid.train(known)
    assert model.languages == ["de", "en"]
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 ½ _ !"), (4, "the dog"), (4, "the dog"), (None, "die katze und der hund"), (5, "the cat " * 20_000), (6, "漢字")],
                                 "doc_id long, text string").withColumns({"score": F.lit("x"), "lang_pred": F.lit("y")})
    got = sorted(((r["doc_id"] or 0), r["lang_pred"]) for r in langid.identify(docs, model).collect())
    assert [g for g in got if g[0] != 6] == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "en")]
    far = langid.identify(docs, model).filter("doc_id = 6").first()
    assert far["lang_pred"] in model.languages and far["rejected"]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.train(empty) is None
    row = langid.identify(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), None).first()
    assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0.0, True)


def test_sample_is_bounded_per_language(spark):
    docs = spark.createDataFrame([(i, f"word{i} the", "en") for i in range(50)] + [(100, "das wort", "de")], "doc_id long, text string, lang string")
    assert langid.train(docs, rows_per_language=5, clusters=2).languages == ["de", "en"]


def test_a_hot_id_hides_no_language(spark):
    """One id on 20,000 rows is one document; languages late in the alphabet are learned."""
    rows = [(1, "aaa bab aba", "aa")] * 20_000 + [(10 + i, f"der hund und die katze {i}", "de") for i in range(10)] + [(30 + i, f"le chien et le chat {i}", "fr") for i in range(10)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7), rows_per_language=10, rows=25)
    assert model.languages == ["aa", "de", "fr"]


def test_long_texts_and_many_languages(spark):
    rows = [(1, "the cat and the dog " * 500_000, "en"), (2, "der hund und die katze", "de")] + [(100 + i, f"wort{i}", f"x{i}") for i in range(50)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=40)
    assert len(model.languages) == 40
    assert langid.train(spark.createDataFrame(rows[:2], "doc_id long, text string, lang string")).languages == ["de", "en"]


def test_frequencies_of_all_rows_and_nearest_centroid(spark):
    """Against plain sums: idf over every training row though the centroids use a sample, then the largest cosine."""
    rng = np.random.default_rng(3)
    words = {"en": ["the", "and", "cat", "dog", "house"], "de": ["der", "und", "katze", "hund", "haus"]}
    rows = [(i, " ".join(rng.choice(words[lang], 6)), lang) for i in range(120) for lang in [["en", "de"][i % 2]]]
    model = langid.train(spark.createDataFrame([*rows, (None, "12 3", "en")], "doc_id long, text string, lang string").repartition(5), rows_per_language=20)
    v = langid.vectors([t.encode() for _, t, _ in rows])
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + (v > 0).sum(axis=0))) + 1, atol=1e-5)
    weighted = np.log1p(v) * model.idf
    cosine = weighted / np.linalg.norm(weighted, axis=1, keepdims=True) @ model.centroids.T
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), model).collect()}
    for (i, _, lang), row in zip(rows, cosine):
        assert got[i][0] == model.languages[model.owner[row.argmax()]] == lang and abs(got[i][1] - row.max()) < 1e-5
