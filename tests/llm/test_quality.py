import math
import random
import re

import pytest
from pyspark.sql import functions as F

from snapflow.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    """The counts by direct search."""
    text = text or ""
    w, lines = re.findall(WORD, text), [x for x in text.split("\n") if re.search(WORD, x)]
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {p + k for at in windows.values() if len(at) > 1 for p in at for k in range(5)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(repeated), "n_lines": len(lines), "n_plain": sum(bool(re.fullmatch(r"[^\W\d_](?:[^\W\d_]|['’-])*[.,;:!?]?", x)) for x in w),
            "n_lettered": sum(any(c.isalpha() for c in x) for x in w), "n_capitals": sum(c.isupper() for c in text), "n_letters": sum(c.isalpha() for c in text),
            "n_marks": sum(c in "!?" for c in text), "n_distinct": len(set(w)), "n_stops": sum(x[-1] in ".!?。" for x in w)}


def vote(c):
    """Votes of a document, by the rules' table."""
    ratio = lambda a, b: c[a] / c[b] if c[b] else None
    long = c["n_words"] >= 30
    values = {"symbols": ratio("n_symbols", "n_words"), "plain_words": ratio("n_plain", "n_words"), "words_with_letters": ratio("n_lettered", "n_words"),
              "capitals": ratio("n_capitals", "n_letters"), "marks": ratio("n_marks", "n_words"), "repeated_lines": ratio("n_dup_lines", "n_lines"),
              "repeated_words": ratio("n_repeat_words", "n_words"), "vocabulary": c["n_distinct"] / math.sqrt(c["n_words"]) if long else None,
              "length": c["n_words"], "word_length": ratio("word_chars", "n_words"), "sentences": c["n_stops"] / c["n_words"] if long else None}
    out = []
    for r in quality.RULES:
        x = values[r.name]
        out.append("-" if x is None else "g" if r.good[0] <= x <= r.good[1] else "b" if not r.bad[0] <= x <= r.bad[1] else "-")
    return "".join(out)


def joint(model, pattern):
    shares, good = model
    return [s * math.prod(g[j] if v == "g" else 1 - g[j] if v == "b" else 1.0 for j, v in enumerate(pattern)) for s, g in zip(shares, good)]


def expectation_maximisation(patterns):
    """The same rounds, document by document."""
    first = quality.start()
    model = (first.shares, first.good_votes)
    inside = lambda x: min(1 - 1e-6, max(1e-6, x))
    for _ in range(quality.ROUNDS):
        own, good, bad = [0.0] * len(first.shares), [[0.0] * len(quality.RULES) for _ in first.shares], [[0.0] * len(quality.RULES) for _ in first.shares]
        for p in patterns:
            w = joint(model, p)
            for c, x in enumerate(w):
                x /= sum(w)
                own[c] += x
                for j, v in enumerate(p):
                    good[c][j] += x * (v == "g")
                    bad[c][j] += x * (v == "b")
        k = quality.WEIGHT
        after = (tuple(inside((o + k * s) / (len(patterns) + k)) for o, s in zip(own, first.shares)),
                 tuple(tuple(inside((g + k * f) / (g + b + k)) for g, b, f in zip(*rows)) for rows in zip(good, bad, first.good_votes)))
        moved = max(abs(a - b) for x, y in zip((model[0], *model[1]), (after[0], *after[1])) for a, b in zip(x, y))
        model = after
        if moved <= quality.SETTLED:
            break
    return model


def prose(rng, n):
    words = [rng.choice(["river", "stone", "élan", "house", "über", "walk", "don't", "light", "green", "quick", "paper", "cloud"]) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]).capitalize() + "." for i in range(0, n, 12))


def corpus():
    rng = random.Random(11)
    docs = [prose(rng, rng.randrange(5, 200)) for _ in range(150)]
    docs += [re.sub(r"(?=\s)", "###", prose(rng, 60)) for _ in range(12)] + [prose(rng, 60).replace(" ", " | ") for _ in range(12)]
    docs += [re.sub(r"(?=\s)", "!!", prose(rng, 60).upper()) for _ in range(8)] + ["spam " * rng.randrange(3, 80) for _ in range(10)]
    docs += [(prose(rng, 24) + "\n") * 4 for _ in range(8)] + [prose(rng, 80) + "\n" + prose(random.Random(1), 9) * 2 for _ in range(5)]
    docs += [None, "", " \n\t\v\f\r ", "a", "a b c d e a b c d e", "x\n\nx\n \nx", "a b a b a b a b a b a", "1 2 3 4 5 6 7 8 9 10 11 12", "\U0001f600   é́   z"]
    return docs + docs[:20]


@pytest.fixture(scope="module")
def judged(spark):
    docs = corpus()
    rows = [(i if i % 9 else None, t, 1, "x") for i, t in enumerate(docs)]
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n_words int, votes string, line int")
    # `line` is no input; ids are taken from it to tell rows apart
    return docs, quality.judge(df.drop("doc_id").withColumnRenamed("line", "doc_id")).orderBy("doc_id").collect()


def test_counts(judged):
    docs, rows = judged
    assert len(rows) == len(docs)
    for text, r in zip(docs, rows):
        want = counts(text)
        assert {c: r[c] for c in want} == want, text
        assert r["base_failed"] == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])


def test_votes_rounds_and_posterior(judged):
    docs, rows = judged
    patterns = [vote(counts(t)) for t in docs]
    assert ["".join("gb-"[v % 3] for v in r["votes"]) for r in rows] == patterns
    model = expectation_maximisation(patterns)
    for p, r in zip(patterns, rows):
        w = joint(model, p)
        assert r["quality"] == pytest.approx(w[0] / sum(w), abs=1e-6)
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_verdicts(judged):
    _, rows = judged
    long_prose = [r for r in rows[:150] if r["n_words"] >= 10]
    assert sum(r["kept"] for r in long_prose) >= 0.97 * len(long_prose)
    assert not any(r["kept"] for r in rows[150:200])  # signs, tables, shouting, repetition


def test_labelled_documents(spark):
    """Without having seen a label, the verdict agrees with them."""
    sf = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id").filter("NOT base_failed").collect()
    good, bad = [r["kept"] for r in rows if r["label"] == 1], [r["kept"] for r in rows if r["label"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad) and len(bad) >= 10


def test_long_text_and_long_repeat(spark):
    rng = random.Random(2)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(60_000))
    half = " ".join(text.split(" ")[:30_000])
    rows = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame([(1, text), (2, half + " " + half), (3, "la " * 50_000)], "doc_id long, text string")).collect()}
    assert rows[1]["n_repeat_words"] == 0 and rows[2]["n_repeat_words"] == 60_000 and rows[3]["n_repeat_words"] == 50_000 and rows[3]["n_words"] == 50_000


def test_empty_table_null_ids_and_other_columns(spark):
    df = spark.createDataFrame([(None, "x y", 1), (5, None, 2)], "k long, doc_id string, kept int")
    assert quality.judge(df.limit(0), "k", "doc_id").collect() == []
    rows = sorted(quality.judge(df, "k", "doc_id").collect(), key=lambda r: r["n_words"])
    assert [(r["doc_id"], r["n_words"], r["kept"]) for r in rows] == [(5, 0, False), (None, 2, False)]
    untaught = quality.train(spark.createDataFrame([], "votes array<int>, n long"))
    assert untaught.shares == pytest.approx(quality.start().shares) and untaught.good_votes == quality.start().good_votes


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    plan = quality.judge(df.select(F.col("doc_id"), F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("LogicalRDD", "") and "Arrow" not in plan and "Pandas" not in plan
