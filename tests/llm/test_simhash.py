import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from snapflow.llm import graph, simhash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return [least[find(i)] for i in range(len(ids))]


TEXTS = ["", None, "one", "One\ttwo", "a b c d", "É Ünï ÇA va", "x y z w", "the same " * 50, "ab\x0bcd\x0cef\x1cgh"]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == plain_print(text)


def test_long_text_in_blocks():
    text = " ".join(f"w{i % 977}" for i in range(5000))
    assert simhash.fingerprint(text.encode(), block=7) == simhash.fingerprint(text.encode()) == plain_print(text)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(120)]
        for _ in range(rng.choice([1, 1, 2, 9])):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "edit"
            rows.append((len(rows), " ".join(copy)))
    return rows + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(3, rows[3][1]), (None, rows[5][1]), (None, "nobody else has this text here")]


@pytest.mark.parametrize("members", [20_000, 2])
def test_components_against_all_pairs(spark, monkeypatch, members):
    """With tiny lists every hot list goes the refined way; the components are the same."""
    monkeypatch.setattr(simhash, "LIST_MEMBERS", members)
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"print": F.lit("clash"), "k": F.lit(1), "a": F.lit(None)})
    prints = [plain_print(t) for _, t in rows]
    wanted = sorted(zip((d is None for d, _ in rows), (d or 0 for d, _ in rows), prints, (c if c is not None else -1 for c in plain_components([d for d, _ in rows], prints))))
    got = simhash.classes(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["print"] % 2**64, r["component_id"] if r["component_id"] is not None else -1) for r in got) == wanted


def test_keep_one(spark):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("r", F.lit("kept"))
    component = plain_components([d for d, _ in rows], [plain_print(t) for _, t in rows])
    kept = simhash.keep_one(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(i for i in ids if i is not None) == sorted({c for c in component if c is not None})
    assert ids.count(None) == 1  # the nameless text that nothing resembles
    assert simhash.keep_one(docs.limit(0)).count() == simhash.classes(docs.limit(0)).count() == 0


def test_keep_one_where_ids_repeat(spark):
    x, y = "one two three four five six seven", "completely other words stand in this text here"
    keep = lambda rows: sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert keep([(3, y), (5, x), (5, y)]) == [(3, y), (5, x)]
    assert keep([(5, x), (5, y), (5, x)]) == sorted([(5, x), (5, y)], key=str)
    assert keep([(5, x), (5, y), (4, x), (None, y)]) == sorted([(4, x), (5, y)], key=str)
    assert keep([(None, x), (None, x), (None, y), (1, y)]) == sorted([(None, x), (1, y)], key=str)
    assert len(keep([(i % 3, f"{x} number {i % 4} {i % 4} {i % 4}") for i in range(300)])) <= 4


def test_forest_has_the_components_of_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    noisy = [b ^ np.uint64(sum(1 << int(k) for k in set(rng.integers(0, 64, n)))) for b in base for n in (0, 1, 2, 3, 5)]
    members = np.array(noisy, np.uint64).view(np.int64)
    links = simhash.forest(members, chunk=13)
    ids = sorted(set(int(m) for m in members))
    at = {m: i for i, m in enumerate(ids)}
    wanted = plain_components(list(range(len(ids))), [m % 2**64 for m in ids])
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        assert bin((a ^ b) % 2**64).count("1") <= 3
        parent[max(find(at[a]), find(at[b]))] = min(find(at[a]), find(at[b]))
    assert [find(i) for i in range(len(ids))] == wanted and len(links) == len(ids) - len(set(wanted))


def test_graph_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(200, 200)] + [(300, i) for i in range(301, 340)]
    parent = {n: n for p in pairs for n in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long"), []).collect()}
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long"), []).count() == 0
