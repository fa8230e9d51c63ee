import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import ann


def plain(rows, k=5, step=50):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    out = {}
    for q, v in zip(ids, m):
        if q % step == 0:
            s = np.round(m @ v, 12)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df, **kw):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 12)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, places string, rank int")


def test_recall(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(30, 24))
    rows = [(i, (centre[rng.integers(30)] + 0.4 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(3000)]
    df = frame(spark, rows)
    got, want = found(ann.nearest(df, F.col("vec_id") % 50 == 0)), plain(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


@pytest.mark.parametrize("shard", [20_000, 7])
def test_hot_vector_ties_and_shards(spark, monkeypatch, shard):
    monkeypatch.setattr(ann, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", shard)
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).astype(np.float32).tolist()) for i in range(300)]
    got = found(ann.nearest(frame(spark, rows + rows[:10]), F.col("vec_id") % 50 == 0, pivots=16))
    assert got[0] == [(3, 1.0), (6, 1.0), (9, 1.0), (12, 1.0), (15, 1.0)] and [i for i, _ in got[150]] == [0, 3, 6, 9, 12]
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / 5 for q, w in plain(rows).items()]) >= 0.9


def test_invalid_and_few(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1e-30]), (2, [3e37, 3e37]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (100, [0.0, 0.0])]
    df = frame(spark, rows).unionByName(spark.sql("SELECT 9L vec_id, array(1.0f, null) embedding, 'x' places, 1 rank UNION ALL SELECT null, array(1.0f, 2.0f), 'x', 1"))
    got = found(ann.nearest(df, F.col("vec_id") % 50 == 0))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [1, 2, 50], 50: [1, 2, 0]}
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0).count() == 0
