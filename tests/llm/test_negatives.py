import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, uid int, words string, number string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "x", None) for i, v, c in rows], SCHEMA)


def plain(rows, step=10, positives=5, k=10, low=30, high=90, scale=256):
    """Every pair in whole numbers of any size."""
    used = [(i, c, [math.floor(scale * x) for x in v]) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, c, v) in enumerate(used):
        if i % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, d, b) for b, (j, d, w) in enumerate(used) if b != a)
        for ps, j, _, _ in [s for s in scored if s[2] == c][:positives]:
            fitting = [(n, -s) for s, n, d, _ in scored if d != c and low * -ps <= 100 * -s <= high * -ps]
            out += [(i, j, r, n, -ps, s) for r, (n, s) in enumerate(fitting[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def cloud(n, width, seed, labels=4, size=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (size * (rng.normal(size=width) + 0.5)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("pack,block,values", [(4096, 2048, 1 << 18), (7, 3, 1 << 18), (4096, 2048, 64)])
def test_all_pairs(spark, monkeypatch, pack, block, values):
    monkeypatch.setattr(negatives, "PACK_ROWS", pack)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(negatives, "PACK_VALUES", values)
    rows = cloud(240, 6, 1)
    want = plain(rows)
    assert len(want) > 500 and found(negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)) == want


@pytest.mark.parametrize("size", [1e-3, 30.0, 1e3, 1e6])
def test_field_widths(spark, size):
    """From several fields in a machine word to integers wider than a word."""
    rows = cloud(60, 5, 2, size=size)
    got = found(negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0))
    edge = lambda s: max(-2**63, min(2**63 - 1, s))
    assert got == sorted((*r[:4], edge(r[4]), edge(r[5])) for r in plain(rows))


def test_fields_hold_exact_products():
    rng = np.random.default_rng(3)
    for low, high, width in ((-0.5, 0.5, 64), (0.0, 0.0, 3), (-900.0, 2.0, 40), (-1e30, 1e30, 3), (0.0, 1.0, 0)):
        fields = negatives.Fields(low, high, width, 256)
        whole = np.floor(256 * rng.uniform(low, high, (11, width)))
        lifted = fields.lifted(whole)
        assert (fields.read(fields.write(lifted), 11, width) == lifted).all()
        scores = fields.scores(lifted[:4], fields.pack(lifted), fields.sums(lifted[:4]), fields.sums(lifted))
        want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in whole] for a in whole[:4]]
        assert [[int(x) for x in r] for r in scores] == want
    assert negatives.Fields(-0.5, 0.5, 64, 256).per == 2 and negatives.Fields(-0.1, 0.1, 4, 256).per == 4


def test_hot_vector_ties_and_repeated_rows(spark):
    rows = [(i, [1.0, 2.0] if i % 3 == 0 else [float(i % 7), 1.0], i % 2) for i in range(120)]
    rows += rows[:12]  # id 0 and 10 are anchors twice
    assert found(negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)) == plain(rows)


def test_nulls_and_unequal_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(30, 3, 4, labels=2) + [
        (100, None, 1), (110, [1.0, None, 1.0], 1), (120, [nan, 1.0, 1.0], 0), (130, [inf, 1.0, 1.0], 0), (140, [1.0, 1.0, 1.0], None),
        (None, [1.0, 1.0, 1.0], 1), (150, [1.0], 1), (160, [1.0, 1.0, 1.0, 5.0], 0), (170, [], 0), (-10, [1.0, 2.0, 1.0], 1)]
    got = found(negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0))
    assert got == plain(rows) and {150, 160, -10} <= {r[0] for r in got}


def test_few_or_none(spark):
    mine = lambda rows: found(negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0))
    assert mine([]) == [] and mine([(1, [1.0], 1), (2, [1.0], 2)]) == [] and mine([(10, [1.0], 1)]) == []
    assert mine([(10, [1.0], 1), (11, [1.0], 1)]) == []
    assert mine([(10, [1.0], 1), (11, [1.0], 1), (12, [0.5], 2)]) == [(10, 11, 1, 12, 65536, 32768)]
    assert mine([(10, [], 1), (11, [], 1), (12, [], 2)]) == [(10, 11, 1, 12, 0, 0)]
    assert mine([(10, [-1.0], 1), (11, [1.0], 1), (12, [0.5], 2)]) == []  # nothing lies between 30 % and 90 % of a negative score


def test_other_labels_and_columns(spark):
    df = spark.createDataFrame([(10, [1.0], "a", "q"), (11, [1.0], "a", "q"), (12, [0.5], "b", "q")], "key long, v array<float>, kind string, pack string")
    got = negatives.mine(df, F.col("key") == 10, id_column="key", vector_column="v", label_column="kind")
    assert found(got) == [(10, 11, 1, 12, 65536, 32768)]
