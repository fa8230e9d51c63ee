import random
import re

import pytest
from pyspark.sql import functions as F

from snapflow.llm import decontam


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def plain(docs, items):
    """Best agreeing stretch of every pair, by trying every alignment."""
    found = {}
    for d, text in docs:
        w = tokens(text or "")
        for i, item in items:
            t = tokens(item or "")
            if len(t) < decontam.LEAST_WORDS:
                continue
            stretch = min(decontam.STRETCH, len(t))
            for shift in range(-len(t), len(w)):
                agree = [int(0 <= k + shift < len(w) and w[k + shift] == t[k]) for k in range(len(t)) if 0 <= k + shift < len(w)]
                best = max([sum(agree[k:k + stretch]) for k in range(len(agree) - stretch + 1)], default=0)
                if best >= (-(-stretch * 4 // 5) if stretch >= decontam.TOLERANT else stretch):
                    found[d, i] = max(found.get((d, i), 0), best)
    return found


def corpus():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 30, 60])))) for i in range(36)] + [(50, "too short as evidence"), (51, None), (52, "")]
    items.append((53, items[3][1]))  # the same text under another id
    docs = []
    for d in range(90):
        w = [word() for _ in range(rng.randrange(1, 120))]
        if d % 2:
            passage = tokens(items[rng.randrange(36)][1])
            for _ in range(rng.randrange(0, 1 + len(passage) // 9)):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = passage
        docs.append((d, ", ".join(w).title() if d % 3 else "; ".join(w) + "."))
    docs += [(100, None), (101, ""), (102, items[4][1]), (103, "!" + items[4][1] + "?"), (None, items[5][1]), (104, items[6][1].rsplit(" ", 3)[0])]
    return docs, items


@pytest.mark.parametrize("limit", [decontam.BROADCAST_WINDOWS, 0])
def test_leaks_against_all_alignments(spark, limit):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"words": F.lit(1), "seed": F.lit(2), "item_id": F.lit(3)})
    got = {(r["doc_id"], r["item_id"]): r["agreeing"] for r in decontam.find(d, spark.createDataFrame(items, "item_id long, text string"), broadcast_windows=limit).collect()}
    assert got == plain(docs, items)


def test_guarantee_of_the_masks():
    from itertools import combinations

    def hit(length, changed):
        return any(all(at + k not in changed for k in m) for m in decontam.MASKS[:decontam.SHORT] for at in range(length - max(m)))
    for length in range(8, 14):
        allowed = length - -(-length * 4 // 5)
        assert all(hit(length, set(c)) for c in combinations(range(length), allowed))
    assert hit(7, set()) and decontam.MASKS[decontam.SHORT] == tuple(range(decontam.LEAST_WORDS))


def test_every_placement_in_short_items(spark):
    """Items of 5 to 13 words with all placements of as many changed words as are allowed, and of one more."""
    from itertools import combinations

    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(4, 14)]
    docs, want = [], set()
    for n, text in items:
        allowed = n - -(-n * 4 // 5) if n >= 8 else 0
        for many in (0, allowed, allowed + 1):
            for places in combinations(range(n), many):
                words = text.split()
                for p in places:
                    words[p] = "changed"
                docs.append((len(docs), "before " + " ".join(words) + " after"))
                if many <= allowed and n >= 5:
                    want.add((docs[-1][0], n))
    got = decontam.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) > 200


def test_keep_clean(spark):
    docs, items = corpus()
    d = spark.createDataFrame([*docs, docs[1], docs[2]], "doc_id long, text string").withColumn("seed", F.lit(2))
    dirty = {d for d, _ in plain(docs, items)}
    kept = decontam.keep_clean(d, spark.createDataFrame(items, "item_id long, text string"))
    wanted = sorted(str(i) for i, _ in [*docs, docs[1], docs[2]] if i not in dirty)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == wanted and kept.columns == d.columns
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.keep_clean(d, nothing).count() == d.count() and decontam.keep_clean(d.limit(0), nothing).count() == 0
