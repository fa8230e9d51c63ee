import hashlib
import random
import zlib

import pytest

from snapflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, name string, weight string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple(own.get(base, [])[:h] + ts[h:])
    return out


def plain(rows):
    """A dictionary of all prefixes."""
    convs, nodes = rebuilt(rows), {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def totals(p):
        below = [totals(q) for q in children.get(p, [])]
        saved = (len(nodes[p]) - 1) * len(p[-1][1].decode()) if p else 0
        return sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below)

    def digest(p):
        return hashlib.sha256(",".join(str(c) for c in sorted(nodes[p]) if len(convs[c]) == len(p)).encode()).hexdigest()

    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *totals(p), digest(p)) for p, m in nodes.items())


def found(df):
    return sorted(tuple(r) for r in df.collect())


def chat(seed, convs, most, words, step=1):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(words)) for c in range(0, convs * step, step) for t in range(rng.randrange(1, most))]


@pytest.mark.parametrize("most,words", [(3, ["a"]), (9, ["a", "bé"]), (20, ["a", "b", ""]), (9, [str(i) for i in range(50)])])
def test_all_prefixes(spark, most, words):
    rows = chat(most, 150, most, words)
    assert found(trie.build(frame(spark, rows))) == plain(rows)


def test_depths_around_powers_of_two(spark):
    for depth in (1, 2, 3, 7, 8, 9, 16, 17):
        rows = [(c, t, "user", "same" if t < depth - c % 2 else f"own {c}") for c in (0, 1, 2, 7) for t in range(depth)]
        assert found(trie.build(frame(spark, rows))) == plain(rows), depth


def test_one_conversation_holds_most_turns(spark):
    """Its turns are spread over many ranges, also where turn numbers are missing or repeat."""
    rng = random.Random(5)
    rows = [(300, rng.choice([None, rng.randrange(900)]), rng.choice(["user", None, "r" * 70 + "x", "r" * 70, "r" * 64]), rng.choice(["t", "u" * 65 + "b", "u" * 65 + "a", None])) for _ in range(700)]
    rows += chat(6, 30, 6, ["t"], step=11)
    got = found(trie.build(frame(spark, rows).repartition(7)))
    assert got == plain(rows) and max(r[1] for r in got) >= 690


def test_many_equal_conversations(spark):
    """Thousands end at one node: their ids pass by in chunks."""
    rows = [(c, t, "user", f"t{t}") for c in range(2500) for t in range(8)]
    got = found(trie.build(frame(spark, rows)))
    assert got == plain(rows) and len(got) == 9


def test_nulls_ties_negative_ids_and_turnless(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, None, "user", "a"), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", ""),
            (-5, 0, "user", "a"), (-105, 1, "user", "a"), (-100, 2, "user", "b"), (-199, 0, "user", "q"), (2**63 - 1, 0, "user", "z"), (-(2**63), 0, "user", "z")]
    lone = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows += [(lone, 0, "user", "gone")]  # its family's first conversation is absent and all its own turns are left out
    got = found(trie.build(frame(spark, rows)))
    assert got == plain(rows) and rebuilt(rows)[lone] == ()


def test_empty_and_only_turnless(spark):
    assert found(trie.build(frame(spark, []))) == [] and found(trie.build(frame(spark, [(None, 1, "user", "x")]))) == []
    lone = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(lone, 0, "user", "gone")]
    assert found(trie.build(frame(spark, rows))) == plain(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_role_and_text_are_kept_apart(spark):
    rows = [(0, 0, "ab", "c"), (6, 0, "a", "bc"), (7, 0, "", "abc"), (200, 0, "ab", "c"), (206, 0, "a", "bc")]
    assert found(trie.build(frame(spark, rows))) == plain(rows)


def test_other_names_and_scratch(spark):
    df = spark.createDataFrame([(0, 0, "user", "x")], "id long, n int, who string, said string")
    scratch = []
    assert trie.build(df, "id", "n", "who", "said", scratch).count() == len(plain([(0, 0, "user", "x")])) and scratch
