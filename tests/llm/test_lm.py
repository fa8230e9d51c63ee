import collections
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from snapflow.llm import lm, wordcode
from snapflow.session import discard, list_files, settled


def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))] + [b"\n"]


def corpus(seed=1, n=160):
    rng = random.Random(seed)
    syllables = ["tion", "re", "st", "ly", "an", "er", "con", "é", "mo"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(words[:20] if rng.random() < 0.6 else words) for _ in range(rng.randrange(1, 80))).capitalize()) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a\x1cb \x85 É"), (3, rows[3][1]), (None, rows[4][1]), (1004, "word " * 3000)]


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").withColumns({"word": F.lit(1), "score": F.lit("x"), "block": F.lit(None)})
    return [r.asDict() for r in lm.score(docs, F.col("doc_id") % 5 == 1).collect()]


def test_base_against_plain_counts(scored):
    counts = collections.Counter()
    for d, text in corpus():
        if d is not None and d % 5 != 1:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for d, text in corpus():
        t = tokens(text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        wanted.append((d or -1, None if d is None else d % 5 == 1, len(t), sum(counts[w] > 0 for w in t), total, round(base, 6)))
    got = [(r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in scored]
    key = lambda r: (r[0], str(r[1:]))
    assert len(got) == len(wanted)
    for a, b in zip(sorted(got, key=key), sorted(wanted, key=key)):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-5


def test_scores(scored):
    by = {r["doc_id"]: r for r in scored}
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in scored)
    assert by[1000]["score"] == by[1001]["score"] == by[1002]["score"] and by[1000]["n_tokens"] == 1
    held = [r for r in scored if r["held_out"]]
    assert np.mean([r["bits_per_byte"] for r in held if r["n_tokens"] > 20]) < 3  # of 8 without a model


def test_blocks_and_small_batches_change_nothing(spark, scored, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(7)
    again = lm.score(docs, F.col("doc_id") % 5 == 1).collect()
    key = lambda r: (r["doc_id"] or -1, r["n_tokens"], round(r["score"], 6))
    assert sorted(map(key, again)) == sorted(map(key, scored))


def test_a_words_bits_are_its_bytes_and_prefixes_meet():
    b = lm.spell([b"abc", b"abd", b"\n", b"x"])
    assert len(b.bit) == 8 * (4 + 4 + 1 + 2)
    bits = [int("".join(map(str, b.bit[i:i + 8])), 2) for i in range(0, len(b.bit), 8)]
    assert bytes(bits) == b"abc abd \nx "
    for s in b.slots:  # both words are the same up to their third byte
        assert (s[:16] == s[32:48]).all()
    assert (b.slots[-1][24:32] != b.slots[-1][56:64]).any()


def test_spelling_is_a_distribution():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (2, lm.SLOTS)).astype(np.float32)
    learner = wordcode.Learner(wordcode.Mixer.fresh(len(lm.SLOT_BITS)))
    lm.train_spelling(learner, counts, [b"ab", b"ac", b"\n"])
    first = 10 ** lm.Model(counts, learner.mixer).log10([bytes([b]) for b in range(256) if b not in (lm.SPACE, lm.END)])
    assert first.sum() <= 1 + 1e-3  # one-byte words and their end share what the first byte gives them


def test_contexts_that_look_alike_are_priced_once(monkeypatch):
    rng = np.random.default_rng(11)
    keys = np.unique(rng.integers(0, 2 ** 32, 4_000, dtype=np.uint64) << np.uint64(32) | rng.integers(0, 2 ** 32, 4_000, dtype=np.uint64))
    keys = np.unique(np.concatenate([keys, keys[::5] ^ np.uint64(1 << 24), keys[::9] ^ np.uint64(1 << 22)]))
    uses = np.minimum(rng.geometric(0.5, len(keys)) - 1, 9)
    uses[::97] = 5_000
    bits = wordcode.levels(keys, uses, wordcode.tally(keys, uses)[:65536].reshape(64, -1))
    mixer, mix, asked = wordcode.train([level for level, _, _ in bits]), wordcode.Mixer.mix, []
    monkeypatch.setattr(wordcode.Mixer, "mix", lambda self, inputs, *rest: asked.append(len(inputs)) or mix(self, inputs, *rest))
    for level, _, _ in bits:
        asked.clear()
        got = wordcode.log_odds(mixer, level)
        kinds = np.unique(np.column_stack([level.cell, level.ones, level.zeros]), axis=0)
        assert len(kinds) <= sum(asked) < len(level.ones)
        inputs, gate = level.inputs(np.arange(len(level.ones)))  # every context by itself
        depth = np.full(len(gate), level.depth)
        one, two = mix(mixer, inputs, gate, depth)
        p = np.clip(mixer.refine((one + two) / 2, depth)[0], 1e-6, 1 - 1e-6)
        assert (got == np.log10(np.stack([1 - p, p], axis=1))).all()


def test_words_of_a_batch_against_split():
    texts = ["Ab  c\x1cd\x85\n", "", " \t\v\f\r\n", "x", "É z\u00a0Y é", "a", " lead", "b" * 50, "\x00 \x00"]
    batch = pa.RecordBatch.from_arrays([pa.array(["before", *texts, "behind"])], ["text"]).slice(1, len(texts))
    wanted = [tokens(t)[:-1] for t in texts]
    words, counts, sizes = lm._words(batch)
    assert words.to_pylist() == sum(wanted, []) and list(counts) == list(map(len, wanted)) and list(sizes) == [sum(map(len, w)) for w in wanted]
    kinds, numbers = lm._one_list([words, lm._words(batch.slice(3, 2))[0]])
    assert kinds.take(pa.array(numbers)).to_pylist() == sum(wanted + wanted[3:5], []) + [b"\n"] and len(kinds) == len(set(kinds.to_pylist()))
    empty = lm._words(batch.slice(1, 2))
    assert len(empty[0]) == 0 and list(empty[1]) == list(empty[2]) == [0, 0] and lm._one_list([empty[0]])[0].to_pylist() == [b"\n"]


def test_names_of_words_are_their_xxh64():
    rng = random.Random(12)
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(70), *range(70)]]
    for some in (words, pa.array(words, pa.large_binary()), pa.array([b"x", *words], pa.large_binary()).slice(1)):
        assert wordcode.hashes(some).tolist() == [xxhash.xxh64_intdigest(w, 42) for w in words]
        code, rest, before = wordcode.describe(some)
        for w, c, r, b in zip(words, code.tolist(), rest.tolist(), before.tolist()):
            h = xxhash.xxh64_intdigest(w, 42)
            group = int.from_bytes(w[-2:], "big") * 0x9E3779B1 % 2 ** 32 >> 26
            assert (c, r, b) == (h >> 48, h >> 26 & 2 ** 22 - 1, group << 26 | h & 2 ** 26 - 1)
    assert len(wordcode.hashes([])) == 0


def test_numbers_of_any_size_come_back():
    streams = [np.array(x, np.uint32) for x in ([], [0, 0], [255], [256, 1], [2 ** 24 - 1, 0, 3], [2 ** 24, 2 ** 32 - 1])]
    assert [list(x) for x in wordcode.expand(wordcode.squeeze(*streams), *map(len, streams))] == [list(x) for x in streams]


def priced(pairs, words):
    """All buckets of a small corpus, every pair of its words included; log10 probability of a word behind another."""
    code, rest, before = wordcode.describe(words)
    n = len(words)
    a, b = np.divmod(np.arange(n * n), n)
    bucket, names = wordcode.key(code[b], rest[b], before[a], 0)
    keys = before[a] << np.uint64(32) | names
    uses = np.array([pairs[int(x), int(y)] for x, y in zip(a, b)])
    order = np.lexsort((keys, bucket))
    by_slot, tables = np.zeros((wordcode.SLOTS, 64)), {}
    for k in np.unique(bucket):
        mine = order[bucket[order] == k]
        table = wordcode.tally(keys[mine], uses[mine])
        tables[k] = mine, table[:65536].reshape(64, -1)
        by_slot[:, k] = table[65536:]
    first = wordcode.first_bits(by_slot)
    counts = np.bincount(b, weights=uses)
    total = np.bincount(code.astype(int), weights=counts, minlength=65536)
    out = np.zeros(n * n)
    for k, (mine, table) in tables.items():
        cost, share, rest_share = wordcode.price(keys[mine], uses[mine], table, first[:, k])
        among = counts[b[mine]] / np.maximum(total[code[b[mine]].astype(int)], 1)
        out[mine] = cost + np.log10(np.maximum(share + rest_share * among, 1e-300))
    return out.reshape(n, n), counts


def test_known_words_share_what_a_word_before_gives_them():
    rng = random.Random(4)
    words = [b"\n"] + [f"w{i}".encode() for i in range(150)]
    pairs = collections.Counter((rng.randrange(151), min(rng.randrange(151), rng.randrange(151))) for _ in range(3_000))
    costs, counts = priced(pairs, words)
    shares = (10 ** costs)[:, counts > 0].sum(axis=1)
    assert (shares <= 1 + 1e-3).all() and (shares > 0.01).all()
    seen = np.array([[pairs[i, j] > 1 for j in range(151)] for i in range(151)])
    assert costs[seen].mean() > costs[~seen].mean() + 0.3


def test_contexts_of_code_bits_against_plain_counts():
    rng = np.random.default_rng(3)
    before = np.sort(rng.integers(0, 2 ** 32, 12, dtype=np.uint64))
    keys = np.unique(rng.choice(before, 400) << np.uint64(32) | rng.integers(0, 2 ** 32, 400, dtype=np.uint64))
    uses = rng.integers(0, 4, len(keys))
    by_class = wordcode.tally(keys, uses)[:65536].reshape(64, -1)
    for level, where, bit in wordcode.levels(keys, uses, by_class):
        depth = level.depth - wordcode.TOP
        path = [format(int(k) >> 22 & 1023, "010b") for k in keys]
        last = [int(k) >> 32 for k in keys]
        for i in range(0, len(keys), 7):
            alike = [j for j in range(len(keys)) if path[j][:depth] == path[i][:depth]]
            for value, got in (("1", level.ones), ("0", level.zeros)):
                mine = [j for j in alike if path[j][depth] == value]
                want = [sum(uses[j] for j in mine if last[j] == last[i]), sum(uses[j] for j in mine if last[j] >> 26 == last[i] >> 26), sum(uses[j] for j in mine)]
                assert list(got[where[i]]) == want
            assert bit[i] == int(path[i][depth])


def test_cases_stand_for_every_use():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 30, 500, dtype=np.uint64) << np.uint64(58) | rng.integers(0, 2 ** 32, 500, dtype=np.uint64))
    uses = rng.integers(0, 3, len(keys))
    for level, _, _ in wordcode.levels(keys, uses, wordcode.tally(keys, uses)[:65536].reshape(64, -1)):
        _, own, weight = level.cases()
        assert weight.sum() == uses.sum() and weight[own].sum() == level.ones[:, 0].sum()


def test_packed_pairs_come_back():
    rng = np.random.default_rng(6)
    words = np.sort(rng.integers(0, 2 ** 32, 300, dtype=np.uint32))[rng.integers(0, 300, 999)]
    words.sort()
    before, uses = rng.choice(rng.integers(0, 2 ** 32, 40, dtype=np.uint64), 999), rng.integers(0, 2 ** 31, 999)
    back = wordcode.unpack(wordcode.pack(words, before, uses))
    assert (back[0] == (before << np.uint64(32) | words)).all() and (back[1] == uses).all()


def test_arranged_pairs_pack_smaller_and_come_back():
    rng = np.random.default_rng(9)
    words = np.sort(rng.choice(rng.integers(0, 2 ** 32, 40, dtype=np.uint32), 8_000))
    before = rng.choice(rng.integers(0, 2 ** 32, 900, dtype=np.uint64), 8_000)
    uses = rng.integers(0, 3, 8_000)
    order = wordcode.arrange(words, before)
    assert (words[order] == words).all() and sorted(order) == list(range(8_000))
    packed = wordcode.pack(words, before[order], uses[order])
    back = wordcode.unpack(packed)
    assert (back[0] == (before[order] << np.uint64(32) | words)).all() and (back[1] == uses[order]).all()
    assert len(packed) < 0.8 * len(wordcode.pack(words, before, uses))


def test_packed_words_and_long_numbers_come_back():
    words = [b"\n", b"", "né\x1c".encode(), b"a" * 70_000, b"\x00"]
    uses = np.array([0, 1, 2 ** 32 - 1, 5, 0])
    back = wordcode.unpack_words(wordcode.pack_words(words, uses))
    assert back[0].to_pylist() == words and list(back[1]) == list(uses)
    assert len(wordcode.unpack_words(wordcode.pack_words([], np.zeros(0)))[0]) == 0
    many = np.array([0, 1, 2 ** 32 - 1, 2 ** 32, 2 ** 62 + 7])
    assert list(wordcode.expand_long(wordcode.squeeze_long(many), 5)) == list(many)


def test_counts_travel_as_small_numbers():
    keys = np.array([7 << 32 | 1 << 22, 7 << 32 | 1 << 22 | 1, 7 << 32 | 1 << 22 | 2, 7 << 32 | 2 << 22, 9 << 32], np.uint64)
    uses = np.array([3, 1, 0, 5, 0])
    assert wordcode.rivals(keys, uses).tolist() == [[3, 1, 0, 5, 0], [1, 3, 4, 0, 0], [1, 1, 2, 0, 0]]
    share, rest = wordcode.shares(*wordcode.rivals(keys, uses))
    assert np.allclose(share, [3 / 6, 1 / 6, 0, 5 / 6, 0]) and np.allclose(rest, [2 / 6, 2 / 6, 2 / 6, 1 / 6, 1])
    huge = wordcode.rivals(keys, uses << 40)
    assert huge.max() < 2 ** 32 and np.allclose(wordcode.shares(*huge)[0][:2], [3 / 4, 1 / 4], atol=1e-6)


def test_neither_words_nor_pairs_of_a_block_are_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 64)
    rng = random.Random(10)
    texts = [" ".join(f"w{rng.randrange(4_000)}" for _ in range(400)) for _ in range(80)]
    rows = spark.createDataFrame([(i, t, i % 5 == 1, i % 5 != 1) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean, learned boolean").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        both = settled(lm._blocks(rows, rows.schema["doc_id"].dataType, 0))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    blocks = both.select("block").distinct().count()
    words = both.filter("words IS NOT NULL")
    held = [w for r in words.select("words").collect() for w in wordcode.unpack_words(r["words"])[0].to_pylist()]
    assert blocks > 4 and set(held) == {w.encode() for t in texts for w in t.split()} | {b"\n"}
    assert words.count() <= blocks * 8 < len(held) / 20 and both.filter("pairs IS NOT NULL").count() <= blocks * 64
    counted = lm._count_words(both)
    assert counted.filter("totals IS NOT NULL").count() == words.count()
    uses = {r["word"]: r["uses"] for r in counted.filter("word IS NOT NULL").collect()}
    assert uses == collections.Counter(w for i, t in enumerate(texts) if i % 5 != 1 for w in tokens(t))


def test_what_nothing_reads_again_is_deleted(spark):
    scratch = []
    out = lm.score(spark.createDataFrame(corpus(), "doc_id long, text string"), F.col("doc_id") % 5 == 1, scratch=scratch)
    assert len(scratch) == 2 and {os.path.basename(p) for p in list_files(spark, scratch[0]) if "part=" in p} == {"part=data", "part=pairs", "part=seconds"}
    assert out.count() == len(corpus())
    discard(spark, scratch)


def test_order_of_words_counts(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("ka", "mo", "ri", "su") for b in ("la", "ne", "to", "vi", "x", "y")]
    follow = {w: rng.sample(words, 3) for w in words}

    def text(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return out

    rows = [(i, " ".join(text(60))) for i in range(200) if i % 5 != 1]
    fresh = text(80)
    mixed = rng.sample(fresh, len(fresh))
    rows += [(1, " ".join(fresh)), (6, " ".join(mixed))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (lm.BUCKET_BYTES, 64):  # the second deals every code prefix into several buckets
        monkeypatch.setattr(lm, "BUCKET_BYTES", size)
        by = {r["doc_id"]: r for r in lm.score(docs, F.col("doc_id") % 5 == 1).collect()}
        assert by[1]["score"] > by[6]["score"] + 10 and round(by[1]["base_score"], 6) == round(by[6]["base_score"], 6)
        assert by[1]["score"] > by[1]["base_score"] + 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(docs, F.col("doc_id") % 5 == 1).count() == 0
    alone = lm.score(spark.createDataFrame([(1, "never learned")], "doc_id long, text string"), F.col("doc_id") % 5 == 1).first()
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and alone["n_tokens"] == 3
