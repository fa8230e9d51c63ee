"""Language-model scores by logistic context mixing, beside a smoothed word model.

A text is its words in lower case and an end mark. Each word is a string of bits: one says whether the corpus knows it,
then a known word has the bits of its code, predicted behind the word before it (``wordcode``), and an unknown one is
spelled, a space behind it. Spelling predicts every bit of every byte from hashed contexts (the last one to four bytes
of the word, and all of it so far). In both, counts over the training words give a prediction per context, gated weight
sets combine them in the logistic domain, and adaptive probability maps refine the outcome. Weights and maps are trained
online: a block is predicted first and updates them afterwards, with an item's own occurrence taken out of the counts.
Whether a word is unknown is as likely as an occurrence of the training words that is the only one of its word.

Spark's part: texts are cut into blocks, each with its own lists of distinct words and of distinct pairs of neighbours.
Words are counted, pairs counted and priced, in buckets (a packed list per block and bucket, so that a block's words and
pairs are no rows), and what was found is sent back to the block. Both grow with the corpus and stay in Spark;
the driver holds tables of fixed size: counts of spelling contexts, of classes and of slots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.llm import wordcode
from snapflow.llm.common import small_batches
from snapflow.llm.wordcode import Learner, Mixer, confidence, stretch
from snapflow.session import delete, settled

SPACE, END = 0x20, 0x0A  # no word holds either
SLOT_BITS = (16, 18, 20, 21, 22)  # slots of the contexts: last 1, 2, 3, 4 bytes, the whole word so far
CHUNK = 1 << 12
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 4 << 20
WORD_BITS = 3  # a bucket of words is that much larger
STEPS = 1024  # of a log10, in what pairs cost
COUNTERS, TALLIERS, LEARNERS, LEARNER_WORDS = 32, 8, 256, 20_000  # tasks that hold a count table or all tallies; those that train weights, and words for one
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK = b" \t\n\v\f\r"
_INSIDE = bytes(b not in _BLANK for b in range(256))
_OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])])
SLOTS = int(_OFFSETS[-1])
TALLY = wordcode.CLASSES * wordcode.LEAVES + wordcode.SLOTS


@dataclass
class Bits:
    """All bits of some words: their slots in every context, values, gates, and the word each belongs to."""

    slots: list[np.ndarray]
    bit: np.ndarray
    node: np.ndarray
    place: np.ndarray
    word: np.ndarray


def spell(words: list[bytes]) -> Bits:
    """Bit by bit, most significant first; the end mark is one byte, any other word has a space behind it."""
    spelt = [w if w == b"\n" else w + b" " for w in words]
    data = np.frombuffer(b"".join(spelt), np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, spelt), np.int64, len(spelt))
    word = np.repeat(np.arange(len(spelt)), lengths)
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.arange(len(data)) - start
    back = [np.where(at >= k, np.concatenate([np.zeros(k, np.uint32), data[:-k]])[:len(data)], 0) for k in (1, 2, 3, 4)]
    contexts, code = [], np.zeros(len(data), np.uint32)
    for k in range(4):
        code = (code + back[k] + np.uint32(1)) * np.uint32(0x9E3779B1)
        contexts.append(code ^ code >> np.uint32(15))
    # The whole word so far: prefix sums of byte codes that depend on their place, so that equal prefixes meet.
    mixed = (data + np.uint32(7)) * (at.astype(np.uint32) * np.uint32(0x85EBCA6B) + np.uint32(0xC2B2AE35))
    mixed = (mixed ^ mixed >> np.uint32(13)) * np.uint32(0x27D4EB2F)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    prefix = (sums[:-1] - sums[start]).astype(np.uint32) + at.astype(np.uint32)
    contexts.append((prefix ^ prefix >> np.uint32(16)) * np.uint32(0x7FEB352D))
    steps = np.arange(8, dtype=np.uint32)
    node = (np.uint32(1) << steps)[None, :] | data[:, None] >> (np.uint32(8) - steps)[None, :]
    slots = []
    for k, (context, bits) in enumerate(zip(contexts, SLOT_BITS)):
        mixed = (context[:, None] + node * np.uint32(0x3C6EF372)) * np.uint32(0x9E3779B1)
        mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x846CA68B)
        slots.append(((mixed >> np.uint32(32 - bits)).astype(np.int32) + np.int32(_OFFSETS[k])).ravel())
    bit = (data[:, None] >> (np.uint32(7) - steps)[None, :] & np.uint32(1)).ravel()
    place = np.repeat(np.minimum(at, 7), 8) * 8 + np.tile(np.arange(8), len(data))
    return Bits(slots, bit.astype(np.int8), node.ravel().astype(np.int32), place.astype(np.int32), np.repeat(word, 8))


def paired(counts: np.ndarray) -> np.ndarray:
    """Zeros and ones of a slot side by side (as one complex number), so that one look-up finds both."""
    return counts if np.iscomplexobj(counts) else np.ascontiguousarray(counts.T, np.float32).view(np.complex64).ravel()


def _inputs(counts: np.ndarray, b: Bits, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and gates of all bits from zeros and ones per slot (``paired``); ``own`` takes a word's own occurrence out."""
    found = np.stack([counts.take(s) for s in b.slots])
    ones, zeros = found.imag, found.real
    if own is not None:
        ones, zeros = np.maximum(ones - own, 0), np.maximum(zeros - ~own, 0)
    total = ones + zeros
    return np.ascontiguousarray(stretch(ones, total).T), confidence(total[-1]).astype(np.int32) * 8 + confidence(total[-3])


@dataclass
class Model:
    counts: np.ndarray
    mixer: Mixer

    def log10(self, words: list[bytes], block: int = 512) -> np.ndarray:
        """log10 probability of each word's spelling."""
        out, counts = np.zeros(len(words)), paired(self.counts)
        for at in range(0, len(words), block):
            part = words[at:at + block]
            b = spell(part)
            inputs, gate = _inputs(counts, b)
            one, two = self.mixer.mix(inputs, gate, b.place)
            p, _ = self.mixer.refine((one + two) / 2, b.node)
            p = np.clip(np.where(b.bit == 1, p, 1 - p), 1e-6, 1 - 1e-6)
            out[at:at + block] = np.bincount(b.word, weights=np.log10(p), minlength=len(part))
        return out


def train_spelling(learner: Learner, counts: np.ndarray, words: list[bytes], block: int = 512, rate: float = 0.1) -> None:
    """Go through words once, each bit predicted without the word's own occurrence."""
    counts = paired(counts)
    for at in range(0, len(words), block):
        b = spell(words[at:at + block])
        own = b.bit == 1
        inputs, gate = _inputs(counts, b, own)
        learner.step(inputs, gate, b.place, b.node, own, np.ones(len(own)), rate)


def _words(batch: pa.RecordBatch) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of a batch's texts one after another, how many each text has, and its bytes without white space."""
    column = batch.column("text").cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64, len(column) + 1, 8 * column.offset)
    plain = bytes(memoryview(data or b"")[ends[0]:ends[-1]])
    ends = ends - ends[0]
    inside = np.frombuffer(plain.translate(_INSIDE), np.bool_)
    starts = np.empty(len(inside), np.bool_)
    starts[1:] = inside[1:] & ~inside[:-1]
    first = ends[:-1][np.diff(ends) > 0]
    starts[first] = inside[first]
    counts = np.diff(np.searchsorted(np.flatnonzero(starts), ends))
    starts, plain = starts[inside], plain.translate(_LOWER, _BLANK)
    del inside
    begins = np.append(np.flatnonzero(starts), len(plain))
    sizes = np.diff(begins[np.concatenate([[0], np.cumsum(counts)])])
    words = pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(plain)])
    return words.dictionary_encode(), counts, sizes


def _one_list(parts: list[pa.DictionaryArray]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of all parts and an end mark, and the number of every word in it; the end mark has the last one."""
    kinds = [*(p.dictionary for p in parts), pa.array([b"\n"], pa.large_binary())]
    coded = pa.concat_arrays(kinds).dictionary_encode()
    number, cuts = coded.indices.to_numpy(), np.cumsum([0, *map(len, kinds)])
    return coded.dictionary, np.concatenate([*(number[i:j][p.indices.to_numpy()] for p, i, j in zip(parts, cuts[:-1], cuts[1:])), number[-1:]])


def _blocks(rows: DataFrame, kind: T.DataType, spread: int) -> DataFrame:
    """Texts by blocks. Rows with ``words``: a block's distinct words of one bucket and their uses in training. With
    ``data``: its texts over its distinct pairs of neighbours. With ``pairs``: those pairs of one bucket and their uses in
    training. With ``seconds``: the second word of every pair, in the order of buckets, and the code of every word. With
    ``tally``: uses by class and slot of one code prefix. ``part`` names the one of these columns that a row has."""
    schema = T.StructType([*T.StructType.fromDDL("block long, words binary").fields, T.StructField("doc_id", kind), *T.StructType.fromDDL(
        "held_out boolean, tokens long, bytes long, data binary, bucket int, pairs binary, seconds binary, tally binary, part string").fields])
    word_bits = max(0, wordcode.TOP + spread - WORD_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        spelt: list[pa.DictionaryArray] = []
        docs: list[tuple] = []
        types: dict[str, pa.DataType] = {}

        def emit(**columns: list | np.ndarray) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            columns["part"] = [next(c for c in ("words", "data", "pairs", "seconds", "tally") if c in columns)] * n
            columns["block"] = np.full(n, part << 32 | number)
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], types[f.name]) if f.name in columns else pa.nulls(n, types[f.name]) for f in schema.fields], schema.names)

        def flush() -> Iterator[pa.RecordBatch]:
            ids, held_out, size, learn, counts = zip(*docs)
            words, number_of = _one_list(spelt)
            spelt.clear()
            code, rest, before = wordcode.describe(words)
            order = np.argsort(code << np.uint64(22) | rest)  # words are numbered by name, so that a bucket's pairs name theirs by small steps
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            words, code, rest, before = words.take(pa.array(order)), code[order], rest[order], before[order]
            ends = np.cumsum(np.array(counts) + 1)  # a text's last token is its end
            second = np.full(ends[-1], rank[-1])
            inside = np.ones(len(second), np.bool_)
            inside[ends - 1] = False
            second[inside] = rank[number_of[:-1]]  # the end mark is the last of the list
            del number_of, inside, order, rank
            first = np.concatenate([second[-1:], second[:-1]])  # a text's end is what the next one begins behind
            learned = np.repeat(learn, np.diff(ends, prepend=0))
            pairs, place = wordcode.distinct(second.astype(np.int64) * len(words) + first)  # lists as long as the block are short, and kept no longer than needed
            uses = np.bincount(place[learned], minlength=len(pairs)).astype(np.uint32)
            del first, second, learned
            behind = (pairs // len(words)).astype(np.int32)
            ahead = (pairs - behind * np.int64(len(words))).astype(np.int32)
            del pairs
            bucket, names = wordcode.key(code[behind], rest[behind], before[ahead], spread)
            order = np.argsort(bucket.astype(np.uint16) if spread <= 10 else bucket, kind="stable")  # short numbers are sorted by radix
            bucket, names, ahead = bucket[order], names[order], before[ahead[order]].astype(np.uint32)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            inside, ranked = [], []
            for i, j in zip(cuts[:-1], cuts[1:]):
                some = wordcode.ranks(ahead[i:j])
                best = wordcode.arrange(names[i:j], ahead[i:j], some)
                inside.append(i + best)
                ranked.append((*some[:2], some[2][best]))
            inside = np.concatenate(inside)
            order, names, ahead = order[inside], names[inside], ahead[inside]
            behind, uses = behind[order], uses[order]
            places = np.empty(len(order), np.int32)
            places[order] = np.arange(len(order), dtype=np.int32)
            place = places[place]
            del order, inside, places
            yield emit(seconds=[wordcode.squeeze(np.diff(behind, prepend=0) & 0xFFFFFFFF, np.diff(code.astype(np.int64), prepend=0))])
            for i, j, some in zip(cuts[:-1], cuts[1:], ranked):
                yield emit(bucket=[int(bucket[i])], pairs=[wordcode.pack(names[i:j], ahead[i:j], uses[i:j], some)])
            del ranked
            ends_of = np.searchsorted(bucket, np.arange((1 << wordcode.TOP) + 1, dtype=np.int32) << spread)
            for prefix, (i, j) in enumerate(zip(ends_of[:-1], ends_of[1:])):
                if uses[i:j].any():
                    yield emit(bucket=[prefix], tally=[wordcode.squeeze(wordcode.tally(ahead[i:j].astype(np.uint64) << np.uint64(32) | names[i:j], uses[i:j]))])
            total = np.bincount(behind, weights=uses, minlength=len(words)).astype(np.int64)
            named = (code << np.uint64(22) | rest) >> np.uint64(38 - word_bits)  # words are in this order
            cuts = np.append(np.flatnonzero(np.diff(named.astype(np.int64), prepend=-1)), len(words))
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield emit(bucket=[int(named[i])], words=[wordcode.pack_words(words.slice(i, j - i), total[i:j])])
            for k in range(0, len(docs), 1 << 12):
                begin, mine = ends[k] - counts[k] - 1, ends[k:k + (1 << 12)]
                of_text = np.repeat(np.arange(len(mine), dtype=np.int64), np.diff(mine, prepend=begin))
                held = np.sort(of_text << np.int64(32) | place[begin:mine[-1]])
                start = np.flatnonzero(np.diff(held, prepend=-1))
                times, held = np.diff(np.append(start, len(held))).astype(np.uint32), held[start]
                steps = np.diff(held & 0xFFFFFFFF, prepend=0)
                parts = np.searchsorted(held, np.arange(len(mine) + 1) << 32)
                steps[parts[:-1]] = held[parts[:-1]] & 0xFFFFFFFF
                steps = steps.astype(np.uint32)
                packed = [wordcode.squeeze(steps[i:j], times[i:j]) for i, j in zip(parts[:-1].tolist(), parts[1:].tolist())]
                upto = slice(k, k + len(mine))
                yield emit(doc_id=list(ids[upto]), held_out=list(held_out[upto]), tokens=np.diff(mine, prepend=begin), bytes=list(size[upto]), data=packed)

        for batch in small_batches(batches):
            types = {f.name: t for f, t in zip(schema.fields, [pa.int64(), pa.binary(), batch.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(),
                                                              pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string()])}
            words, counts, sizes = _words(batch)
            spelt.append(words)
            sizes += counts + 1
            docs.extend(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out")), sizes.tolist(), batch.column("learned").to_pylist(), counts.tolist()))
            held += int(sizes.sum())
            if held >= BLOCK_BYTES:
                yield from flush()
                number, held, docs = number + 1, 0, []
                pa.default_memory_pool().release_unused()
        if docs:
            yield from flush()

    return rows.mapInArrow(run, schema)


def _count_words(both: DataFrame) -> DataFrame:
    """Uses in training, bucket by bucket. Rows with ``word``: every word that training knows. With ``totals``: the uses of
    a block's words in that bucket, and those of them that have none."""
    schema = "block long, bucket int, size long, totals binary, unknown binary, word binary, uses long"

    def add(table: pa.Table) -> pa.Table:
        lists = [wordcode.unpack_words(x) for x in table.column("words").to_pylist()]
        coded = pa.concat_arrays([words for words, _ in lists]).dictionary_encode()
        place = coded.indices.to_numpy()
        total = np.bincount(place, weights=np.concatenate([uses for _, uses in lists])).astype(np.int64)
        cuts, totals, unknown = np.cumsum([0, *(len(uses) for _, uses in lists)]), [], []
        for (words, _), i, j in zip(lists, cuts[:-1], cuts[1:]):
            mine = total[place[i:j]]
            new = words.take(pa.array(np.flatnonzero(mine == 0)))
            totals.append(wordcode.squeeze_long(mine))
            unknown.append(wordcode.pack_words(new, np.zeros(len(new))))
        known = np.flatnonzero(total)
        blocks = {"block": table.column("block"), "bucket": table.column("bucket"), "size": pa.array(np.diff(cuts)), "totals": pa.array(totals, pa.binary()), "unknown": pa.array(unknown, pa.binary())}
        words = {"word": coded.dictionary.take(pa.array(known)).cast(pa.binary()), "uses": pa.array(total[known])}
        types = {"block": pa.int64(), "bucket": pa.int32(), "size": pa.int64(), "totals": pa.binary(), "unknown": pa.binary(), "word": pa.binary(), "uses": pa.int64()}
        return pa.concat_tables([pa.table({c: some[c] if c in some else pa.nulls(n, t) for c, t in types.items()}) for some, n in ((blocks, len(lists)), (words, len(known)))])

    return both.filter("part = 'words'").select("block", "bucket", "words").groupBy("bucket").applyInArrow(add, schema)


def _counts(vocabulary: DataFrame) -> np.ndarray:
    """Zeros and ones of every slot, each training word counted once, as new words are like rare ones: ``SLOTS`` pairs."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, SLOTS), np.int32)
        for batch in batches:
            b = spell(batch.column("word").to_pylist())
            for s in b.slots:
                cells, times = np.unique(s + b.bit * np.int32(SLOTS), return_counts=True)
                table.reshape(-1)[cells] += times.astype(np.int32)
        for k in range(0, SLOTS, CHUNK):
            part = table[:, k:k + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([zstandard.compress(part.tobytes(), 1)])], ["chunk", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zstandard.decompress(x), np.int32).astype(np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([zstandard.compress(total.tobytes(), 1)])})

    parts = vocabulary.filter("uses > 0").select("word").coalesce(COUNTERS).mapInArrow(tally, "chunk long, counts binary")
    out = np.zeros((2, SLOTS), np.float32)
    for row in parts.groupBy("chunk").applyInArrow(add, "chunk long, counts binary").toLocalIterator():
        out[:, row["chunk"]:row["chunk"] + CHUNK] = np.frombuffer(zstandard.decompress(row["counts"]), np.int64).reshape(2, -1)
    return out


def _table(counts: Broadcast) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(counts.value), np.complex64)


def _spelling(vocabulary: DataFrame) -> tuple[Broadcast, Mixer]:
    """Count tables over all training words; weights over all that occur once, trained in parts and averaged."""
    spark = vocabulary.sparkSession
    counts = spark.sparkContext.broadcast(zstandard.compress(paired(_counts(vocabulary)).tobytes(), 1))  # 2 x SLOTS floats

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, n, table = Learner(Mixer.fresh(len(SLOT_BITS))), 0, _table(counts)
        for batch in batches:
            train_spelling(learner, table, batch.column("word").to_pylist())
            n += batch.num_rows
        if n:
            state = [learner.mixer.by_confidence * n, learner.mixer.by_place * n, learner.hits, learner.seen]
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([np.concatenate([x.ravel() for x in state]).astype(np.float64).tobytes()])], ["n", "state"])

    n, state = 0, None
    once = vocabulary.filter("uses = 1").select("word")
    parts = min(max(once.count() // LEARNER_WORDS, 1), LEARNERS)
    dealt = once.repartition(parts, "word").sortWithinPartitions(F.xxhash64("word"), "word")  # the same order on every run
    for row in dealt.mapInArrow(learn, "n long, state binary").collect():  # at most LEARNERS rows
        mine = np.frombuffer(row["state"])
        n, state = n + row["n"], mine if state is None else state + mine
    mixer = Mixer.fresh(len(SLOT_BITS))
    if state is not None:
        size = mixer.by_confidence.size
        mixer.by_confidence, mixer.by_place = ((state[k * size:(k + 1) * size] / n).reshape(64, -1).astype(np.float32) for k in (0, 1))
        hits, seen = state[2 * size:].reshape(2, *mixer.refined.shape)
        mixer.refined = (hits / seen).astype(np.float32)
    return counts, mixer


def _tallies(both: DataFrame) -> np.ndarray:
    """Uses by code prefix (64) and, of each, by class and code and by slot; the sizes are fixed."""
    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, x in zip(batch.column("bucket").to_pylist(), batch.column("tally").to_pylist()):
                sums[bucket] = sums.get(bucket, 0) + wordcode.expand(x, TALLY)[0].astype(np.int64)
        for bucket, mine in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([wordcode.squeeze_long(mine)])], ["bucket", "tally"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(wordcode.expand_long(x, TALLY) for x in table.column("tally").to_pylist())
        return pa.table({"bucket": table.column("bucket")[:1], "tally": pa.array([zstandard.compress(total.tobytes(), 1)])})

    out = np.zeros((1 << wordcode.TOP, TALLY), np.int64)
    rows = both.filter("part = 'tally'").select("bucket", "tally").coalesce(TALLIERS).mapInArrow(some, "bucket int, tally binary").groupBy("bucket").applyInArrow(add, "bucket int, tally binary")
    for row in rows.toLocalIterator():
        out[row["bucket"]] = np.frombuffer(zstandard.decompress(row["tally"]), np.int64)
    return out


def _price_pairs(both: DataFrame, tallies: np.ndarray, spread: int) -> DataFrame:
    """What each block's pairs cost, bucket by bucket: ``block, bucket, prices`` in the order of the block's pairs."""
    size = wordcode.CLASSES * wordcode.LEAVES
    context = both.sparkSession.sparkContext
    # Broadcasts lie on the executors' disks, and a bucket needs one of 64 parts.
    first = context.broadcast([zstandard.compress(x.tobytes(), 1) for x in wordcode.first_bits(tallies[:, size:].T).T])
    classes = context.broadcast([zstandard.compress(x.astype(np.float32).tobytes(), 1) for x in tallies[:, :size]])

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        lists = [wordcode.unpack(x) for x in table.column("pairs").to_pylist()]
        keys, place = wordcode.distinct(np.concatenate([k for k, _ in lists]))
        uses = np.bincount(place, weights=np.concatenate([u for _, u in lists])).astype(np.int64)
        prefix = bucket >> spread
        table_of = lambda held: np.frombuffer(zstandard.decompress(held.value[prefix]), np.float32)
        cost = wordcode.code_cost(keys, uses, table_of(classes).reshape(wordcode.CLASSES, -1), table_of(first))
        steps = np.ceil(cost * -STEPS)  # rounded away from certainty, so that probabilities add up to one at most
        prices = np.stack([steps, *wordcode.rivals(keys, uses)]).astype(np.uint32)
        cuts = np.cumsum([0, *(len(k) for k, _ in lists)])
        out = [wordcode.squeeze(*prices[:, place[i:j]]) for i, j in zip(cuts[:-1], cuts[1:])]
        sizes = np.diff(cuts)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "size": pa.array(sizes), "prices": pa.array(out, pa.binary())})

    return both.filter("part = 'pairs'").select("block", "bucket", "pairs").groupBy("bucket").applyInArrow(run, "block long, bucket int, size long, prices binary")


def score(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", scratch: list[str] | None = None) -> DataFrame:
    """Score every whole text; learn from the rows whose ``held_out`` is false.

    Gives ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` per row. Base and model
    scores are log10 probabilities of the text's words and its end. A null text is an empty one: the end alone. A row
    whose ``held_out`` is null is scored but not learned from. Repeated rows each count and each give a row; other columns
    are left behind. Nothing to learn from leaves spellings of even bits; no rows give none. The same rows give the same
    scores, however they are partitioned.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"), held_out.alias("held_out"))
    rows = rows.withColumn("learned", F.coalesce(~F.col("held_out"), F.lit(False)))
    kind = rows.schema["doc_id"].dataType
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = max(0, math.ceil(math.log2(max(size, 1) / (BUCKET_BYTES << wordcode.TOP))))
    made: list[str] = []
    both = settled(_blocks(rows, kind, spread), made, by=("part",))
    counted = settled(_count_words(both), made)
    tallies = _tallies(both)
    for part in ("words", "tally"):  # nothing reads these again
        delete(rows.sparkSession, f"{made[0]}/part={part}")
    if scratch is not None:
        scratch += made
    vocabulary = counted.filter("word IS NOT NULL").select("word", "uses")
    total, distinct, once = vocabulary.agg(F.coalesce(F.sum("uses"), F.lit(0)), F.count("uses"), F.count_if(F.col("uses") == 1)).first()
    counts, mixer = _spelling(vocabulary)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(_table(counts), mixer)
        for batch in batches:
            lists = [wordcode.unpack_words(x)[0] for x in batch.column("unknown").to_pylist()]
            coded = pa.concat_arrays([pa.array([], pa.large_binary()), *lists]).dictionary_encode()
            cost = model.log10(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            cuts = np.cumsum([0, *map(len, lists)])
            costs = pa.array([cost[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("block", "bucket", "size", "totals")), costs], ["of_block", "bucket", "size", "totals", "costs"])

    priced = counted.filter("totals IS NOT NULL").select("block", "bucket", "size", "totals", "unknown").mapInArrow(
        judge, "of_block long, bucket int, size long, totals binary, costs binary")
    pairs = _price_pairs(both, tallies, spread).withColumnRenamed("block", "of_block")
    seconds = both.filter("part = 'seconds'").select(F.col("block").alias("of_block"), "seconds")
    parts = priced.unionByName(pairs, allowMissingColumns=True).unionByName(seconds, allowMissingColumns=True)
    documents = both.filter("part = 'data'").select("block", "doc_id", "held_out", "tokens", "bytes", "data")
    floor = math.log10(total + 0.5 * (distinct + 1))
    unknown = (once + 0.5) / (total + 1)
    by_code = tallies[:, :wordcode.CLASSES * wordcode.LEAVES].reshape(-1, wordcode.CLASSES, wordcode.LEAVES).sum(axis=1).ravel()

    def total_up(left: pa.Table, right: pa.Table) -> pa.Table:
        of = lambda column: right.filter(pa.compute.is_valid(right.column(column))).sort_by("bucket").to_pylist()
        words, lists = of("totals"), of("prices")
        uses = np.concatenate([wordcode.expand_long(x["totals"], x["size"]) for x in words])
        cost = np.zeros(len(uses))
        cost[uses == 0] = np.frombuffer(b"".join(x["costs"] for x in words))
        steps, *rivals = (np.concatenate(x).astype(np.int64) for x in zip(*(wordcode.expand(x["prices"], *[x["size"]] * 4) for x in lists)))
        bits, (share, rest) = steps / -STEPS, wordcode.shares(*rivals)
        seconds, codes = wordcode.expand(right.column("seconds").drop_null()[0].as_py(), len(bits), len(uses))
        second, code = np.cumsum(seconds.view(np.int32)), np.cumsum(codes)
        among = (uses / np.maximum(by_code[code], 1))[second]
        inside = np.log10(np.maximum(share + rest * among, 1e-300)) + bits + math.log10(1 - unknown)
        each = np.where(uses[second] > 0, inside, cost[second] + math.log10(unknown))
        base, seen = (np.log10(uses + 0.5) - floor)[second], uses[second] > 0
        known, based, model = [], [], []
        for data in left.column("data").to_pylist():
            size = (zstandard.frame_content_size(data) - 2) // 8
            different, times = wordcode.expand(data, size, size)
            at = np.cumsum(different)
            known.append(int(times[seen[at]].sum()))
            based.append(float(base[at] @ times))
            model.append(float(each[at] @ times))
        size = left.column("bytes").to_numpy()
        return pa.table({"doc_id": left.column("doc_id"), "held_out": left.column("held_out"), "n_tokens": left.column("tokens"), "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array(np.full(left.num_rows, total, np.int64)), "base_score": pa.array(based, pa.float64()),
                         "score": pa.array(model, pa.float64()), "bits_per_byte": pa.array(-np.array(model, np.float64) * math.log2(10) / size)})

    result = T.StructType([T.StructField("doc_id", kind), *T.StructType.fromDDL(
        "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double").fields])
    return documents.groupBy("block").cogroup(parts.groupBy("of_block")).applyInArrow(total_up, result)
