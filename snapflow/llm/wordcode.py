"""Words as bits in the context of the word before: the part of the mixing model that reaches across the text.

A word's code is 16 bits of its hash. Each code bit is predicted from three contexts (the bits so far alone, with the
class of the word before, and with that word itself), mixed by gated weights and refined like the bits of a spelling.
The words that share a code are told apart by their counts, first those seen behind the same word.

The counts of pairs grow with the corpus, so they stay in Spark, dealt into buckets by the first six code bits and the
hash of the word before. A word that stands before a third of all others is thus spread over 64 buckets and more. The
first six bits need counts that cross buckets: those are kept by 65,536 hashed slots of the word before, which is also
what the class belongs to, so their cost is one table for all buckets. Every bucket trains its own weights, online and
over all its pairs, for the ten bits that follow; a bucket is fixed by the context, so probabilities still add up to one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

TOP, LOW = 6, 10  # code bits that deal words into buckets, and those predicted inside a bucket
LEAVES, SLOTS, CLASSES = 1 << LOW, 1 << 16, 64
BATCH = 4_096
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # of XXH64
_PRESS, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _held(words: list[bytes] | pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where words begin and end, and the bytes they lie in."""
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.large_binary())
    _, ends, data = words.buffers()
    return np.frombuffer(ends, np.int64, len(words) + 1, 8 * words.offset) if len(words) else np.zeros(1, np.int64), memoryview(data or b"")


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def hashes(words: list[bytes] | pa.Array, seed: int = 42) -> np.ndarray:
    """XXH64 of words, all of a length at once; those of 32 bytes and more one by one."""
    ends, data = _held(words)
    lengths, raw = np.diff(ends), np.frombuffer(data, np.uint8)
    out = np.empty(len(lengths), np.uint64)
    for n in np.flatnonzero(np.bincount(np.minimum(lengths, 32), minlength=33)[:32]):
        mine = np.flatnonzero(lengths == n)
        spelt = raw[ends[mine][:, None] + np.arange(n)]
        h = np.full(len(mine), (seed + int(_P5) + int(n)) & (1 << 64) - 1, np.uint64)
        for at in range(0, n - 7, 8):
            lane = np.ascontiguousarray(spelt[:, at:at + 8]).view(np.uint64).ravel()
            h = _turn(h ^ _turn(lane * _P2, 31) * _P1, 27) * _P1 + _P4
        at = n // 8 * 8
        if n - at >= 4:
            h = _turn(h ^ np.ascontiguousarray(spelt[:, at:at + 4]).view(np.uint32).ravel() * _P1, 23) * _P2 + _P3
            at += 4
        for k in range(at, n):
            h = _turn(h ^ spelt[:, k] * _P5, 11) * _P1
        h = (h ^ h >> np.uint64(33)) * _P2
        h = (h ^ h >> np.uint64(29)) * _P3
        out[mine] = h ^ h >> np.uint64(32)
    for i in np.flatnonzero(lengths >= 32):
        out[i] = xxhash.xxh64_intdigest(data[ends[i]:ends[i + 1]], seed)
    return out


def describe(words: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code (16 bits), the rest of its name (22 bits), and its name as a previous word (class in the top 6 of 32 bits)."""
    ends, data = _held(words)
    named, raw = hashes(words), np.frombuffer(data, np.uint8)
    last = np.zeros((2, len(named)), np.uint32)
    for k in (0, 1):
        there = np.diff(ends) > k
        last[k, there] = raw[ends[1:][there] - 1 - k]
    group = ((last[1] << np.uint32(8) | last[0]) * np.uint32(0x9E3779B1) >> np.uint32(26)).astype(np.uint64)
    return named >> np.uint64(48), named >> np.uint64(26) & np.uint64((1 << 22) - 1), group << np.uint64(26) | named & np.uint64((1 << 26) - 1)


def key(code: np.ndarray, rest: np.ndarray, before: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of pairs, and the name of the second word in it; each of the 64 code prefixes has ``2 ** spread`` buckets."""
    bucket = (code >> np.uint64(LOW)) << np.uint64(spread) | before & np.uint64((1 << spread) - 1)
    return bucket.astype(np.int32), ((code & np.uint64(LEAVES - 1)) << np.uint64(22) | rest).astype(np.uint32)


def _planes(stream: np.ndarray) -> bytes:
    """Four bytes of each number, byte by byte; how many of them are not all zero comes first."""
    stream = np.ascontiguousarray(stream, np.uint32)
    n = (int(stream.max(initial=0)).bit_length() + 7) // 8
    planes = [stream.astype(np.uint8)] if n == 1 else [np.ascontiguousarray(stream.view(np.uint8)[k::4]) for k in range(n)]
    return b"".join([bytes([n]), *planes, bytes((4 - n) * len(stream))])


def squeeze(*streams: np.ndarray, tail: bytes | memoryview = b"") -> bytes:
    """Numbers below 2**32, byte by byte, then ``tail``, compressed."""
    return _PRESS.compress(b"".join([*map(_planes, streams), tail]))


def expand(data: bytes, *sizes: int) -> list[np.ndarray]:
    return _split(_OPEN.decompress(data), sizes)[0]


def _split(plain: bytes, sizes: tuple[int, ...]) -> tuple[list[np.ndarray], int]:
    """Numbers, and where the tail begins."""
    out, at = [], 0
    for size in sizes:
        n, at = plain[at], at + 1
        if n == 1:
            out.append(np.frombuffer(plain, np.uint8, size, at).astype(np.uint32))
        else:
            numbers = np.zeros(4 * size, np.uint8)
            for k in range(n):
                numbers[k::4] = np.frombuffer(plain, np.uint8, size, at + k * size)
            out.append(numbers.view(np.uint32))
        at += 4 * size
    return out, at


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and the place of every value among them."""
    order = np.argsort(values)
    values = values[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], place


def squeeze_long(values: np.ndarray) -> bytes:
    """Numbers below 2**63."""
    return squeeze(values & 0xFFFFFFFF, values >> 32)


def expand_long(data: bytes, size: int) -> np.ndarray:
    low, high = expand(data, size, size)
    return high.astype(np.int64) << 32 | low


def pack_words(words: list[bytes] | pa.Array, uses: np.ndarray) -> bytes:
    """Words and a number below 2**32 for each."""
    ends, data = _held(words)
    return (len(ends) - 1).to_bytes(8, "little") + squeeze(np.diff(ends), uses, tail=data[ends[0]:ends[-1]])


def unpack_words(data: bytes) -> tuple[pa.Array, np.ndarray]:
    n, plain = int.from_bytes(data[:8], "little"), _OPEN.decompress(data[8:])
    (lengths, uses), tail = _split(plain, (n, n))
    ends = np.cumsum(np.concatenate([[0], lengths]), dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(plain).slice(tail)]), uses.astype(np.int64)


Ranks = tuple[np.ndarray, np.ndarray, np.ndarray]


def ranks(before: np.ndarray) -> Ranks:
    """Words before, how often each occurs, and for every pair the rank of its word before in frequency."""
    before = before.astype(np.uint32)
    order = np.argsort(before)
    ordered = before[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(before)])
    times = np.diff(np.append(first, len(before)))
    rank, out = np.empty(len(first), np.int32), np.empty(len(before), np.int32)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(first))
    out[order] = np.repeat(rank, times)
    return ordered[first], times, out


def arrange(words: np.ndarray, before: np.ndarray, ranked: Ranks | None = None) -> np.ndarray:
    """The order of pairs sorted by word in which they pack best: frequent words before first."""
    number = np.cumsum(np.concatenate([[0], words[1:] != words[:-1]]))
    return np.argsort(number * len(words) + (ranked or ranks(before))[2])


def pack(words: np.ndarray, before: np.ndarray, uses: np.ndarray, ranked: Ranks | None = None) -> bytes:
    """Pairs sorted by word: each word once with the number of its pairs, words before by the steps of their ranks."""
    names, times, rank = ranked or ranks(before)
    starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    steps = np.diff(rank, prepend=np.int32(0))
    steps[starts] = rank[starts]
    sizes = np.array([len(names), len(starts), len(words)], np.int64)
    return sizes.tobytes() + squeeze(np.diff(names, prepend=np.uint32(0)), times, np.diff(words[starts], prepend=np.uint32(0)),
                                     np.diff(np.append(starts, len(words))), steps.view(np.uint32), uses)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys (word before, then word) and uses, in the order they were packed."""
    n, kinds, pairs = np.frombuffer(data, np.int64, 3)
    names, times, words, counts, steps, uses = expand(data[24:], n, n, kinds, kinds, pairs, pairs)
    names = np.cumsum(names, dtype=np.uint64)[np.argsort(-times.astype(np.int64), kind="stable")]
    sums, starts = np.cumsum(steps.view(np.int32), dtype=np.int64), np.cumsum(counts, dtype=np.int64) - counts
    rank = sums - np.repeat(sums[starts] - steps[starts], counts)
    return names[rank] << np.uint64(32) | np.repeat(np.cumsum(words, dtype=np.uint64), counts), uses.astype(np.int64)


def tally(keys: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """Of one code prefix: uses by class and code (64 x 1024), then uses by slot of the word before."""
    code = (keys >> np.uint64(22)).astype(np.int64) & LEAVES - 1
    by_class = np.bincount((keys >> np.uint64(58)).astype(np.int64) * LEAVES + code, weights=uses, minlength=CLASSES * LEAVES)
    return np.concatenate([by_class, np.bincount((keys >> np.uint64(48)).astype(np.int64), weights=uses, minlength=SLOTS)])


def stretch(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.3) / (total - ones + 0.3)).astype(np.float32)


def confidence(total: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then by powers of four up to 7."""
    return np.minimum(np.ceil(np.log2(total + 1) / 2), 7).astype(np.int8)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Mixer:
    """Two gated sets of weights, and a map that refines their answer by its own record."""

    by_confidence: np.ndarray  # confidences of two contexts -> a weight per context
    by_place: np.ndarray  # place of the bit -> a weight per context
    refined: np.ndarray  # node of the bit, level of the mixed answer -> probability

    @staticmethod
    def fresh(contexts: int, weight: float = 0.35) -> Mixer:
        levels = squash(np.linspace(-8, 8, 33))
        gated = [np.full((64, contexts), weight, np.float32) for _ in range(2)]
        return Mixer(*gated, np.tile(levels, (256, 1)).astype(np.float32))

    def mix(self, inputs: np.ndarray, gate: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.einsum("ij,ij->i", weights.take(where, axis=0), inputs) for weights, where in ((self.by_confidence, gate), (self.by_place, place)))

    def refine(self, x: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a one, and the map's level that was used."""
        level = np.clip(np.rint((x + 8) * 2), 0, 32).astype(np.int32)
        return 0.6 * squash(x) + 0.4 * self.refined[node, level], level


@dataclass
class Learner:
    """Online training: a block is predicted first, then steps the weights (scaled by their own past steps) and the map."""

    mixer: Mixer
    past: list[np.ndarray] = field(init=False)
    hits: np.ndarray = field(init=False)
    seen: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.past = [np.full_like(self.mixer.by_confidence, 1e-9), np.full_like(self.mixer.by_place, 1e-9)]
        self.hits, self.seen = self.mixer.refined * 4.0, np.full(self.mixer.refined.shape, 4.0)

    def step(self, inputs: np.ndarray, gate: np.ndarray, place: np.ndarray, node: np.ndarray, own: np.ndarray, weight: np.ndarray, rate: float) -> None:
        mixer = self.mixer
        answers = mixer.mix(inputs, gate, place)
        _, level = mixer.refine((answers[0] + answers[1]) / 2, node)
        for table, sums, where, x in ((mixer.by_confidence, self.past[0], gate, answers[0]), (mixer.by_place, self.past[1], place, answers[1])):
            error = (own - squash(x)) * weight
            move = np.stack([np.bincount(where, weights=error * inputs[:, k], minlength=len(table)) for k in range(inputs.shape[1])], axis=1)
            move /= weight.sum()
            sums += move ** 2
            table += (rate * move / np.sqrt(sums)).astype(np.float32)
        cell = node * 33 + level
        self.hits += np.bincount(cell, weights=own * weight, minlength=self.hits.size).reshape(self.hits.shape)
        self.seen += np.bincount(cell, weights=weight, minlength=self.seen.size).reshape(self.seen.shape)
        mixer.refined = (self.hits / self.seen).astype(np.float32)


@dataclass
class Level:
    """One code bit under every context that occurs: uses with a one and with a zero, by word before, class and alone."""

    depth: int
    ones: np.ndarray  # contexts x (word before, class, alone)
    zeros: np.ndarray
    cell: np.ndarray  # class and bits so far: contexts of one cell differ in the word before only

    def inputs(self, where: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and gates; ``own`` takes one occurrence of that value out of each context first."""
        ones, zeros = self.ones.take(where, axis=0), self.zeros.take(where, axis=0)
        if own is not None:
            ones, zeros = np.maximum(ones - own[:, None], 0), np.maximum(zeros - ~own[:, None], 0)
        total = ones + zeros
        sure = confidence(total[:, :2]).astype(np.int32)
        return stretch(ones, total), sure[:, 0] * 8 + sure[:, 1]

    def kinds(self, few: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """One context of each kind, and the kind of every context. Contexts of a cell with the same, few uses behind
        the word before have the same inputs."""
        ones, zeros = self.ones[:, 0], self.zeros[:, 0]
        name = self.cell * few ** 2 + (ones * few + zeros).astype(np.int64)
        many = np.flatnonzero((ones >= few) | (zeros >= few))
        top = (int(self.cell.max(initial=0)) + 1) * few ** 2
        name[many] = np.arange(top, top + len(many))
        one = np.full(top + len(many), -1, np.int32)
        one[name] = np.arange(len(name))
        found = np.flatnonzero(one >= 0)
        number = np.empty(len(one), np.int32)
        number[found] = np.arange(len(found))
        return one[found], number[name]

    def cases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts, values and weights that stand for every use. Words before that occur once look alike without
        their own occurrence, so one of them stands for all of its cell and value."""
        ones, zeros = self.ones[:, 0], self.zeros[:, 0]
        once = ones + zeros == 1
        alike = np.flatnonzero(once)
        name = self.cell[alike] * 2 + (ones[alike] > 0)
        times, one = np.bincount(name), np.empty(name.max(initial=0) + 1, np.int64)
        one[name] = alike
        found = np.flatnonzero(times)
        where, own, weight = [one[found]], [found % 2 == 1], [times[found]]
        for value, counts in ((True, ones), (False, zeros)):
            more = np.flatnonzero((counts > 0) & ~once)
            where, own, weight = [*where, more], [*own, np.full(len(more), value)], [*weight, counts[more]]
        return np.concatenate(where), np.concatenate(own), np.concatenate(weight).astype(np.float64)


def train(levels: list[Level], rate: float = 0.08, seed: int = 7) -> Mixer:
    """Weights and map over every use in the levels, each use predicted without itself."""
    learner, random = Learner(Mixer.fresh(3)), np.random.default_rng(seed)
    for level in levels:
        where, own, weight = level.cases()
        order = random.permutation(len(where))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            inputs, gate = level.inputs(where[part], own[part])
            depth = np.full(len(part), level.depth)
            learner.step(inputs, gate, depth, depth, own[part], weight[part], rate)
    return learner.mixer


def log_odds(mixer: Mixer, level: Level) -> np.ndarray:
    """log10 probability of a zero and of a one in every context of a level."""
    some, kind = level.kinds()
    out = np.empty((len(some), 2))
    for at in range(0, len(out), 1 << 14):
        inputs, gate = level.inputs(some[at:at + (1 << 14)])
        depth = np.full(len(inputs), level.depth)
        one, two = mixer.mix(inputs, gate, depth)
        p = np.clip(mixer.refine((one + two) / 2, depth)[0], 1e-6, 1 - 1e-6)
        out[at:at + (1 << 14)] = np.log10(np.stack([1 - p, p], axis=1))
    return out.take(kind, axis=0)


def first_bits(by_slot: np.ndarray) -> np.ndarray:
    """log10 probability of each code prefix behind each slot, from uses by slot and prefix (65,536 x 64)."""
    def level(depth: int) -> Level:
        cells = by_slot.reshape(SLOTS, 1 << depth, 2, -1).sum(axis=3)
        classes = cells.reshape(CLASSES, -1, 1 << depth, 2).sum(axis=1)
        wide = [cells, np.repeat(classes, SLOTS // CLASSES, axis=0), np.broadcast_to(classes.sum(axis=0), cells.shape)]
        cell = np.arange(SLOTS)[:, None] // (SLOTS // CLASSES) << depth | np.arange(1 << depth)
        return Level(depth, *(np.stack([w[:, :, bit].ravel() for w in wide], axis=1).astype(np.float32) for bit in (1, 0)), cell.ravel())

    mixer = train([level(d) for d in range(TOP)])
    out = np.zeros((SLOTS, 1 << TOP), np.float32)
    for depth in range(TOP):
        costs = log_odds(mixer, level(depth)).astype(np.float32).reshape(SLOTS, -1)
        out += np.repeat(costs, (1 << TOP) // costs.shape[1], axis=1)
    return out


def levels(keys: np.ndarray, uses: np.ndarray, by_class: np.ndarray) -> list[tuple[Level, np.ndarray, np.ndarray]]:
    """The ten bits inside a bucket: contexts, the context of every pair, and its bit there. Keys are sorted."""
    code, group = (keys >> np.uint64(22)).astype(np.int32) & LEAVES - 1, (keys >> np.uint64(58)).astype(np.int64)
    apart, so_far = keys[1:] ^ keys[:-1], np.concatenate([[0], np.cumsum(uses)])
    out = []
    for depth in range(LOW):
        new = np.concatenate([[True], apart >= np.uint64(1 << 32 - depth)])
        first = np.flatnonzero(new)
        where = np.cumsum(new, dtype=np.int32) - 1
        bit = code >> LOW - 1 - depth & 1
        cells = by_class.reshape(CLASSES, 1 << depth, 2, -1).sum(axis=3)
        alone, cell = np.broadcast_to(cells.sum(axis=0), cells.shape), group[first] << depth | code[first] >> LOW - depth
        ends, with_one = np.append(first, len(keys)), np.concatenate([[0], np.cumsum(uses * bit)])
        ones, counts = np.diff(with_one[ends]), []
        for value, mine in ((1, ones), (0, np.diff(so_far[ends]) - ones)):
            table = np.empty((len(first), 3), np.float32)
            table[:, 0] = mine
            table[:, 1:] = np.stack([cells[:, :, value].ravel(), alone[:, :, value].ravel()], axis=1).astype(np.float32).take(cell, axis=0)
            counts.append(table)
        out.append((Level(TOP + depth, *counts, cell), where, bit))
    return out


def code_cost(keys: np.ndarray, uses: np.ndarray, by_class: np.ndarray, top: np.ndarray) -> np.ndarray:
    """For the sorted pairs of a bucket: log10 probability of the code.

    ``by_class`` (64 x 1024) are uses by class and code, ``top`` the log10 probability of this bucket's prefix by slot.
    """
    cost = top[(keys >> np.uint64(48)).astype(np.int64)].astype(np.float64)
    bits = levels(keys, uses, by_class)
    mixer = train([level for level, _, _ in bits])
    for level, where, bit in bits:
        cost += log_odds(mixer, level).ravel().take(where * 2 + bit)
    return cost


def rivals(keys: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """For the sorted pairs of a bucket: uses, those of other words with that code behind that word, and their kinds; below 2**32."""
    leaf = keys >> np.uint64(22)
    first = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    total, kinds = (np.repeat(np.add.reduceat(x, first), sizes) for x in (uses, (uses > 0).astype(np.int64)))
    uses, total = (x >> max(0, int(total.max()).bit_length() - 32) for x in (uses, total))
    return np.stack([uses, total - uses, kinds - (uses > 0)])


def shares(uses: np.ndarray, other: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How words of one code are told apart, from ``rivals``: the word's probability inside its code is
    ``share + rest * (its probability there whatever the word before)``."""
    total, kinds = uses + other, kinds + (uses > 0)
    base = np.maximum(total + kinds, 1)
    return uses / base, np.where(total > 0, kinds / base, 1.0)


def price(keys: np.ndarray, uses: np.ndarray, by_class: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the sorted pairs of a bucket: log10 probability of the code, share and rest."""
    return code_cost(keys, uses, by_class, top), *shares(*rivals(keys, uses))
