"""Byte-pair encoding with word ends, and its decoding.

A word's symbols form a doubly linked list. A priority queue holds the rank of every mergeable neighbour pair;
the best pair is joined, its new neighbours are queued, and entries whose pair no longer exists are skipped when
they come up. A word of n bytes so takes O(n log n), however long it is.

The vocabulary is read from a tokenizer file by the driver and sent to the tasks: its size is that of the file.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from snapflow.llm.common import id_and_text, small_batches

END = 1 << 19  # stands behind the last symbol; no merge has it
WORD_CACHE = 150_000  # words kept per generation and worker; two generations live at a time
_SPACES = regex.compile(r"\p{White_Space}+")
_ODD_SPACE = regex.compile("[\x1c-\x1f]")  # str.split() takes these for spaces, Unicode does not
_CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def _byte_letters() -> list[str]:
    """Printable stand-ins of the 256 byte values: Latin-1 printables are themselves, the rest follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBPE:
    """One tokenizer file: NFC, white space folded, lower case; words by script class; merges within words."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.names = {i: s for s, i in vocab.items()}
        letters = _byte_letters()
        self.inner = [vocab[x] for x in letters].__getitem__
        self.final = [vocab[x + suffix] for x in letters]
        self.ranks: dict[int, int] = {}  # pair of symbol ids -> rank
        self.made: list[int] = []  # rank -> merged symbol
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], rank)
            self.made.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.names |= {i: s for s, i in self.special.items()}
        self.by_id = pa.array([self.names.get(i) for i in range(max(self.names) + 1)], pa.string())
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.marks = {s[:2] for s in self.special}
        self.pieces = regex.compile(_CONTRACTIONS)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Apply all merges to one word's symbols, lowest rank first, leftmost first among equals."""
        n, get, made = len(ids), self.ranks.get, self.made
        ids.append(END)
        live = [get(a << 20 | b) for a, b in zip(ids, ids[1:])]  # rank of the pair that begins here now
        heap = [rank << 32 | i for i, rank in enumerate(live) if rank is not None]
        if not heap:
            ids.pop()
            return ids
        heapify(heap)
        live.append(None)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        while heap:
            entry = heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if live[i] != rank:  # stale: a part of this pair has been merged since
                continue
            j = after[i]
            ids[i] = new = made[rank]
            ids[j] = -1
            live[j] = None
            k = after[i] = after[j]
            before[k] = i
            live[i] = rank = get(new << 20 | ids[k])
            if rank is not None:
                heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                live[h] = rank = get(ids[h] << 20 | new)
                if rank is not None:
                    heappush(heap, rank << 32 | h)
        ids.pop()
        return [x for x in ids if x >= 0]

    def piece(self, piece: str) -> bytes:
        """Packed 32-bit ids of a run of one script class."""
        raw = piece.encode()
        ids = [*map(self.inner, raw)]
        ids[-1] = self.final[raw[-1]]
        return array("i", self.merge(ids) if len(ids) > 1 else ids).tobytes()

    def word(self, chunk: str) -> bytes:
        """Packed ids of a run without white space. Its pieces are kept too: a word with a comma is mostly known without."""
        if chunk.isalpha():
            return self.piece(chunk)
        pieces = self.pieces.findall(chunk)
        return b"".join(map(self.kept, pieces)) if len(pieces) > 1 else self.piece(chunk)

    def kept(self, chunk: str) -> bytes:
        """What ``word`` gives, from the cache or for it."""
        hit = self.new.get(chunk)
        if hit is None:
            hit = self.old.get(chunk) or self.word(chunk)
            if len(self.new) >= WORD_CACHE:
                self.old, self.new = self.new, {}
            if len(chunk) <= 64:
                self.new[chunk] = hit
        return hit

    def _part(self, text: str) -> list[bytes]:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")  # lower case letter by letter, without the word-final form
        text, get, kept = text.lower(), self.new.get, self.kept
        return [get(chunk) or kept(chunk) for chunk in (filter(None, _SPACES.split(text)) if _ODD_SPACE.search(text) else text.split())]

    def ids(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        if not self.special_pattern or not any(m in text for m in self.marks):
            return b"".join(self._part(text))
        out: list[bytes] = []
        for part in self.special_pattern.split(text):
            if part in self.special:
                out.append(array("i", [self.special[part]]).tobytes())
            elif part:
                out += self._part(part)
        return b"".join(out)

    def encode(self, text: str) -> tuple[bytes, str]:
        """Packed ids and decoded text of a whole text."""
        ids = self.ids(text)
        return ids, self.decode(memoryview(ids).cast("i"))

    def decode(self, ids) -> str:
        """Vocabulary strings of the ids, one space between them; ids outside the vocabulary are passed over."""
        return " ".join([self.names[i] for i in ids if i in self.names])


_LOADED: dict[str, WordBPE] = {}  # per worker: the word cache lives as long as the worker


def _loaded(spec: str) -> WordBPE:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBPE(spec)
    return _LOADED[key]


def _spec(df: DataFrame, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _columns(ids: list[bytes], names: pa.Array, keys: pa.Array) -> pa.RecordBatch:
    """Ids and decoded texts of a batch; ``names`` has the vocabulary strings by id."""
    counts = np.fromiter((len(x) // 4 for x in ids), np.int32, len(ids))
    offsets, values = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32))
    said = pa.compute.binary_join(pa.ListArray.from_arrays(offsets, names.take(values)), " ")
    return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, values), said], ["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of every whole text and the text decoded from them: ``doc_id, ids array<int>, decoded``.

    Special tokens written in a text become their ids; none is added. A null or empty text has no ids and decodes
    to the empty text. Every row gives one row, repeated and null ids included; other columns are left behind.
    """
    rows = id_and_text(docs, id_column, text_column)
    spec = _spec(docs, tokenizer)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in small_batches(batches, most=4 << 20):
            yield _columns([bpe.ids(t) for t in batch.column("text").to_pylist()], bpe.by_id, batch.column("doc_id"))

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of an ``array<int>`` column: vocabulary strings joined by a space. A null array gives null."""
    spec = _spec(encoded, tokenizer)
    schema = T.StructType([*(f for f in encoded.schema.fields if f.name != into), T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec.value)
        for batch in batches:
            said = [None if x is None else bpe.decode(x) for x in batch.column(ids_column).to_pylist()]
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(said, pa.string())], [*names, into])

    return encoded.mapInArrow(run, schema)
