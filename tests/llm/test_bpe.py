import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapflow.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " \n\t", "it's we'LL 'seven ''s", "<|endoftext|>foo<|startoftext|><|endoftext|>x <|EndOfText|>", "ΑΣ ΣΑΣ İ \x1cq\x1d \x85a\xa0b",
         "日本語 123 ٣٤ ½ 👍🏽", "été Å", "a" * 3000, "ab" * 2000 + " x", "Hello hello HELLO", "ǅ ß ẞ ​ ﻿"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.WordBPE(open(PATH, encoding="utf-8").read())


def unpacked(data):
    out = array.array("i")
    out.frombytes(data)
    return list(out)


def check(own, library, text):
    ids, said = own.encode(text)
    expected = library.encode(text, add_special_tokens=False).ids
    assert unpacked(ids) == expected
    assert said == own.decode(expected) == library.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_odd_texts(own, library, text):
    check(own, library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn", "Co"]), max_size=40))
def test_any_text(own, library, text):
    check(own, library, text)


def test_cache_turns_over(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_CACHE", 3)
    fresh = bpe.WordBPE(open(PATH, encoding="utf-8").read())
    check(fresh, library, "one two three four five one two six one seven three")
    assert len(fresh.new) <= 3


def test_pieces_of_a_word_are_merged_once(library):
    fresh = bpe.WordBPE(open(PATH, encoding="utf-8").read())
    merged, merge = [], fresh.merge
    fresh.merge = lambda ids: merged.append(len(ids)) or merge(ids)
    text = "mention mention, mention. (mention) mention's 'mention' mention-mention '''s's ... ,,, 12,5"
    check(fresh, library, text)
    assert merged.count(len("mention")) == 1
    check(fresh, library, text)  # all words are known by now


def test_odd_batches(spark, library):
    texts = ["", None, " \n", "Some, words.", "<|endoftext|>", "\x1c ,\x85'S ''' ½a", *TEXTS]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.encode(docs, PATH).collect()}
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got == {i: (ids, library.decode(ids, skip_special_tokens=False)) for i, ids in enumerate(wanted)}


def test_rows(spark, library):
    rows = [(1, "Some words", 5, "x"), (1, "Some words", 5, "x"), (None, None, 6, "y"), (2, "", 7, None), (3, "<|endoftext|>", 8, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = sorted((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in bpe.encode(docs, PATH).collect())
    expected = [(r[0] or 0, library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    assert got == sorted((d, i, library.decode(i, skip_special_tokens=False)) for d, i in expected)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    named = docs.select(docs.doc_id.cast("string").alias("name"), docs.text.alias("body"))
    assert bpe.encode(named, PATH, "name", "body").filter("doc_id = '3'").first()["ids"] == [49407]


def test_decode_frame(spark):
    coded = spark.createDataFrame([([49406, 320, -5], "old"), ([], "old"), (None, "old")], "ids array<int>, decoded string")
    assert [r["decoded"] for r in bpe.decode(coded, PATH).collect()] == ["<|startoftext|> a</w>", "", None]
