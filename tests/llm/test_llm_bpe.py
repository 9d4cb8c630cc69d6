"""BPE against the public library: all documents, random strings, long words; round trips and odd tables."""

import hashlib
import random
import unicodedata

import pytest
from brute import CLASHING, odd_documents, rows_of, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Reference

from tallyward.llm import bpe
from tallyward.llm.queries import vocabulary

OWN, WANTED = None, None


def both():
    global OWN, WANTED
    if OWN is None:
        with open(vocabulary(), "rb") as file:
            OWN = bpe.Tokenizer(file.read(), remembered=2_000)
        WANTED = Reference.from_file(vocabulary())
        WANTED.no_truncation()
        WANTED.no_padding()
    return OWN, WANTED


def assert_same(text):
    own, wanted = both()
    ids = wanted.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == wanted.decode(ids, skip_special_tokens=False)


def test_all_documents(spark):
    own, wanted = both()
    texts = [t or "" for (t,) in rows_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "text")]
    flat, counts = own.encode_all(texts)
    at = 0
    for n, found in zip(counts.tolist(), wanted.encode_batch(texts, add_special_tokens=False)):
        assert flat[at : at + n].tolist() == found.ids
        at += n


def test_all_code_points():
    """Each character alone, between letters and in front of a mark, and pairs of every mark with others, as the library splits and encodes them."""
    own, wanted = both()
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    marks = [c for c in chars if unicodedata.combining(c) or unicodedata.category(c)[0] == "M"]
    texts = [c for c in chars] + [f"e{c}a {c}1{c}\u0301" for c in chars] + [f"e{c}{m}o{m}{c}" for c in marks for m in "\u0334\u0316\u0301\u3099\u05b0\u0f71\U00011930"]
    texts += [unicodedata.normalize("NFD", c) + m for c in chars if unicodedata.decomposition(c) for m in ("", "\u0323\u0301")]
    for at in range(0, len(texts), 200_000):
        part = texts[at : at + 200_000]
        flat, counts = own.encode_all(part)
        place = 0
        for text, n, found in zip(part, counts.tolist(), wanted.encode_batch(part, add_special_tokens=False)):
            assert flat[place : place + n].tolist() == found.ids, ascii(text)
            place += n


PIECES = ["a", "b", "'s", "'", "'ll", " ", "\n", "\t", "É", "e\u0301", "Σ", "ς", "ß", "İ", "²", "½", "Ⅷ", "1", "9", "_", "-", "!", "…", "日本", "한", "😀", "\xa0",
          "\u3000", "\x85", "\x1c", "<|endoftext|>", "<|startoftext|>", "</w>", "ﬁ", "\u0300", "K", "ſ", "\ufeff", "\x00", "ا", "the", "ing"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_odd_strings(text):
    assert_same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    assert_same(text.replace("\ud800", ""))


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000 + "é" * 2000, "thethe" * 200, "!" * 700, "x" * 49 + " " + "y" * 48])
def test_long_words(text):
    assert_same(text)


def test_cuts_are_certain():
    """No token holds a pair of symbols where a word is cut; fragments of random words add up to the whole word."""
    own, wanted = both()
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("eéßöqxzjñ日ü") for _ in range(rng.randint(2, 14)))
        assert own.encode(word) == wanted.encode(word, add_special_tokens=False).ids


def test_tables(spark):
    _, wanted = both()
    docs = with_clashes(odd_documents(spark))
    coded = bpe.decode(bpe.encode(docs, vocabulary()), vocabulary())
    assert coded.count() == docs.count() and set(CLASHING) <= set(coded.columns)
    for text, ids, decoded in rows_of(coded, "text", "ids", "decoded"):
        want = wanted.encode(text or "", add_special_tokens=False).ids
        assert ids == want and decoded == wanted.decode(want, skip_special_tokens=False)
    for key, n, ids, decoded in rows_of(bpe.digests(docs, vocabulary()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"):
        if n == 0:
            assert ids == decoded == hashlib.sha256(b"").hexdigest()
    assert bpe.digests(docs.limit(0), vocabulary()).count() == 0
