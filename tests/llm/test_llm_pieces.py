"""SentencePiece BPE against the public library: all code points, all documents, runs and chains; round trips and odd tables."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import CLASHING, odd_documents, rows_of, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import pieces
from tallyward.llm.queries import piece_model

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=piece_model())
with open(piece_model(), "rb") as file:
    OWN = pieces.Pieces(file.read(), remembered=5_000)


def assert_same(texts):
    flat, counts = OWN.encode_all(pa.array(texts, pa.large_string()))
    decoded = OWN.decode_all(flat, counts).to_pylist()
    at = 0
    for text, n, wanted, back in zip(texts, counts.tolist(), LIBRARY.encode(texts, num_threads=1), decoded):
        assert flat[at : at + n].tolist() == wanted, text[:100]
        assert back == LIBRARY.decode(wanted)
        at += n


def test_all_code_points():
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 100_000):
        assert_same([f"a{c} {c}{c}b" for c in chars[at : at + 100_000]])


def test_all_documents(spark):
    assert_same([t or "" for (t,) in rows_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "text")])


PARTS = ["a", "b", "th", "e", "  ", "   ", " ", "▁", "=", "==", "-", "\n", "\t", "é", "日", "本", "😀", "ing", "the", "<s>", "</s>", "<unk>", "<0x41>", "\x00",
         "\"", "0", "1", "tion", "é", "x", "﻿", "\xa0", "　"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), min_size=1, max_size=5))
def test_odd_strings(texts):
    assert_same(texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    assert_same([text.encode("utf-8", "ignore").decode()])


def test_runs_of_spaces():
    assert OWN.run > 1
    assert_same([" " * k + end for k in range(120) for end in ("", "the", "日", "▁x")])


def test_chains_and_long_words():
    """Places that make a better pair must wait for it, also in a word of a hundred thousand characters; no such text takes long."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    assert_same(["the" * 20_000, "ted" * 20_000, "x" * 50_000, "=" * 30_001, " " * 100_000, "0123456789" * 5_000,
                 "".join(rng.choice(letters) for _ in range(100_000)), "".join(rng.choice("rnted") for _ in range(50_000)),
                 "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(50_000))])


def test_rounds_against_one_merge_after_the_other():
    """Fragments merged by plain Python: always the best pair, the leftmost of equal ones."""
    rng = random.Random(5)
    joined = dict(zip(OWN.pairs.tolist(), OWN.joined.tolist()))
    for _ in range(300):
        parts = OWN.char_ids[[ord(rng.choice("therdingao▁st")) for _ in range(rng.randint(1, 25))]].tolist()
        found = OWN._merged(np.array(parts), np.zeros(len(parts), np.int64))[0].tolist()
        while True:
            pairs = [(joined[a * OWN.step + b] >> 20, i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a * OWN.step + b in joined]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [joined[parts[i] * OWN.step + parts[i + 1]] & 0xFFFFF]
        assert found == parts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 300), max_size=20))
def test_decoding_any_ids(ids):
    flat = np.array(ids, np.int64)
    assert OWN.decode_all(flat, np.array([len(ids)])).to_pylist() == [LIBRARY.decode(ids)]


def test_bad_ids_and_files():
    with pytest.raises(ValueError, match="vocabulary"):
        OWN.decode_all(np.array([32_000]), np.array([1]))
    with pytest.raises(ValueError, match="only BPE"):
        pieces.Pieces(b"")


def test_tables(spark):
    docs = with_clashes(odd_documents(spark))
    coded = pieces.decode(pieces.encode(docs, piece_model()), piece_model())
    assert coded.count() == docs.count() and set(CLASHING) <= set(coded.columns)
    for text, ids, decoded in rows_of(coded, "text", "ids", "decoded"):
        wanted = LIBRARY.encode(text or "")
        assert ids == wanted and decoded == LIBRARY.decode(wanted)
    both = pieces.encode(docs, piece_model(), decoded="back")
    assert {d for (d,) in rows_of(both, "back")} == {d for (d,) in rows_of(coded, "decoded")}
    wanted = sorted((str(k), len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(d.encode()).hexdigest())
                    for k, i, d in rows_of(coded, "doc_id", "ids", "decoded"))
    found = rows_of(pieces.digests(docs, piece_model()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted((str(k), *rest) for k, *rest in found) == wanted
    assert pieces.digests(docs.limit(0), piece_model()).count() == 0
