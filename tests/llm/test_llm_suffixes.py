"""Repeated byte strings against brute force, by both ways of refining; odd tables."""

import random
from collections import Counter

import numpy as np
import pytest
from brute import SF, odd_documents, rows_of, with_clashes

from tallyward.llm import suffixes


def plain(rows):
    seen = Counter()
    n = suffixes.LENGTH
    coded = [(k, (t or "").encode()) for k, t in rows]
    for _, b in coded:
        seen.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = Counter()
    for k, b in coded:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        begins = gone & ~np.concatenate([[False], gone[:-1]]) if len(b) else gone
        out[k, len(b), int(gone.sum()), int(begins.sum()), bytes(np.frombuffer(b, np.uint8)[~gone])] += 1
    return out


def same(df):
    got = rows_of(suffixes.remove_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert Counter((k, n, r, s, bytes(b)) for k, n, r, s, b in got) == plain(rows_of(df, "doc_id", "text"))


def made(spark):
    rng = random.Random(2)
    text = lambda letters, n: "".join(rng.choices(letters, k=n))
    base = text("abcdefgh é", 3000)
    rows = [(None, None), (1, ""), (1, "x" * 150), (2, "x" * 400), (3, "ab" * 300), (4, base[:1000]), (4, base[:1000]), (5, base[500:900]),
            (6, "q" * 10 + base[100:299]), (7, base[1200:1401] + "z"), (8, "y" + base[1200:1401]), (9, base[2000:2199]), (10, base[2000:2300]),
            (11, base[2050:2260] + base[2040:2245])]
    rows += [(100 + i, text("klmnop", rng.randint(0, 400)) + base[1500:1800] + text("klmnop", rng.randint(0, 400))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_all_documents(spark):
    same(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("local", [2_000, 5])
def test_made_texts(spark, monkeypatch, local):
    monkeypatch.setattr(suffixes, "LOCAL", local)
    same(made(spark))


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    same(docs)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_refinement_ranks_equal_windows_together():
    rng = random.Random(9)
    part = bytes(rng.choices(range(97, 101), k=260))
    spans = [part, part[30:250] + b"!" * 30, bytes(rng.choices(range(97, 101), k=300)), part[:230]]
    data = np.frombuffer(b"".join(spans), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in spans])])
    at, again = suffixes.refine(data, offsets, np.array([7, 7, 7, 8]))
    windows = {}
    owner = np.searchsorted(offsets, at, "right") - 1
    for i, o in zip(at.tolist(), owner.tolist()):
        windows.setdefault((o == 3, bytes(data[i : i + suffixes.LENGTH])), []).append(i)
    repeated = {i for places in windows.values() if len(places) > 1 for i in places}
    assert {int(i) for i in at[again]} == repeated and repeated


def test_least_in_windows():
    keys = np.random.default_rng(1).integers(0, 50, 100).astype(np.uint64)
    for size in (1, 3, 7, 100):
        assert suffixes.least_in_windows(keys, size).tolist() == [keys[i : i + size].min() for i in range(100 - size + 1)]
    assert len(suffixes.least_in_windows(keys, 101)) == 0
