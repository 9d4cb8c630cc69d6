"""Near-duplicates: classes against brute force, signatures against the similarity they estimate, odd tables."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import near_classes, odd_documents, rows_of, shingle_counts, with_clashes, words

from tallyward.llm import components, probminhash
from tallyward.llm.textblocks import Block


def test_classes_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = near_classes(dict(rows_of(docs, "doc_id", "text")))
    assert dict(rows_of(probminhash.near_duplicates(docs), "doc_id", "class_id")) == want


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**9)}"
    return w


def test_a_group_of_copies_that_are_like_the_first_only(spark):
    """Copies of one text are far from each other but near to it, and copies of copies hang on by a chain."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(220)]
    texts = {50: base}
    for i in range(60):
        texts[100 + i] = edited(rng, base, rng.randint(1, 5))
    chain = base
    for i in range(10):
        chain = edited(rng, chain, 4)
        texts[10 + i] = chain
    docs = {k: " ".join(w) for k, w in texts.items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert dict(rows_of(probminhash.near_duplicates(df), "doc_id", "class_id")) == near_classes(docs)


def test_signatures_estimate_the_probability_similarity():
    rng = random.Random(2)
    for change in (0, 3, 10, 30):
        a = [f"w{rng.randrange(60)}" for _ in range(300)]
        b = edited(rng, a, change)
        block = Block(pa.array([" ".join(a), " ".join(b)]))
        row, hashes, count = probminhash.shingles(block)
        found = probminhash.signatures(2, row, hashes, count, 4096)
        x, y = shingle_counts(" ".join(a)), shingle_counts(" ".join(b))
        nx, ny = sum(x.values()), sum(y.values())
        want = 0.0
        for s in x.keys() & y.keys():
            want += 1 / sum(max(x[t] / x[s], y[t] / y[s]) for t in x.keys() | y.keys())
        assert (found[0] == found[1]).mean() == pytest.approx(want, abs=0.035) and nx and ny


def test_similarity_is_exact():
    pairs = [("a b c d e f", "a b c d e f"), ("a b c d e f", "a b c d e g"), ("a b", "a b"), ("a b", "a c"), ("x y z x y z x y z x y z", "x y z x y z x y z"), ("", "a")]
    got = probminhash.similarity(Block(pa.array([a for a, _ in pairs])), Block(pa.array([b for _, b in pairs])))
    for (a, b), s in zip(pairs, got):
        x, y = shingle_counts(a), shingle_counts(b)
        assert s == pytest.approx(sum((x & y).values()) / max(sum((x | y).values()), 1))


def test_one_shingle_fills_all_registers():
    block = Block(pa.array(["just one", "just one", "other"]))
    row, hashes, count = probminhash.shingles(block)
    found = probminhash.signatures(3, row, hashes, count)
    assert (found[0] == found[1]).all() and (found[0] != found[2]).all() and len(np.unique(found[0])) == 1


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    found = rows_of(probminhash.near_duplicates(docs), "doc_id", "class_id", "is_first")
    assert len(found) == docs.count()
    classes = {k: c for k, c, _ in found}
    assert classes[5] == 4 and classes[11] == 10 and classes[6] == 6 and classes[2] == 2 and classes[3] == 3 and classes[None] is None
    assert all(first == (k == c) for k, c, first in found)
    assert probminhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (2000, 2001), (2001, 2000)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = dict(rows_of(components.components(spark.createDataFrame(links, "a long, b long")), "node", "class"))
    assert got == {x: root(x) for x in parent if any(x in pair and pair[0] != pair[1] for pair in links)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_cut_alike():
    text = " a\x0bb\x0cc\u00a0d\te\r\nf\u2003g "
    block = Block(pa.array([text, None, ""]))
    assert block.words().counts.tolist() == [len(words(text)), 0, 0]


def test_the_register_bound_loses_less_than_the_bands():
    n, p = probminhash.REGISTERS, probminhash.SIMILARITY
    short = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(probminhash.AGREE))
    assert short < (1 - p**probminhash.ROWS) ** probminhash.BANDS
