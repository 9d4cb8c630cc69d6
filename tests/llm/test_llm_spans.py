"""Sentence spans: against a brute-force version over the same sentences; passages, order and odd tables."""

import random

import pyarrow as pa
from brute import CLASHING, SF, odd_documents, rows_of, with_clashes

from tallyward.llm import spans
from tallyward.llm.textblocks import Block


def sentences_of(text):
    """(words, bytes) of each sentence as the operator cuts them."""
    block = Block(pa.array([text or ""]))
    words = block.words()
    begins = spans.sentences(block, words, words.hashes()).tolist()
    ends = [*begins[1:], len(words)] if begins else []
    data = (text or "").encode()
    starts = [0 if i == 0 else int(words.starts[b]) for i, b in enumerate(begins)] + [len(data)]
    return [([data[words.starts[w] : words.ends[w]] for w in range(a, b)], data[starts[i] : starts[i + 1]])
            for i, (a, b) in enumerate(zip(begins, ends))]


def runs_of(cut):
    """First and last sentence and words of every run."""
    found = []
    for i in range(len(cut)):
        for j in range(i, len(cut)):
            if j - i + 1 >= spans.RUN_SENTENCES and sum(len(w) for w, _ in cut[i : j + 1]) >= spans.RUN_WORDS:
                found.append((i, j))
                break
    for i in reversed(range(len(cut))):
        if len(cut) - i >= spans.RUN_SENTENCES and sum(len(w) for w, _ in cut[i:]) >= spans.RUN_WORDS:
            if (i, len(cut) - 1) not in found:
                found.append((i, len(cut) - 1))
            break
    return [(i, j, tuple(x for w, _ in cut[i : j + 1] for x in w)) for i, j in found]


def plain_dedup(rows):
    """Texts left of (key, text); a NULL key is the least."""
    rank = lambda k: (k is not None, k)
    cuts = [(k, t, sentences_of(t)) for k, t in rows]
    first = {}
    for k, _, cut in cuts:
        for _, _, run in runs_of(cut):
            if run not in first or rank(k) < rank(first[run]):
                first[run] = k
    out = []
    for k, t, cut in cuts:
        gone, seen = set(), set()
        for i, j, run in runs_of(cut):
            if first[run] != k or run in seen:
                gone.update(range(i, j + 1))
            seen.add(run)
        left = b"".join(b for i, (_, b) in enumerate(cut) if i not in gone).decode()
        out.append((k, t if t is None or not cut else left, len(cut), len(gone)))
    return out


def same(df):
    found = spans.span_dedup(df)
    key = lambda r: tuple((x is not None, x) for x in r)
    want = sorted(plain_dedup(rows_of(df, "doc_id", "text")), key=key)
    assert sorted(rows_of(found, "doc_id", "text", "n_sentences", "n_removed"), key=key) == want
    return found


def test_all_documents(spark):
    same(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    found = same(docs)
    assert set(CLASHING) <= set(found.columns)
    assert spans.span_dedup(docs.limit(0)).count() == 0


def test_a_passage_goes_but_for_its_edges(spark):
    base = [t for (t,) in rows_of(spark.read.parquet(f"{SF}/documents.parquet").where("n_chars between 500 and 3000").dropDuplicates(["text"]), "text")]
    passage = "It began there, in the old house. " + " ".join(f"thing{i}{',' if i % 7 == 6 else '.' if i % 11 == 10 else ''}" for i in range(55)) + "."
    rows = []
    for i, text in enumerate(base[:30]):
        w = text.split(" ")
        rows.append((i, " ".join([*w[: len(w) // 2], passage, *w[len(w) // 2 :]])))
    left = dict(rows_of(spans.span_dedup(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "text"))
    assert passage in left[0]
    for i in range(1, len(rows)):
        assert sum(w in left[i] for w in passage.split()[6:]) <= 14


def test_clean_texts_stay(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}{'.' if j % 9 == 0 else ''}" for j in range(300))) for i in range(20)], "doc_id long, text string")
    assert {r["n_removed"] for r in spans.span_dedup(docs).collect()} == {0}


def test_passages_amid_sentences(spark):
    """Repeated passages that begin and end inside sentences, long or without marks, are found wherever they stand."""
    rng = random.Random(25)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(5000)]

    def prose(n, least, most):
        """Words in sentences of so many words; none end if ``least`` is 0."""
        words, left = rng.choices(vocabulary, k=n), rng.randint(1, max(most, 1))
        for i in range(n):
            left -= 1
            if least and left <= 0:
                words[i] += "."
                left = rng.randint(least, most)
        return words

    n = 150
    for kind, (least, most, size, share) in enumerate([(12, 24, 52, 0.93), (25, 30, 52, 0.93), (0, 0, 52, 0.93), (0, 0, 80, 0.98)]):
        rows = []
        for i in range(n):
            passage = prose(size, least, most)
            passage[-1] = passage[-1].rstrip(".")
            for copy in (0, 1):
                rows.append((2 * i + copy, " ".join(prose(60, least, most)[:-1] + ["before"] + passage + prose(60, least, most))))
        got = rows_of(spans.span_dedup(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_removed")
        assert all(removed == 0 for k, removed in got if k % 2 == 0)
        found = sum(removed > 0 for k, removed in got if k % 2) / n
        print(f"kind {kind}: {found:.3f}")
        assert found >= share, (kind, found)


def test_rows_of_one_key_lose_only_what_they_hold(spark):
    """A row that shares its key with another loses nothing that only the other one repeats, and places past its end harm nobody."""
    passage = " ".join(f"shared{i} words{i} of{i} it{i}." for i in range(30))
    own = " ".join(f"own{i} text{i} here{i} too{i}." for i in range(35))
    rows = [(1, passage), (6, f"{passage} {own}"), (6, own.replace("own", "else")), (6, "short one"), (6, None), (None, passage), (None, own.replace("own", "third")), (None, "x")]
    texts = [t for (t,) in rows_of(spans.span_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)), "text")]
    for whole in (own.replace("own", "else"), "short one", None, own.replace("own", "third"), "x"):
        assert whole in texts
    # The first one by key keeps the passage, here the NULL key; the others lose it but for its edges.
    assert sum(t is not None and "shared15" in t for t in texts) == 1 and any(t is not None and "own20" in t and "shared15" not in t for t in texts)


def test_extra_rows_of_a_key_change_nothing_for_others(spark):
    docs = odd_documents(spark)
    more = docs.unionByName(spark.createDataFrame([(7, "y " * 3000, "en", "a", 1), (8, "short", "en", "a", 1), (None, "z. " * 500, "en", "a", 1)], docs.schema))
    both = {(k, t) for k, t in rows_of(spans.span_dedup(docs), "doc_id", "text")}
    assert both <= {(k, t) for k, t in rows_of(spans.span_dedup(more), "doc_id", "text")}
