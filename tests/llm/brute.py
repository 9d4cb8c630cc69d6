"""Plain Python versions of what the operators compute, and tables full of odd rows."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_documents(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows and columns with names that clash."""
    long_text = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000)) + "."
    passage = " ".join(f"shared{i}" for i in range(70)) + ". And more, of it. The end."
    rows = [
        (None, None, None, None, None), (None, "some text without a key, but with enough words to count here.", "en", None, 3),
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "b", 0), (4, long_text, "en", "a", 1), (5, long_text, None, "b", 1),
        (6, "tie one two three four five six seven eight nine ten.", "en", "a", 1),
        (6, "tie one two three four five six seven eight nine ten.", "en", "a", 1),
        (6, "another text of the same key with ten words in it.", "en", None, 1),
        (7, f"Before it. {passage}", "de", "c", 1), (8, f"Other words here. {passage} After.", "de", "c", 1), (9, "x" * 50_000, "en", "c", 1),
        (10, "é😀 ß ñ " * 20, "fr", "c", 1), (11, "é😀 ß ñ " * 20, "fr", "é", 1), (-5, "negative key", "", "", -1),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


CLASHING = ("score", "kept", "n_words", "size", "taken", "target", "source_size", "slope", "positions", "ids", "decoded", "class", "class_id", "id",
            "node", "a", "b", "run", "check", "first", "place", "n_removed", "band", "bucket", "n", "least", "begin", "end", "host", "path", "rule",
            "verdict", "address", "allowed", "bytes", "lo", "hi", "digest", "part", "edge", "tie", "fingerprint", "label", "quality", "piece")


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING if c not in df.columns})


def shingle_counts(text, size=5):
    w = words(text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def near_classes(texts: dict, least=0.8):
    """Class of each key: the least key of its component of texts whose weighted Jaccard similarity is ``least`` or more."""
    shingles = {k: shingle_counts(t) for k, t in texts.items()}
    holders = defaultdict(list)
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, mine in shingles.items():
        shared = Counter()
        for s, n in mine.items():
            for other in holders[s]:
                shared[other] += min(n, shingles[other][s])
            holders[s].append(k)
        for other, n in shared.items():
            total = sum(mine.values()) + sum(shingles[other].values()) - n
            if n / total >= least:
                a, b = root(k), root(other)
                parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in texts}


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
