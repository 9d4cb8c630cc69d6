"""Quality rules: the statistics against plain Python, the verdict on labelled rows, odd tables."""

import numpy as np
import pytest
from brute import CLASHING, SF, odd_documents, rows_of, with_clashes, words
from pyspark.sql import functions as F

from tallyward.llm import quality


def plain_statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
            len(w) < 10 or 100 * len(repeated) > 20 * len(w))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_statistics_of_all_documents(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = quality.judged(docs, np.zeros(16, np.int64), None)
    for text, *got in rows_of(found, "text", *COLUMNS):
        assert tuple(got) == plain_statistics(text)


def test_scores_add_up(spark):
    """Scores by plain counting in as many buckets as there are."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "a a b"), (3, "d"), (4, None)], "doc_id long, text string")
    ratios = np.arange(16, dtype=np.int64) * 1_000_000
    got = dict(rows_of(quality.judged(docs, ratios, None), "doc_id", "score"))
    import pyarrow as pa

    from tallyward.llm.textblocks import Block

    for key, text in ((1, "a b c"), (2, "a a b"), (3, "d")):
        spans = Block(pa.array([text])).words()
        own = spans.hashes()
        pairs = spans.windows(own, 2)[1]
        grams = np.concatenate([own, pairs]) % np.uint64(16)
        assert got[key] == pytest.approx(float(grams.sum()) / (len(grams) + quality.PRIOR))
    assert got[4] == 0


def test_junk_goes_and_clean_text_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.quality_rules(docs, labels).join(labels, "doc_id").where("not base_failed")
    kept = {(q, k): n for q, k, n in rows_of(found.groupBy("quality", "kept").count(), "quality", "kept", "count")}
    assert kept.get((1, False), 0) <= 0.01 * kept[1, True]
    assert kept.get((0, True), 0) <= 0.25 * kept[0, False]


def test_same_result_however_rows_are_dealt(spark, labels):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(rows_of(quality.quality_rules(docs, labels), "doc_id", "score", "kept"))
    assert one == sorted(rows_of(quality.quality_rules(docs.repartition(13), labels.repartition(3)), "doc_id", "score", "kept"))


def test_odd_rows(spark, labels):
    docs = with_clashes(odd_documents(spark))
    found = quality.quality_rules(docs, labels)
    assert found.count() == docs.count() and set(CLASHING) <= set(found.columns)
    for text, label, *got in rows_of(found, "text", "label", *COLUMNS):
        assert tuple(got) == plain_statistics(text) and label == "own label"
    assert quality.quality_rules(docs.limit(0), labels).count() == 0
    nobody = labels.limit(0)
    assert {k == (not b) for k, b in rows_of(quality.quality_rules(docs, nobody), "kept", "base_failed")} == {True}
    nulls = spark.createDataFrame([(None, None, None), (1, None, 1), (None, 1, 0), (1, 1, 0), (1, 1, 0)], labels.schema)
    assert quality.quality_rules(docs, nulls).count() == docs.count()


def test_every_trusted_document_counts(spark):
    """More trusted documents than the 20,000 that a sample held before; equal counts of both multinomials leave no ratio."""
    n = 24_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n // 2, "a b").otherwise("c d").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert quality.trusted_keys(labels, "doc_id", F.col("quality") == 1).count() == n
    held = docs.where(F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(quality.HELD_OUT)) == 0)
    ratios, low = quality.fit(docs, labels)
    assert low is None and held.count() > 0  # texts of two words fail the base rules
    raw, target = n // 2, (docs.where("text = 'a b'").count() - held.where("text = 'a b'").count())
    want = np.log((target + quality.PSEUDO) / (raw / (2 * raw) * (n - held.count()) + quality.PSEUDO))
    assert np.abs(ratios / 1e6 - want).min() < 1e-6
