"""Mixing: against its SQL, targets against plain water-filling, positions against the schedule, odd tables."""

import pytest
from brute import CLASHING, SF, odd_documents, rows_of, with_clashes
from compare import connect, differences
from pyspark.sql import functions as F

from tallyward.llm import curriculum


@pytest.mark.parametrize("rows", [20_000, 7])
def test_all_documents(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = curriculum.in_training_order(curriculum.curriculum(docs, bucket_rows=rows).select("doc_id", "size", "source_size", "target", "taken", "positions"))
    assert differences(found, connect(SF), curriculum.SQL) is None


def test_buckets_of_a_source_are_dealt_apart(spark):
    """One source has all rows, in many tasks."""
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit("a few words").alias("text"))
    with_part = curriculum.curriculum(docs.repartition(8), bucket_rows=50).withColumn("part", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [n for (n,) in rows_of(with_part.groupBy("part").count(), "count")]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 4 and max(sizes) < 2_000


def test_documents_in_training_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = curriculum.in_training_order(curriculum.curriculum(docs))
    first = [int(p.split(",")[0]) if p else 2 * 10**9 for (p,) in rows_of(found, "positions")]
    assert first == sorted(first)


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        level = left / max(sum(weight[s] for s in names if s not in full), 1)
        over = {s for s in names if s not in full and weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 20, "c": 1000}, {"a": 1, "b": 500, None: 400}, {"a": 0, "b": 7}, {"é": 5, "z": 5, "Z": 900, None: 1}, {"a": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = dict(rows_of(curriculum.source_targets(df), "source", "target"))
    assert got == pytest.approx(plain_targets(sizes))


def test_words_taken_come_near_their_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = curriculum.curriculum(docs)
    largest = mixed.agg(F.max("size")).first()[0]
    for target, taken in rows_of(mixed.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")), "target", "taken"):
        assert abs(target - taken) <= largest
    assert mixed.where("taken > 3 * size").count() == 0
    assert mixed.where("size > 0 and taken <> size * size(positions)").count() == 0


def test_positions_follow_the_schedule(spark):
    """Up to any time the words of a source are as many as its integrated schedule asks."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.repeat(F.lit("w "), 5).alias("text"))
    copies = curriculum.training_order(curriculum.curriculum(docs))
    for source, slope in zip(("s0", "s1", "s2"), curriculum.SLOPES):
        mine = [p for (p,) in rows_of(copies.where(F.col("source") == source), "position")]
        for t in (0.1, 0.5, 0.8):
            wanted = t * (1 - slope / 2) + slope * t * t / 2
            assert sum(p < t for p in mine) / len(mine) == pytest.approx(wanted, abs=0.01)
    order = [p for (p,) in rows_of(copies, "position")]
    assert order == sorted(order)


def test_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    found = curriculum.curriculum(docs, bucket_rows=2)
    assert found.count() == docs.count() and set(CLASHING) <= set(found.columns)
    for text, size, taken, positions, slope in rows_of(found, "text", "size", "taken", "positions", "slope"):
        assert size == len((text or "").split()) and taken in (0, size, 2 * size, 3 * size) and all(0 <= p <= 1 for p in positions)
        assert slope == "own slope" and (size > 0 or positions == [])
    assert curriculum.curriculum(docs.limit(0)).count() == 0
    empty = docs.where("text is null or text = ''")
    assert {t for (t,) in rows_of(curriculum.curriculum(empty), "taken")} == {0}
