"""Order statistics against brute force, on ties, skew, gaps and any number of partitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators import order_stats


def linear(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    lo, hi = math.floor(at), math.ceil(at)
    return values[lo] + (values[hi] - values[lo]) * (at - lo)


SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def sample(n, ties, seed=1):
    """A third of the rows in one group, and a third with one value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randint(0, 4)}"
        value = 7.0 if i % 3 == 1 else float(rng.randint(-ties, ties)) / 4
        rows.append((key, value))
    return rows + [("hot", None), (None, 1.0), ("hot", float("nan"))]


@pytest.mark.parametrize("ties", [3, 100_000])
def test_quantiles(spark, ties):
    rows = sample(6000, ties)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    groups = {}
    for k, v in rows:
        if k is not None and v is not None and not math.isnan(v):
            groups.setdefault(k, []).append(v)
    got = order_stats.quantile_rows(df, "v", SHARES, ["k"]).collect()
    assert len(got) == len(groups) * len(SHARES)
    for r in got:
        assert r["quantile"] == pytest.approx(linear(groups[r["k"]], SHARES[r["place"]]))
    alone = order_stats.quantiles(df.where("k is not null"), "v", [0.5], ["m"]).first()["m"]
    assert alone == pytest.approx(linear([v for g in groups.values() for v in g], 0.5))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert order_stats.quantile_rows(df, "v", [0.5], ["k"]).collect() == []
    assert order_stats.quantiles(df, "v", [0.5], ["m"]).first()["m"] is None


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_cumulative_counts_on_any_number_of_partitions(spark, partitions):
    rows = [(k, v) for k, v in sample(3000, 50_000) if k and v is not None and not math.isnan(v)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "k string, v double")
        got = {(r["k"], r["v"]): (r["n"], r["n_before"], r["n_total"])
               for r in order_stats.cumulative_counts(df, "v", ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {}
    for k in {k for k, _ in rows}:
        values = [v for g, v in rows if g == k]
        for v in set(values):
            want[k, v] = (values.count(v), sum(x < v for x in values), len(values))
    assert got == want


def test_average_ranks(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (20.0,), (30.0,)], "v double")
    got = {r["v"]: r["r"] for r in order_stats.average_ranks(df, "v", "r").collect()}
    assert got == {10.0: 1.0, 20.0: 2.5, 30.0: 4.0}


def test_a_hot_group_is_dealt_to_many_partitions(spark):
    """99 of 100 rows in one group, all values different: no partition holds more than a few times its share."""
    df = spark.range(200_000).select(F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("k"), F.col("id").cast("double").alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = order_stats.ranged_counts(df, "v", ["k"], {"n": F.lit(1).cast("long")})
        sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert len(sizes) == 8 and max(sizes) < 2 * 200_000 / 8


def test_a_hot_value_is_one_row(spark):
    df = spark.range(50_000).select(F.lit("a").alias("k"), F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(0).cast("double").alias("v"))
    assert order_stats.ranged_counts(df, "v", ["k"], {"n": F.lit(1).cast("long")}).count() == 1_000


def test_weighted_ranks(spark):
    df = spark.createDataFrame([(10.0, 1), (20.0, 2), (30.0, 1)], "v double, n long")
    got = {r["v"]: r["r"] for r in order_stats.average_ranks(df, "v", "r", F.col("n")).collect()}
    assert got == {10.0: 1.0, 20.0: 2.5, 30.0: 4.0}


def test_quantiles_order_few_values(spark, monkeypatch):
    """Only values near a wanted place are counted one by one; values of any sign and size keep their order."""
    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 9) for _ in range(5000)] + [0.0, -0.0, float("inf"), float("-inf")]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k int, v double").repartition(5)
    sizes, stage = {}, order_stats.stage

    def counted(rows, name):
        staged = stage(rows, name)
        sizes[name] = staged.count()
        return staged

    monkeypatch.setattr(order_stats, "stage", counted)
    shares = [0.1, 0.5, 0.9]
    got = {(r["k"], r["place"]): r["quantile"] for r in order_stats.quantile_rows(df, "v", shares, ["k"]).collect()}
    for k in (0, 1):
        for place, share in enumerate(shares):
            assert got[k, place] == pytest.approx(linear(values[k::2], share), rel=1e-12)
    assert sizes["counts"] < 200  # all 5,004 before
