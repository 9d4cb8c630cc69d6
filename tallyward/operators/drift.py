"""Drift between a baseline and current rows: population stability, Kolmogorov-Smirnov, summaries.

All numeric columns are melted and both sides read once: what is kept are counts per column and distinct value, from which the stability
index, the distribution distance and the moments follow.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.functions.bins import edge_bin
from tallyward.functions.expr import numeric_columns, ratio
from tallyward.operators.order_stats import cumulated, cumulative_counts, melt, ranged_counts


def common_features(baseline: DataFrame, current: DataFrame, features: Iterable[str] | None = None) -> list[str]:
    """Numeric columns that both sides have; columns of one side only are skipped."""
    wanted = list(features) if features is not None else numeric_columns(baseline)
    return [c for c in wanted if c in baseline.columns and c in current.columns]


def both_sides(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Long form (side, feature, value), side 0 being the baseline."""
    sides = [melt(df, features).withColumn("side", F.lit(i)) for i, df in enumerate((baseline, current))]
    return sides[0].unionByName(sides[1]).where(F.col("value") <= float("inf"))


def _term(expected: Column, actual: Column) -> Column:
    e, a = (F.when(s == 0, V.PSI_EMPTY_SHARE).otherwise(s) for s in (expected, actual))
    return (a - e) * F.log(a / e)


def psi_of_counts(expected: list[Column], actual: list[Column]) -> Column:
    """Index of two histograms given as counts per bin; NULL if one of them is empty."""
    te, ta = reduce(Column.__add__, expected), reduce(Column.__add__, actual)
    return reduce(Column.__add__, [_term(ratio(e, te), ratio(a, ta)) for e, a in zip(expected, actual)])


#: Weight of the rows of each side.
_SIDES = {"b": 0, "c": 1}


def value_counts(long: DataFrame) -> DataFrame:
    """Rows of each side per feature and distinct value, in staged ranges. All figures follow from this one table."""
    weights = {w: F.when(F.col("side") == i, 1).otherwise(0).cast("long") for w, i in _SIDES.items()}
    return ranged_counts(long, "value", ["feature"], weights)


def baseline_ranges(counts: DataFrame) -> DataFrame:
    """Smallest and largest baseline value: one row per column of the table."""
    base = F.when(F.col("b") > 0, F.col("value"))
    return counts.groupBy("feature").agg(F.min(base).alias("lo"), F.max(base).alias("hi"))


def psi(counts: DataFrame, bins: int = V.PSI_BINS) -> DataFrame:
    """Index per feature over equal-width bins of the baseline range; the outer bins are open."""
    placed = counts.join(F.broadcast(baseline_ranges(counts)), "feature").withColumn(
        "bin", edge_bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
    sums = placed.groupBy("feature").agg(
        *[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col(w))), F.lit(0)).alias(f"{w}{i}") for w in _SIDES for i in range(bins)])
    index = psi_of_counts([F.col(f"b{i}") for i in range(bins)], [F.col(f"c{i}") for i in range(bins)])
    return sums.select("feature", index.alias("psi"))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic probability of a distance of at least d between two samples of one population."""
    lam = d * F.sqrt(n.cast("double") * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam))
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), series * 2))
    return F.when(lam < 0.2, 1.0).otherwise(p)


def ks(counts: DataFrame) -> DataFrame:
    """Largest distance between the two distribution functions of each feature, with its p-value."""
    counts = cumulated(counts, "value", ["feature"], _SIDES)

    def share(w: str) -> Column:
        return ratio(F.col(f"{w}_before") + F.col(w), F.col(f"{w}_total"))

    found = counts.groupBy("feature").agg(
        F.max(F.abs(share("b") - share("c"))).alias("ks_statistic"),
        F.max("b_total").alias("_n"), F.max("c_total").alias("_m"))
    return found.select("feature", "ks_statistic",
                        ks_pvalue(F.col("ks_statistic"), F.col("_n"), F.col("_m")).alias("ks_pvalue"))


def side_stats(counts: DataFrame) -> DataFrame:
    """Mean and deviation of both sides, the deviation from the distances to the mean."""
    x = F.col("value")
    names = {"b": "baseline", "c": "current"}
    means = counts.groupBy("feature").agg(
        *[F.sum(w).alias(f"n_{w}") for w in names], *[ratio(F.sum(x * F.col(w)), F.sum(w)).alias(f"{n}_mean") for w, n in names.items()])
    far = counts.join(F.broadcast(means), "feature")  # one row per column of the table
    square = {w: F.col(w) * (x - F.col(f"{n}_mean")) * (x - F.col(f"{n}_mean")) for w, n in names.items()}
    return far.groupBy("feature").agg(
        *[F.first(f"{n}_mean").alias(f"{n}_mean") for n in names.values()],
        *[F.sqrt(ratio(F.sum(square[w]), F.first(f"n_{w}") - 1)).alias(f"{n}_std") for w, n in names.items()])


def detect(baseline: DataFrame, current: DataFrame, threshold: float = V.PSI_DRIFT,
           features: Iterable[str] | None = None, alpha: float = V.KS_ALPHA) -> DataFrame:
    """Verdict per common numeric column, highest index first."""
    counts = value_counts(both_sides(baseline, current, common_features(baseline, current, features)))
    joined = side_stats(counts).join(psi(counts), "feature", "left").join(ks(counts), "feature", "left")
    drifted = F.coalesce(F.col("psi") > threshold, F.lit(False)) | F.coalesce(F.col("ks_pvalue") < alpha, F.lit(False))
    return joined.select(
        "feature", drifted.alias("drift_detected"), "psi", "ks_statistic", "ks_pvalue",
        "baseline_mean", "current_mean", "baseline_std", "current_std",
    ).orderBy(F.desc_nulls_last("psi"), "feature")


def band(index: Column) -> Column:
    return (F.when(index < V.PSI_DRIFT, "none").when(index <= V.PSI_SIGNIFICANT, "minor")
            .when(index > V.PSI_SIGNIFICANT, "significant"))


def summary(results: DataFrame, threshold: float = V.PSI_DRIFT, top: int | None = None) -> DataFrame:
    """One row: how many columns were checked and drifted, and the drifted ones, or the ``top`` most drifted of them."""
    change = ratio((F.col("current_mean") - F.col("baseline_mean")) * 100, F.col("baseline_mean"))
    item = F.struct((-F.col("psi")).alias("order"), F.col("feature"), F.col("psi"), band(F.col("psi")).alias("band"),
                    F.col("ks_statistic"), F.col("ks_pvalue"), change.alias("mean_change"))
    listed = F.array_sort(F.collect_list(F.when(F.col("drift_detected"), item)))
    return results.agg(
        F.count(F.lit(1)).alias("total_features"), F.count_if("drift_detected").alias("drifted_features"),
        F.lit(threshold).alias("drift_threshold"), (listed if top is None else F.slice(listed, 1, top)).alias("top_drifted"))


def baseline_profile(baseline: DataFrame, features: list[str], bins: int = V.PSI_BINS) -> DataFrame:
    """Range and histogram of the baseline: one row per column, small enough to keep."""
    long = melt(baseline, features).where(F.col("value") <= float("inf"))
    ranges = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))  # one row per column of the table
    placed = long.join(F.broadcast(ranges), "feature").withColumn(
        "bin", edge_bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
    return placed.groupBy("feature").agg(
        F.max("lo").alias("lo"), F.max("hi").alias("hi"),
        F.array(*[F.count_if(F.col("bin") == i) for i in range(bins)]).alias("expected"))


def drift_by_window(df: DataFrame, profile: DataFrame, features: list[str], ts: str, width: str,
                    watermark: str | None = None, bins: int = V.PSI_BINS) -> DataFrame:
    """Stability index per time window and feature against a fixed baseline profile.

    ``width`` is a duration such as '1 day', or 'month' for calendar months, which only a batch can have. Works on batch and streaming frames. A stream keeps one row of ``bins`` counts per open window
    and feature, and gives the index when the watermark closes the window.
    """
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    long = melt(df, features, [ts]).where(F.col("value") <= float("inf"))
    placed = long.join(F.broadcast(profile.select("feature", "lo", "hi")), "feature").withColumn(
        "bin", edge_bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
    window = F.window(ts, width).alias("window")
    if width == "month":
        if df.isStreaming:
            raise ValueError("a stream has no windows of calendar months")
        first = F.date_trunc("month", ts)
        window = F.struct(first.alias("start"), F.add_months(first, 1).cast("timestamp").alias("end")).alias("window")
    counts = placed.groupBy(window, "feature").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("bin") == i).alias(f"a{i}") for i in range(bins)])
    joined = counts.join(F.broadcast(profile.select("feature", "expected")), "feature")
    index = psi_of_counts([F.col("expected")[i] for i in range(bins)], [F.col(f"a{i}") for i in range(bins)])
    return joined.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         "feature", "rows", index.alias("psi"), band(index).alias("band"))


#: Points of the baseline at which a window's distribution is compared, and the size of a window's sketch.
GRID, SKETCH = 512, 1600


def distance_error(sketch: int = SKETCH, grid: int = GRID) -> float:
    """Bound of the error of ``distance_by_window``: that of the sketch's shares (with 99 % confidence) and the baseline between two points."""
    return 2.446 / sketch**0.9433 + 1 / grid


def distance_profile(baseline: DataFrame, features: list[str], grid: int = GRID) -> DataFrame:
    """Distribution of the baseline: per column its rows and at most ``2 * grid + 4`` points with the share of rows up to them.

    The points are the values that hold a multiple of 1 / grid of the rows, the ends, and just below each of them, so less than
    1 / grid of the rows lies between two.
    """
    counts = cumulative_counts(melt(baseline, features).where(F.col("value") <= float("inf")), "value", ["feature"])
    before, upto, total = F.col("n_before"), F.col("n_before") + F.col("n"), F.col("n_total")
    held = (F.floor(before * grid / total) < F.floor(upto * grid / total)) | (before == 0)
    point = F.struct("value", (before / total).alias("below"), (upto / total).alias("upto"))
    return counts.where(held).groupBy("feature").agg(F.max("n_total").alias("rows"), F.array_sort(F.collect_list(point)).alias("points"))


def distance_by_window(df: DataFrame, profile: DataFrame, features: list[str], ts: str, width: str, watermark: str | None = None,
                       sketch: int = SKETCH) -> DataFrame:
    """Distance of the distribution functions of each time window and feature to the baseline, within ``distance_error``.

    Works on tables and streams. A window and feature keep one mergeable quantile sketch, whose size does not grow with the rows; the distance is
    the largest one at the points of the profile. Windows of up to ``sketch`` rows are exact but for the points.
    """
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    long = melt(df, features, [ts]).where(F.col("value") <= float("inf"))
    held = long.groupBy(F.window(ts, width).alias("window"), "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("value", F.lit(sketch)).alias("sketch"))
    rank, rows = F.lit(None).cast("double"), F.lit(None).cast("long")
    for row in profile.collect():  # a row a column, with as many points as the profile has
        places = [x for p in row["points"] for x in (math.nextafter(p["value"], -math.inf), p["value"])]
        shares = [x for p in row["points"] for x in (p["below"], p["upto"])]
        seen = F.kll_sketch_get_rank_double("sketch", F.lit(places))
        apart = F.array_max(F.zip_with(seen, F.lit(shares), lambda a, b: F.abs(a - b)))
        here = F.col("feature") == row["feature"]
        rank, rows = F.when(here, apart).otherwise(rank), F.when(here, F.lit(row["rows"])).otherwise(rows)
    found = held.withColumns({"ks_statistic": rank, "baseline_rows": rows}).where(F.col("baseline_rows").isNotNull())
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "feature", "rows", "ks_statistic",
                        ks_pvalue(F.col("ks_statistic"), F.col("baseline_rows"), F.col("rows")).alias("ks_pvalue"))
