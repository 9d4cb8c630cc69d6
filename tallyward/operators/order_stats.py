"""Exact order statistics without a global sort in one task, on one path for every size.

Rows are first reduced to counts per group and distinct value, which combines on the map side, so a hot value or a hot group
costs nothing extra. The counts are dealt to partitions by ranges of (group, value), whose bounds the engine samples from
the rows, so that partitions are of like size however the values lie. They are staged with the number of their
partition. Totals per group and partition give each partition its offset, a few numbers per group; only values of one
partition are ordered together.

Quantiles need few values, so these are found first: rows are counted by buckets of value, a bucket for each ``1 / BUCKETS`` of a doubling,
and only values of buckets that hold a wanted place are counted one by one and ordered. What is read of the other rows is their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.staging import stage

#: Buckets of values between 1 + |x| and its double.
BUCKETS = 512


def bucket_of(value: str) -> Column:
    """A whole number that never falls as the value grows; NULL for NULL and NaN."""
    x = F.col(value).cast("double")
    size = F.floor(F.least(F.log2(F.abs(x) + 1) * BUCKETS, F.lit(1e9)))
    return F.when(x <= float("inf"), F.when(x < 0, -size).otherwise(size))


def _clean(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    # NaN sorts above infinity, so this one test drops both NaN and NULL.
    ok = F.col(value) <= F.lit(float("inf"))
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return df.where(ok)


def ranged_counts(df: DataFrame, value: str, keys: list[str], weights: dict[str, Column]) -> DataFrame:
    """One row per group and distinct value with its weights and ``_part``, the number of its range partition."""
    counts = df.groupBy(*keys, value).agg(*[F.sum(w).alias(name) for name, w in weights.items()])
    return stage(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "counts")


def part_offsets(ranged: DataFrame, keys: list[str], weights) -> DataFrame:
    """Totals per group and partition, with the sums over the partitions before it and over the group."""
    totals = ranged.groupBy(*keys, "_part").agg(*[F.sum(w).alias(f"_{w}_part") for w in weights])
    # One row for each partition that a group touches.
    group = Window.partitionBy(*keys)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cols = [c for w in weights for c in (
        f"_{w}_part", F.coalesce(F.sum(f"_{w}_part").over(before), F.lit(0)).alias(f"_{w}_off"),
        F.sum(f"_{w}_part").over(group).alias(f"{w}_total"))]
    return totals.select(*keys, "_part", *cols)


def cumulative_counts(df: DataFrame, value: str, keys: list[str] | None = None,
                      weights: dict[str, Column] | None = None) -> DataFrame:
    """One row per group and distinct value: weights, their sums over smaller values, group totals.

    Rows with a NULL key or value are left out.
    """
    keys = keys or []
    weights = weights or {"n": F.lit(1).cast("long")}
    return cumulated(ranged_counts(_clean(df, value, keys), value, keys, weights), value, keys, weights)


def cumulated(ranged: DataFrame, value: str, keys: list[str], weights) -> DataFrame:
    """``cumulative_counts`` of what ``ranged_counts`` gave."""
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"_{w}_in": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
    joined = local.join(part_offsets(ranged, keys, weights), [*keys, "_part"])
    out = []
    for w in weights:
        out += [F.col(w), (F.col(f"_{w}_off") + F.col(f"_{w}_in")).alias(f"{w}_before"), F.col(f"{w}_total")]
    return joined.select(*keys, value, *out)


def quantile_rows(df: DataFrame, value: str, shares: list[float], keys: list[str] | None = None,
                  exact: bool = True, weight: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles as rows (keys, place, quantile), place counting the shares.

    Only the values of partitions that hold a wanted place are ordered. ``exact=False`` settles for a sketch. With ``weight`` a row
    stands for so many; weights of one value may be given in parts, negative ones too.
    """
    keys = keys or []
    df = _clean(df, value, keys)
    points = [float(p) for p in shares]
    if not exact:
        values = F.percentile_approx(F.col(value), points, 10_000).alias("_q")
        grouped = df.groupBy(*keys).agg(values) if keys else df.agg(values)
        return grouped.select(*keys, F.posexplode("_q").alias("place", "quantile"))
    one = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*keys, F.col(value).cast("double").alias(value), one.cast("long").alias("_one"))
    buckets = stage(rows.groupBy(*keys, bucket_of(value).alias("_bucket")).agg(F.sum("_one").alias("n")), "buckets")
    return narrowed_quantiles(rows, buckets, value, points, keys)


def narrowed_quantiles(rows: DataFrame, buckets: DataFrame, value: str, points: list[float], keys: list[str]) -> DataFrame:
    """``quantile_rows`` of clean ``rows`` with the weight ``_one``, whose numbers by group and bucket are known."""
    group = Window.partitionBy(*keys)  # a row for each bucket that holds a value
    lower = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    known = buckets.where("n > 0").select(*keys, "_bucket", F.col("n").alias("_n_part"), F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("_n_off"),
                                          F.sum("n").over(group).alias("n_total"))
    held = known.withColumn("_targets", _held_targets(points)).where(F.size("_targets") > 0)
    # Staged, so that the engine knows how few they are before it joins them.
    wanted = stage(held.withColumn("_left_out", F.col("_n_off") - F.coalesce(F.sum("_n_part").over(lower), F.lit(0))), "wanted")
    # Places among the values that are left: those of lower, unwanted buckets do not count.
    places = wanted.select(*keys, "_n_off", "_n_part", "_left_out", F.explode("_targets").alias("_t"))

    def left(name: str) -> Column:
        at = F.col(f"_t.{name}")
        inside = (F.col("_n_off") <= at) & (at < F.col("_n_off") + F.col("_n_part"))
        return F.max(F.when(inside, at - F.col("_left_out"))).alias(name)

    targets = places.groupBy(*keys, F.col("_t.place").alias("place")).agg(left("lo"), left("hi"), F.max("_t.part").alias("part"))
    targets = targets.groupBy(*keys).agg(F.collect_list(F.struct("place", "lo", "hi", "part")).alias("_all"))
    near = rows.withColumn("_bucket", bucket_of(value)).join(wanted.select(*keys, "_bucket"), [*keys, "_bucket"], "left_semi")
    # Staged, as the bounds of the ranges are drawn from it.
    counts = stage(near.groupBy(*keys, value).agg(F.sum("_one").alias("n")), "near")
    ranged = stage(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "counts")
    return quantiles_of(ranged, value, points, keys, targets)


def _held_targets(points: list[float]) -> Column:
    """The places that lie among the ``_n_part`` values after the first ``_n_off`` of ``n_total``."""
    total = F.col("n_total")

    def target(p: Column, i: Column) -> Column:
        at = (total - 1) * p
        return F.struct(i.alias("place"), F.floor(at).alias("lo"), F.ceil(at).alias("hi"), (at - F.floor(at)).alias("part"))

    return F.filter(F.transform(F.array(*map(F.lit, points)), target), _holds)


def _holds(t: Column) -> Column:
    first, end = F.col("_n_off"), F.col("_n_off") + F.col("_n_part")
    return ((first <= t["lo"]) & (t["lo"] < end)) | ((first <= t["hi"]) & (t["hi"] < end))


def quantiles_of(ranged: DataFrame, value: str, points: list[float], keys: list[str], targets: DataFrame | None = None) -> DataFrame:
    """``quantile_rows`` of what ``ranged_counts`` gave with the weight ``n``; values of weight 0 do not count.

    ``targets`` gives each group's places as ``_all`` if they do not follow from the number of its values.
    """
    ranged = ranged.where("n > 0")
    parts = part_offsets(ranged, keys, ["n"])
    if targets is None:
        parts = parts.withColumn("_targets", _held_targets(points))
    else:
        joined = parts.join(targets, keys) if keys else parts.crossJoin(targets)
        parts = joined.withColumn("_targets", F.filter("_all", _holds))
    wanted = parts.where(F.size("_targets") > 0)
    near = ranged.join(wanted.select(*keys, "_part", "_n_off", "_targets"), [*keys, "_part"])
    smaller = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_from", F.col("_n_off") + F.coalesce(F.sum("n").over(smaller), F.lit(0)))
    # Only now, as the rows of a partition must be counted once.
    near = near.select(*keys, value, "n", "_from", F.explode("_targets").alias("_t"))
    start, end = F.col("_from"), F.col("_from") + F.col("n")

    def at(name: str) -> Column:
        return F.max(F.when((start <= F.col(f"_t.{name}")) & (F.col(f"_t.{name}") < end), F.col(value)))

    found = near.groupBy(*keys, F.col("_t.place").alias("place")).agg(
        at("lo").alias("_lo"), at("hi").alias("_hi"), F.max("_t.part").alias("_part"))
    between = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    return found.select(*keys, "place", between.alias("quantile"))


def quantiles(df: DataFrame, value: str, shares: list[float], names: list[str],
              keys: list[str] | None = None, exact: bool = True) -> DataFrame:
    """``quantile_rows`` with one column per share."""
    return wide_quantiles(quantile_rows(df, value, shares, keys, exact), names, keys or [])


def wide_quantiles(rows: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Rows (keys, place, quantile) with one column per place."""
    aggs = [F.max(F.when(F.col("place") == i, F.col("quantile"))).alias(n) for i, n in enumerate(names)]
    return rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)


def melt(df: DataFrame, columns: list[str], ids: list[str] | None = None,
         name: str = "feature", value: str = "value") -> DataFrame:
    """Long form of numeric columns, as doubles."""
    wide = df.select(*(ids or []), *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(ids or [], columns, name, value)


def column_quantiles(df: DataFrame, columns: list[str], shares: list[float],
                     exact: bool = True, cheap: bool = False) -> dict[str, list[float | None]]:
    """Quantiles of several columns at once, as plain numbers (columns x shares of them).

    The columns are staged, as they are read twice, unless the rows are ``cheap`` to read again.
    """
    if not columns:
        return {}
    if exact and not cheap:
        df = stage(df.select(*columns), "columns")
    names = [f"q{i}" for i in range(len(shares))]
    rows = quantiles(melt(df, columns), "value", shares, names, ["feature"], exact).collect()
    found = {r["feature"]: [r[n] for n in names] for r in rows}
    return {c: found.get(c, [None] * len(shares)) for c in columns}


def average_ranks(df: DataFrame, value: str, rank: str, weight: Column | None = None) -> DataFrame:
    """Rank of each distinct value; tied rows share the mean of their places. ``weight`` counts rows, 1 each without it."""
    counts = cumulative_counts(df, value, weights={"n": F.lit(1).cast("long") if weight is None else weight})
    place = F.col("n_before") + (F.col("n") + 1) / 2.0
    return counts.select(value, place.alias(rank))
