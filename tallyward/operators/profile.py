"""Profiles of a table: counts, distributions, grouped statistics, correlations and top lists.

Groups leave NULL keys out unless asked to keep them. Ordered lists break ties by the key.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.bins import closed_left_bin, closed_right_bin
from tallyward.functions.expr import numeric_columns, pearson, ratio
from tallyward.operators.order_stats import bucket_of, column_quantiles, melt, narrowed_quantiles, quantiles, wide_quantiles
from tallyward.operators.staging import stage

#: Rows whose repeats are taken out together, and rows whose different values one task counts.
BLOCK_ROWS, TASK_ROWS = 1 << 16, 500_000

def _rows(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One row per struct of a one-row aggregate."""
    return df.select(F.inline(F.array(*structs)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_info(df: DataFrame) -> DataFrame:
    """Type and filled cells of each column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return _rows(counts, [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("filled"))
                          for c, t in df.dtypes])


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _rows(counts, [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])


def distinct_counts(df: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct values per column, NULL aside.

    The exact form takes the repeats out of blocks of ``BLOCK_ROWS`` rows and deals the values left to so many tasks that each has those of
    ``TASK_ROWS`` rows, so that what a task holds does not grow with the table. Values are told apart by their text.
    """
    if not exact:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        return _rows(counts, [F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in df.columns])
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TASK_ROWS))
    pairs = text.mapInArrow(_distinct_in_blocks, "place int, value string").repartition(tasks, "place", "value").distinct()
    names = F.array(*[F.lit(c) for c in df.columns])
    return pairs.groupBy("place").agg(F.count("value").alias("distinct")).select(names[F.col("place")].alias("column"), "distinct")


def _distinct_in_blocks(batches):
    """The different values of each column (its place), NULL among them, block by block."""

    def values(block):
        for place in range(block[0].num_columns):
            found = pa.chunked_array([batch.column(place) for batch in block]).unique()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), place, np.int32)), found], ["place", "value"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield from values(held)
            held, rows = [], 0
    if rows:
        yield from values(held)


def null_overlap(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows where the first column is NULL, and those of them where the second is NULL too."""
    a, b = F.col(first).isNull(), F.col(second).isNull()
    return df.agg(F.count_if(a).alias("nulls"), F.count_if(a & b).alias("both"))


def value_counts(df: DataFrame, columns: Iterable[str], keep_null: bool = False) -> DataFrame:
    names = list(columns)
    if not keep_null:
        df = df.na.drop(subset=names)
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *names)


def value_counts_ordered(df: DataFrame, column: str, order: Iterable) -> DataFrame:
    """Counts in a given order of the values; values outside the list come last."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))
    counts = counts.withColumn("place", F.when(place > 0, place.cast("int")))
    return counts.orderBy(F.asc_nulls_last("place"), column)


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Counts with their percentage of all counted rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    # The total is one row; every value row carries the same constant key.
    joined = counts.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
    return joined.select(column, "count", (F.col("count") * 100.0 / F.col("_total")).alias("share"))


def group_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias("mean"))
            .orderBy(F.desc_nulls_last("mean"), key))


def group_count_all(df: DataFrame, key: str) -> DataFrame:
    """Filled cells of every other column per group."""
    rest = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.count(c).alias(c) for c in rest])


def group_stats(df: DataFrame, keys: Iterable[str], value: str, exact: bool = True, cheap: bool = False) -> DataFrame:
    """Mean, median and count of a column per group, highest mean first. Rows are staged, as they are read twice, unless they are ``cheap``."""
    names = list(keys)
    df = df.select(*names, F.col(value).cast("double").alias(value)).na.drop(subset=names)
    if not exact:
        basic = df.groupBy(*names).agg(F.avg(value).alias("mean"), F.count(value).alias("rows"))
        median = quantiles(df, value, [0.5], ["median"], names, exact=False)
    else:
        # Mean and count follow from the buckets; a group without values has one of weight 0.
        rows = (df if cheap else stage(df, "rows")).withColumn("_one", F.when(F.col(value) <= float("inf"), 1).otherwise(0).cast("long"))
        known = rows.groupBy(*names, bucket_of(value).alias("_bucket")).agg(F.sum("_one").alias("n"), F.sum(F.when(F.col("_one") > 0, F.col(value))).alias("_sum"))
        known = stage(known, "buckets")
        basic = known.groupBy(*names).agg(ratio(F.sum("_sum"), F.sum("n")).alias("mean"), F.sum("n").alias("rows"))
        median = wide_quantiles(narrowed_quantiles(rows.where("_one > 0"), known, value, [0.5], names), ["median"], names)
    joined = basic.join(median, names, "left")
    return joined.select(*names, "mean", "median", "rows").orderBy(F.desc_nulls_last("mean"), *names)


def group_stats_by_dimension(df: DataFrame, dimensions: list[str], value: str, exact: bool = True) -> DataFrame:
    """``group_stats`` over several columns one by one, from a single melted pass."""
    wide = df.select(F.col(value).cast("double").alias(value), *[F.col(d).cast("string").alias(d) for d in dimensions])
    if exact:
        wide = stage(wide, "wide")  # the melted rows would be as many times larger as there are dimensions
    return group_stats(wide.unpivot([value], dimensions, "dimension", "level"), ["dimension", "level"], value, exact, cheap=True)


def mean_by_dimension(df: DataFrame, dimensions: list[str], value: str) -> DataFrame:
    """Mean and count over several columns one by one, as grouping sets.

    Rolled-up columns are told from NULL keys by the grouping number, and NULL keys are left out.
    """
    size = len(dimensions)
    grouped = df.groupingSets([[F.col(d)] for d in dimensions], *dimensions).agg(
        F.avg(value).alias("mean"), F.count(value).alias("rows"), F.grouping_id().alias("set"))
    # In the number of the set that groups by dimension i, only bit i (from the left) is 0.
    full = (1 << size) - 1
    name, level = None, None
    for i, d in enumerate(dimensions):
        mine = F.col("set") == F.lit(full - (1 << (size - 1 - i)))
        name = F.when(mine, d) if name is None else name.when(mine, d)
        level = F.when(mine, F.col(d).cast("string")) if level is None else level.when(mine, F.col(d).cast("string"))
    return (grouped.select(name.alias("dimension"), level.alias("level"), "mean", "rows")
            .where(F.col("level").isNotNull()))


def pivot_mean(df: DataFrame, row: str, column: str, value: str, values: list[str]) -> DataFrame:
    """Mean per pair of keys, one column per listed value of the second key."""
    return (df.where(F.col(row).isNotNull()).groupBy(row).pivot(column, values).agg(F.avg(value))
            .orderBy(row))


def describe(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Count, mean, deviation, smallest, quartiles and largest of numeric columns."""
    long = melt(df, columns).where(F.col("value").isNotNull())
    basic = long.groupBy("feature").agg(
        F.count("value").alias("rows"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quart = quantiles(long, "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"], ["feature"], exact)
    return basic.join(quart, "feature").select(
        "feature", "rows", "mean", "std", "min", "q1", "median", "q3", "max")


def correlations(df: DataFrame, columns: list[str] | None = None, drop: Iterable[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of columns, over the rows where both are filled."""
    names = [c for c in (columns or numeric_columns(df)) if c not in set(drop)]
    pairs = list(combinations_with_replacement(names, 2))
    row = df.agg(*[pearson(F.col(a), F.col(b)).alias(f"r{i}")
                   for i, (a, b) in enumerate(pairs)])
    out = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            out.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r{i}").alias("r")))
    return _rows(row, out)


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(pearson(F.col(x), F.col(y)).alias("r"))


def _range(df: DataFrame, column: str) -> tuple[Column, Column]:
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return F.lit(row["lo"]).cast("double"), F.lit(row["hi"]).cast("double")


def binned_mean(df: DataFrame, column: str, value: str, bins: int = 10) -> DataFrame:
    """Mean of a column over equal-width, right-closed bins of another."""
    lo, hi = _range(df, column)
    placed = df.withColumn("bin", closed_right_bin(F.col(column).cast("double"), lo, hi, bins))
    return (placed.where(F.col("bin").isNotNull()).groupBy("bin")
            .agg(F.count(F.lit(1)).alias("rows"), F.avg(value).alias("mean"))
            .withColumn("low", lo + (F.col("bin") - 1) * ((hi - lo) / bins))
            .withColumn("high", lo + F.col("bin") * ((hi - lo) / bins)).orderBy("bin"))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """Counts over equal-width, left-closed bins, the last one closed; empty bins count 0."""
    lo, hi = _range(df, column)
    placed = df.select(closed_left_bin(F.col(column).cast("double"), lo, hi, bins).alias("bin"))
    counts = placed.where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1, 1, 1).select(F.col("id").cast("int").alias("bin"))
    full = every.join(counts, "bin", "left")
    return full.select("bin", (lo + (F.col("bin") - 1) * ((hi - lo) / bins)).alias("low"),
                       F.coalesce("n", F.lit(0)).alias("rows")).orderBy("bin")


def box_stats(df: DataFrame, value: str, key: str | None = None, whisker: float = 1.5,
              exact: bool = True) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the fences) and outliers, per group if a key is given."""
    keys = [key] if key else []
    df = df.select(*keys, F.col(value).cast("double").alias(value)).na.drop()
    fences = quantiles(df, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"], keys, exact=exact)
    reach = (F.col("q3") - F.col("q1")) * whisker
    x = F.col(value)
    if key:
        joined = df.join(fences, keys)
    else:
        row = fences.first()
        joined = df.withColumns({c: F.lit(row[c]) for c in ("q1", "median", "q3")})
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    aggs = [
        F.count(F.lit(1)).alias("rows"), F.max("q1").alias("q1"), F.max("median").alias("median"),
        F.max("q3").alias("q3"), F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"), F.count_if(~inside).alias("outliers"),
    ]
    return joined.groupBy(*keys).agg(*aggs).orderBy(*keys) if key else joined.agg(*aggs)


def top_means(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The k groups with the highest mean, with their counts."""
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(value).alias("mean"), F.count(value).alias("rows"))
    return grouped.orderBy(F.desc_nulls_last("mean"), key).limit(k)


def keep_top(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """Rows of the k groups with the highest mean; the list of keys has at most k rows."""
    return df.join(F.broadcast(top_means(df, key, value, k).select(key)), key, "left_semi")


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)
