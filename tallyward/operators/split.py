"""Splits and samples by hash: the same rows in every run, on any number of partitions."""

from __future__ import annotations

from math import ceil, log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))


def hash_number(key: str, seed: int) -> Column:
    """First 32 bits of the row's digest."""
    return F.conv(F.substring(_digest(key, seed), 1, 8), 16, 10).cast("long")


def is_test(key: str, test_size: float = 0.2, seed: int = 42) -> Column:
    return hash_number(key, seed) % 10_000 < round(test_size * 10_000)


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, name: str = "split") -> DataFrame:
    """Mark rows 'test' or 'train'. A narrow projection; the test share is approximate."""
    return df.withColumn(name, F.when(is_test(key, test_size, seed), "test").otherwise("train"))


def hash_fold(df: DataFrame, key: str, folds: int, seed: int = 42, name: str = "fold") -> DataFrame:
    return df.withColumn(name, (hash_number(key, seed) % folds).cast("int"))


#: Rows of a stratum that share the leading digits of their digest, about.
BUCKET_ROWS = 1_000


def stratified_split(df: DataFrame, stratum: str, key: str, test_size: float = 0.2, seed: int = 42,
                     name: str = "split") -> DataFrame:
    """Exactly round(n * test_size) rows of each stratum are 'test'.

    The rows with the smallest digests are taken. Counts per digest prefix tell in which bucket the
    last of them lies, and only that bucket is ordered, so a stratum of any size is no burden for one
    task and the rows themselves are never shuffled. NULL is a stratum of its own.
    """
    rows = df.select(F.struct(F.col(stratum).alias("v")).alias("_stratum"), _digest(key, seed).alias("_digest"))
    digits = max(1, ceil(log(max(df.count(), 1) / BUCKET_ROWS + 1, 16)))
    rows = rows.withColumn("_prefix", F.substring("_digest", 1, digits))
    totals = rows.groupBy("_stratum", "_prefix").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("_stratum")
    so_far = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (totals.select("_stratum", "_prefix", (F.sum("n").over(so_far) - F.col("n")).alias("before"), "n",
                          F.round(F.sum("n").over(whole) * F.lit(test_size)).cast("long").alias("want"))
            .where((F.col("before") < F.col("want")) & (F.col("want") <= F.col("before") + F.col("n"))))
    inside = rows.join(edge, ["_stratum", "_prefix"])
    place = F.row_number().over(Window.partitionBy("_stratum", "_prefix").orderBy("_digest"))
    last = (inside.withColumn("_place", place).where(F.col("_place") == F.col("want") - F.col("before"))
            .select("_stratum", F.col("_digest").alias("_last")))
    marked = df.withColumn("_stratum", F.struct(F.col(stratum).alias("v"))).join(last, "_stratum", "left")
    test = F.coalesce(_digest(key, seed) <= F.col("_last"), F.lit(False))
    return marked.withColumn(name, F.when(test, "test").otherwise("train")).drop("_stratum", "_last")


def sample_rows(df: DataFrame, key: str, n: int = 50_000, seed: int = 42) -> DataFrame:
    """At most n rows, those with the smallest digests.

    The count of rows tells below which number nearly surely n digests lie; only those rows are ordered. Should they be too few, the
    number doubles.
    """
    total, number = df.count(), hash_number(key, seed)
    below = int(2**32 * (n + 6 * sqrt(n) + 30) / max(total, 1)) + 1
    while below < 2**32 and df.where(number < below).count() < min(n, total):
        below *= 2
    few = df.where(number < below) if below < 2**32 else df
    return few.orderBy(_digest(key, seed), key).limit(n)
