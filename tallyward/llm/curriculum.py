"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

A source gets a share of all words by weight, at most ``most`` times its own; what is cut off is shared again. Within a
source, documents follow each other in the order of a digest of their key and are taken in whole passes, the last one
only in part, so that the words taken come near the target. Each source has a schedule, its density over training time
``w(t) = 1 + slope * (t - 1/2)`` on [0, 1]. The integral of the schedule is the demand for the source up to ``t``; the
words before a document, as a share of the target, are put through its inverse, which gives the document's
position. Sorting by position gives the training order.

A source is never handled by one task: its documents fall into buckets of the digest, about ``bucket_rows`` rows each if
one source holds all, which are dealt out by source and bucket and summed first, so that running sums are taken within a bucket only. Windows over sources see one row per source,
those over buckets one row per bucket.

NULL texts have no words; documents without words are in no mix (no positions, ``taken`` 0). NULL sources are a source, the
last one. Rows that share a key and a size are interchangeable, and a NULL key is a key like others. An empty table gives
an empty result. Other columns stay; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the sources in code point order, repeating; times of its own size that a source may be repeated.
WEIGHTS, MOST = (5, 2, 1), 3
#: Slope of the schedule for each weight in turn: heavy sources are dense early, light ones late.
SLOPES = (-1.0, 0.0, 1.0)
BUCKET_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ("size", "source_size", "target", "taken", "positions")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
                   slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """Target words and schedule slope for each row of (source, source_size).

    Sources are ranked by the level at which they meet their limit. With the first ``k`` of them at the limit, the
    level of the others follows; the right ``k`` is the first whose next source stays below.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(rank, F.lit(len(values))) + 1)
    weighted = sizes.select("source", "source_size", pick(weights).cast("long").alias("weight"), pick(slopes).alias("slope"))
    order = [(most * F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onwards = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = most * F.col("source_size")
    levels = weighted.withColumn("level", (
        F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))).cast("double") / F.sum("weight").over(onwards))
    fits = F.col("level") * F.col("weight") <= limit
    first = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(every)
    return levels.withColumn("__level", first).select(
        "source", "source_size", "slope",
        F.least(limit.cast("double"), F.coalesce(F.col("__level") * F.col("weight"), F.lit(0.0))).alias("target"))


def inverse_demand(share: Column, slope: Column) -> Column:
    """Time at which the integral of ``1 + slope * (t - 1/2)`` reaches ``share``."""
    start = 1 - slope / 2
    root = (-start + F.sqrt(start * start + 2 * slope * share)) / slope
    return F.when(slope == 0, share).otherwise(root)


def curriculum(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
               most: int = MOST, slopes: tuple[float, ...] = SLOPES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with their size, their source's size and target, the words taken and the position of each copy."""
    docs = docs.drop(*RESULTS)
    # A key that is never NULL, as joins need one.
    named = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    # As many buckets for every source: a number for each would be joined by source, and all rows of a source would lie together.
    buckets = max(1, -(-docs.count() // bucket_rows))
    rows = docs.withColumns({"__source": named, "__digest": digest, "size": n_words(F.col(text))})
    share = F.conv(F.substring("__digest", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("__bucket", F.shiftright(share * F.lit(buckets), 32))
    sums = rows.groupBy("__source", "__bucket").agg(F.sum("size").alias("__sum"))
    name = F.when(F.col("__source") != "", F.expr("substring(__source, 2)")).alias("source")
    totals = sums.groupBy("__source").agg(F.sum("__sum").alias("source_size")).withColumn("source", name)
    targets = source_targets(totals.select("source", "source_size"), weights, most, slopes)
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (sums.withColumn("__offset", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
            .join(targets.withColumn("__source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source"), "__source")
            .select("__source", "__bucket", "__offset", *[F.col(c).alias(f"__{c}") for c in ("source_size", "slope", "target")]))
    within = Window.partitionBy("__source", "__bucket").orderBy("__digest", key, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("__before", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(plan, ["__source", "__bucket"])
              .withColumn("__before", F.col("__before") + F.col("__offset")))
    before, source_size, target, size = (F.col(c) for c in ("__before", "__source_size", "__target", "size"))
    passes = F.floor(target / source_size)
    rest = target - passes * source_size
    copies = F.when(size == 0, 0).otherwise(passes + (before + size / 2 < rest).cast("long"))
    at = lambda n: inverse_demand(F.least((n * source_size + before + size / 2) / target, F.lit(1.0)), F.col("__slope"))
    positions = F.when(F.col("__copies") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1), at)).otherwise(
        F.array().cast("array<double>"))
    return placed.withColumn("__copies", copies.cast("long")).select(
        *[F.col(f"`{c}`") for c in docs.columns], "size", source_size.alias("source_size"), target.alias("target"),
        (size * F.col("__copies")).alias("taken"), positions.alias("positions"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy, sorted by position across the partitions."""
    copies = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange("position").sortWithinPartitions("position")


def in_training_order(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``mixed`` by ranges of the first position, documents that are in no mix last; ``positions`` becomes text, in billionths.

    Documents of one position, such as those in no mix, are dealt out by a hash of the key.
    """
    listed = F.array_join(F.transform("positions", lambda p: F.floor(p * 1_000_000_000).cast("string")), ",")
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    keyed = mixed.withColumns({"__first": first, "__tie": F.xxhash64(key)})
    sorted_ = keyed.repartitionByRange("__first", "__tie").sortWithinPartitions("__first", "__tie")
    return sorted_.withColumn("positions", listed).drop("__first", "__tie")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight,
  [-1.0, 0.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS slope FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
           ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
f AS (
  SELECT arg_min(level, 3 * source_size / weight) AS level FROM l WHERE level * weight <= 3 * source_size),
t AS (
  SELECT w.source, source_size, slope, least((3 * source_size)::DOUBLE, coalesce(f.level * weight, 0.0)) AS target FROM w LEFT JOIN f ON true),
r AS (
  SELECT d.*, source_size, target, slope, coalesce(sum(size) OVER (
    PARTITION BY d.source ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE floor(target / source_size) + CASE WHEN before + size / 2
    < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END END::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, size * copies AS taken,
  array_to_string(list_transform(list_transform(range(copies), lambda n: least((n * source_size + before + size / 2) / target, 1.0)), lambda share:
    floor((CASE WHEN slope = 0 THEN share ELSE (-(1 - slope / 2) + sqrt((1 - slope / 2) * (1 - slope / 2) + 2 * slope * share)) / slope END) * 1000000000)::BIGINT), ',') AS positions
FROM c
"""
