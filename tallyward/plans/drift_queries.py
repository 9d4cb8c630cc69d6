"""Registered queries of drift and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import drift
from tallyward.plans.catalog import query
from tallyward.plans.inputs import drift_pair, predicted, rounded
from tallyward.plans.oracle_tables import EDGE_BIN
from tallyward.session import scratch_path
from tallyward.streaming.drift import start_distance, start_drift

_FIGURES = """round(psi, 6) AS psi, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue,
  round(baseline_mean, 4) AS baseline_mean, round(current_mean, 4) AS current_mean,
  round(baseline_std, 4) AS baseline_std, round(current_std, 4) AS current_std"""
_DIGITS = {"baseline_mean": 4, "current_mean": 4, "baseline_std": 4, "current_std": 4}


def _counts(spark, sf_dir):
    baseline, current = drift_pair(spark, sf_dir)
    return drift.value_counts(drift.both_sides(baseline, current, drift.common_features(baseline, current)))


@query("SELECT feature, round(psi, 6) AS psi FROM psi")
def drift_psi(spark, sf_dir):
    return rounded(drift.psi(_counts(spark, sf_dir)))


@query("SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue FROM ks")
def drift_ks(spark, sf_dir):
    return rounded(drift.ks(_counts(spark, sf_dir)))


@query(f"SELECT feature, drift_detected, {_FIGURES} FROM drift")
def drift_detect(spark, sf_dir):
    return rounded(drift.detect(*drift_pair(spark, sf_dir)), **_DIGITS)


@query("""SELECT (SELECT count(*) FROM drift) AS total_features,
    (SELECT count(*) FILTER (drift_detected) FROM drift) AS drifted_features, CAST(0.1 AS DOUBLE) AS drift_threshold,
    feature, round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'none' WHEN psi <= 0.25 THEN 'minor' ELSE 'significant' END AS band,
    round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue,
    round((current_mean - baseline_mean) * 100 / baseline_mean, 4) AS mean_change
  FROM drift WHERE drift_detected""")
def drift_summary(spark, sf_dir):
    row = drift.summary(drift.detect(*drift_pair(spark, sf_dir)))
    listed = row.select("total_features", "drifted_features", "drift_threshold", F.inline("top_drifted"))
    return rounded(listed.drop("order"), mean_change=4)


_START = "TIMESTAMP '2024-01-08'"


def _windows_sql(closed_only: bool, start: str = "time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01')") -> str:
    closed = ("WHERE week_end <= (SELECT max(ts) - INTERVAL 24 HOUR FROM events)" if closed_only else "")
    return f"""WITH b AS (SELECT value FROM events WHERE ts < {_START}),
  r AS (SELECT min(value) AS lo, max(value) AS hi FROM b),
  e AS (SELECT {EDGE_BIN} AS bin, count(*) AS n FROM b, r GROUP BY 1),
  a AS (SELECT {start} AS week,
          {EDGE_BIN} AS bin, count(*) AS n
        FROM events, r WHERE ts >= {_START} GROUP BY 1, 2),
  w AS (SELECT week, week + INTERVAL '7 days' AS week_end, sum(n) AS rows FROM a GROUP BY week),
  s AS (SELECT w.week, week_end, rows, g.bin,
      CASE WHEN coalesce(e.n, 0) = 0 THEN 0.0001 ELSE CAST(e.n AS DOUBLE) / (SELECT sum(n) FROM e) END AS pe,
      CASE WHEN coalesce(a.n, 0) = 0 THEN 0.0001 ELSE CAST(a.n AS DOUBLE) / rows END AS pa
    FROM w CROSS JOIN (SELECT unnest(range(0, 10)) AS bin) AS g
    LEFT JOIN e ON e.bin = g.bin LEFT JOIN a ON a.week = w.week AND a.bin = g.bin)
  SELECT strftime(week, '%Y-%m-%d') AS window_start, 'value' AS feature, CAST(max(rows) AS BIGINT) AS rows,
    round(sum((pa - pe) * ln(pa / pe)), 6) AS psi FROM s {closed} GROUP BY week"""


def _events(spark, sf_dir):
    # Event time needs a zone for watermarks; the session's zone is UTC.
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "value")


def _profile(spark, sf_dir):
    first = F.col("ts") < F.lit("2024-01-08").cast("timestamp")
    return drift.baseline_profile(_events(spark, sf_dir).where(first), ["value"])


def _by_week(df):
    return rounded(df.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "feature", "rows", "psi"))


@query(_windows_sql(False))
def drift_by_window(spark, sf_dir):
    return _by_week(drift.drift_by_window(_later(spark, sf_dir), _profile(spark, sf_dir), ["value"], "ts", "7 days"))


def _later(spark, sf_dir):
    return _events(spark, sf_dir).where(F.col("ts") >= F.lit("2024-01-08").cast("timestamp"))


@query(_windows_sql(False, "date_trunc('month', ts)::TIMESTAMP"))
def drift_by_month(spark, sf_dir):
    return _by_week(drift.drift_by_window(_later(spark, sf_dir), _profile(spark, sf_dir), ["value"], "ts", "month"))


@query(_windows_sql(False, "date_trunc('day', ts)::TIMESTAMP"))
def drift_by_day(spark, sf_dir):
    return _by_week(drift.drift_by_window(_later(spark, sf_dir), _profile(spark, sf_dir), ["value"], "ts", "1 day"))


@query("""WITH p AS (SELECT CASE WHEN split = 'train' THEN 0 ELSE 1 END AS side, exp(yhat + CASE WHEN split = 'train' THEN 0 ELSE 0.05 END) - 1 AS x FROM predicted),
  r AS (SELECT min(x) AS lo, max(x) AS hi FROM p WHERE side = 0),
  c AS (SELECT greatest(0, least(9, CAST(floor((x - lo) / ((hi - lo) / 10)) AS INT))) AS bin, side, count(*) AS n FROM p, r GROUP BY 1, 2),
  s AS (SELECT g.bin, coalesce((SELECT n FROM c WHERE c.bin = g.bin AND side = 0), 0) AS e, coalesce((SELECT n FROM c WHERE c.bin = g.bin AND side = 1), 0) AS a
        FROM (SELECT unnest(range(0, 10)) AS bin) AS g),
  t AS (SELECT CASE WHEN e = 0 THEN 0.0001 ELSE CAST(e AS DOUBLE) / (SELECT sum(e) FROM s) END AS pe,
          CASE WHEN a = 0 THEN 0.0001 ELSE CAST(a AS DOUBLE) / (SELECT sum(a) FROM s) END AS pa FROM s)
  SELECT 'predicted_cost' AS feature, (SELECT round(sum((pa - pe) * ln(pa / pe)), 4) FROM t) AS psi,
    round(avg(x) FILTER (side = 0), 2) AS baseline_mean, round(avg(x) FILTER (side = 1), 2) AS current_mean FROM p""")
def drift_predictions(spark, sf_dir):
    """Drift of the predicted cost of later rows, raised a little, against that of the rows a model was trained on."""
    df = predicted(spark, sf_dir)
    cost = lambda rows, shift: rows.select(F.expm1(F.col("yhat") + shift).alias("predicted_cost"))
    found = drift.detect(cost(df.where("split = 'train'"), 0.0), cost(df.where("split = 'test'"), 0.05))
    return rounded(found.select("feature", "psi", "baseline_mean", "current_mean"), psi=4, baseline_mean=2, current_mean=2)


@query(_windows_sql(True))
def drift_stream(spark, sf_dir):
    """The same index from a stream of the events; windows that are still open give no row."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
              .select(F.col("ts").cast("timestamp").alias("ts"), "value").where(F.col("ts") >= F.lit("2024-01-08").cast("timestamp")))
    out = scratch_path(spark, "drift")
    running = start_drift(stream, _profile(spark, sf_dir), ["value"], "ts", f"{out}/windows", f"{out}/progress")
    running.awaitTermination()
    return _by_week(spark.read.parquet(f"{out}/windows"))


def _distances_sql(closed_only: bool) -> str:
    closed = "HAVING week + INTERVAL '7 days' <= (SELECT max(ts) - INTERVAL 24 HOUR FROM events)" if closed_only else ""
    return f"""WITH w AS (SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS week, value FROM events WHERE ts >= {_START}),
  u AS (SELECT week, value, 1 AS later FROM w
    UNION ALL SELECT k.week, value, 0 FROM events CROSS JOIN (SELECT DISTINCT week FROM w) AS k WHERE ts < {_START}),
  f AS (SELECT week, later, sum(later) OVER upto / sum(later) OVER whole AS seen,
      (count(*) OVER upto - sum(later) OVER upto) / (count(*) OVER whole - sum(later) OVER whole) AS expected
    FROM u WINDOW whole AS (PARTITION BY week), upto AS (PARTITION BY week ORDER BY value))
  SELECT strftime(week, '%Y-%m-%d') AS window_start, CAST(sum(later) AS BIGINT) AS rows, round(max(abs(seen - expected)), 6) AS exact, TRUE AS within_bound
  FROM f GROUP BY week {closed}"""


def _distance_base(spark, sf_dir):
    return _events(spark, sf_dir).where(F.col("ts") < F.lit("2024-01-08").cast("timestamp"))


def _beside_exact(spark, sf_dir, found):
    """The exact distance of each window, from order statistics, and whether that of the sketch is within its bound."""
    week = F.date_format(F.window("ts", "7 days").start, "yyyy-MM-dd")
    later = _later(spark, sf_dir).select(week.alias("feature"), "value", F.lit(1).alias("side"))
    weeks = [r["feature"] for r in later.select("feature").distinct().collect()]  # a row a week
    base = _distance_base(spark, sf_dir).select(F.explode(F.array(*map(F.lit, weeks))).alias("feature"), "value", F.lit(0).alias("side"))
    exact = drift.ks(drift.value_counts(later.unionByName(base))).select(F.col("feature").alias("window_start"), F.col("ks_statistic").alias("exact"))
    named = found.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "rows", "ks_statistic")
    near = F.abs(F.col("exact") - F.col("ks_statistic")) <= drift.distance_error()
    return rounded(named.join(exact, "window_start").select("window_start", "rows", "exact", near.alias("within_bound")))


@query(_distances_sql(False))
def distance_by_window(spark, sf_dir):
    profile = drift.distance_profile(_distance_base(spark, sf_dir), ["value"])
    return _beside_exact(spark, sf_dir, drift.distance_by_window(_later(spark, sf_dir), profile, ["value"], "ts", "7 days"))


@query(_distances_sql(True))
def distance_stream(spark, sf_dir):
    """The same distances from a stream of the events; windows that are still open give no row."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
              .select(F.col("ts").cast("timestamp").alias("ts"), "value").where(F.col("ts") >= F.lit("2024-01-08").cast("timestamp")))
    out = scratch_path(spark, "distance")
    profile = drift.distance_profile(_distance_base(spark, sf_dir), ["value"])
    start_distance(stream, profile, ["value"], "ts", f"{out}/windows", f"{out}/progress").awaitTermination()
    return _beside_exact(spark, sf_dir, spark.read.parquet(f"{out}/windows"))
