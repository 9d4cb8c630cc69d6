"""Scores of a regression from a table of actual and predicted values."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.functions.bins import closed_left_bin
from tallyward.functions.expr import ratio
from tallyward.operators.order_stats import average_ranks, quantile_rows, quantiles
from tallyward.operators.profile import _range, histogram
from tallyward.operators.staging import stage


def _sums(y: Column, p: Column) -> dict[str, Column]:
    """Aggregates that all metrics but the medians follow from."""
    e = y - p
    return {
        "n": F.count(e),
        "mean_actual": F.avg(y), "mean_prediction": F.avg(p),
        "var_actual": F.var_pop(y), "var_prediction": F.var_pop(p), "var_error": F.var_pop(e),
        "mae": F.avg(F.abs(e)), "mse": F.avg(e * e),
        "mape_share": F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(V.MAPE_FLOOR))),
        "low": F.min(y), "high": F.max(y), "error_low": F.min(e), "error_high": F.max(e),
        "msle": F.avg(F.pow(F.log1p(F.when(y > -1, y)) - F.log1p(F.when(p > -1, p)), F.lit(2.0))),
    }


def _explained(share: Column, perfect: Column) -> Column:
    """A share of the variance of the actual values: of a constant 1 if the prediction is perfect and 0 else, of one row none."""
    constant = F.when(perfect, 1.0).otherwise(0.0)
    return F.when(F.col("n") < 2, None).when(F.col("low") == F.col("high"), constant).otherwise(share)


def _metric_columns() -> dict[str, Column]:
    c = F.col
    positive = c("mean_actual") > 0
    return {
        "r2_score": _explained(1 - ratio(c("mse"), c("var_actual")), c("mse") == 0),
        "mae": c("mae"),
        "rmse": F.sqrt("mse"),
        "mape": c("mape_share") * 100,
        "explained_variance": _explained(1 - ratio(c("var_error"), c("var_actual")), c("error_low") == c("error_high")),
        "mean_prediction": c("mean_prediction"),
        "mean_actual": c("mean_actual"),
        "std_prediction": F.sqrt("var_prediction"),
        "std_actual": F.sqrt("var_actual"),
        "mae_percentage": F.when(positive, ratio(c("mae"), c("mean_actual")) * 100).otherwise(0.0),
        "rmse_percentage": F.when(positive, ratio(F.sqrt("mse"), c("mean_actual")) * 100).otherwise(0.0),
    }


def _extended_columns() -> dict[str, Column]:
    c = F.col
    width = c("high") - c("low")
    return {
        "root_mean_squared_log_error": F.sqrt("msle"),
        "normalized_mean_absolute_error": ratio(c("mae"), width),
        "normalized_root_mean_squared_error": ratio(F.sqrt("mse"), width),
        "normalized_root_mean_squared_log_error":
            ratio(F.sqrt("msle"), F.log1p(F.when(c("high") > -1, c("high"))) - F.log1p(F.when(c("low") > -1, c("low")))),
        "normalized_median_absolute_error": ratio(c("median_ae"), width),
    }


def _prepare(df: DataFrame, actual: str, prediction: str, inverse: bool, keys: list) -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(prediction).cast("double")
    if inverse:
        y, p = F.expm1(y), F.expm1(p)
    df = df.select(*keys, y.alias("_y"), p.alias("_p"))
    return df.where(F.col("_y").isNotNull() & F.col("_p").isNotNull())


def wide_metrics(df: DataFrame, actual: str, prediction: str, keys: list[str] | None = None,
                 inverse: bool = False, median: bool = True, extended: bool = False,
                 exact: bool = True) -> DataFrame:
    """One row of metrics per group. All but the median come from one aggregation; for the median the two columns are staged, so ``df`` is read once."""
    keys = keys or []
    rows = _prepare(df, actual, prediction, inverse, keys)
    if median or extended:
        rows = stage(rows, "errors")
    aggs = [v.alias(k) for k, v in _sums(F.col("_y"), F.col("_p")).items()]
    out = rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)
    columns = _metric_columns()
    if median or extended:
        errors = rows.select(*keys, F.abs(F.col("_y") - F.col("_p")).alias("_e"))
        med = quantiles(errors, "_e", [0.5], ["median_ae"], keys, exact=exact)
        if keys:
            out = out.join(med, keys, "left")
        else:
            out = out.withColumn("median_ae", F.lit(med.first()["median_ae"]).cast("double"))
        columns["median_ae"] = F.col("median_ae")
    if extended:
        columns |= _extended_columns()
    return out.select(*keys, F.col("n").alias("rows"), *[v.alias(k) for k, v in columns.items()])


def long_metrics(wide: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The metrics as rows (metric, value)."""
    names = [c for c in wide.columns if c not in (keys or []) and c != "rows"]
    return wide.unpivot(keys or [], names, "metric", "value")


def metrics(df: DataFrame, actual: str, prediction: str, keys: list[str] | None = None, **options) -> DataFrame:
    return long_metrics(wide_metrics(df, actual, prediction, keys, **options), keys)


def spearman(df: DataFrame, actual: str, prediction: str) -> DataFrame:
    """Correlation of ranks, ties sharing their mean rank.

    Rows are counted per pair of values once; both rankings and the sums come from that table.
    """
    rows = _prepare(df, actual, prediction, False, [])
    pairs = stage(rows.groupBy("_y", "_p").agg(F.count(F.lit(1)).alias("_n")), "pairs")
    ranked = (pairs.join(average_ranks(pairs, "_y", "_ry", F.col("_n")), "_y")
              .join(average_ranks(pairs, "_p", "_rp", F.col("_n")), "_p"))
    # The mean of all ranks, ties or not. Centred before squaring, so that large ranks do not swamp the result.
    total = pairs.agg(F.sum("_n")).first()[0] or 0
    middle = (total + 1) / 2
    n, dx, dy = F.col("_n"), F.col("_ry") - middle, F.col("_rp") - middle
    top, left, right = F.sum(n * dx * dy), F.sum(n * dx * dx), F.sum(n * dy * dy)
    return ranked.agg(ratio(top, F.sqrt(left) * F.sqrt(right)).alias("spearman"))


def residuals(df: DataFrame, actual: str, prediction: str, inverse: bool = False) -> DataFrame:
    y, p = F.col(actual), F.col(prediction)
    if inverse:
        y, p = F.expm1(y), F.expm1(p)
    return df.withColumn("residual", y - p)


def residual_histogram(df: DataFrame, actual: str, prediction: str, bins: int = 50, inverse: bool = False) -> DataFrame:
    return histogram(residuals(df, actual, prediction, inverse), "residual", bins)


def qq_points(df: DataFrame, actual: str, prediction: str, points: int = 99, exact: bool = True) -> DataFrame:
    """Residual quantiles beside those of the standard normal distribution."""
    shares = [(i + 1) / (points + 1) for i in range(points)]
    rows = residuals(df, actual, prediction).select(F.col("residual").cast("double").alias("residual"))
    found = quantile_rows(rows, "residual", shares, exact=exact)
    normal = NormalDist()
    grid = df.sparkSession.createDataFrame(
        [(i, s, normal.inv_cdf(s)) for i, s in enumerate(shares)], "place int, share double, normal double")
    return found.join(F.broadcast(grid), "place").select("share", "normal", F.col("quantile").alias("residual"))


def predicted_true(df: DataFrame, actual: str, prediction: str, bins: int = 20) -> DataFrame:
    """Mean actual and predicted value, and the spread of the predictions, per bin of the actual value."""
    rows = _prepare(df, actual, prediction, False, [])
    lo, hi = _range(rows, "_y")
    return (rows.withColumn("bin", closed_left_bin(F.col("_y"), lo, hi, bins)).groupBy("bin")
            .agg(F.count(F.lit(1)).alias("rows"), F.avg("_y").alias("mean_actual"),
                 F.avg("_p").alias("mean_prediction"), F.stddev_pop("_p").alias("std_prediction"))
            .orderBy("bin"))


def gate(found: DataFrame, limits=V.GATES) -> DataFrame:
    """Compare metric rows with their limits."""
    rows = found.sparkSession.createDataFrame([tuple(x) for x in limits], "metric string, test string, threshold double")
    v, t = F.col("value"), F.col("threshold")
    passed = F.when(F.col("test") == ">=", v >= t).otherwise(v <= t)
    return found.join(F.broadcast(rows), "metric").select(
        "metric", "value", "test", "threshold", F.coalesce(passed, F.lit(False)).alias("passed"))


def alerts(baseline: DataFrame, current: DataFrame, r2_drop: float = V.R2_DROP_ALERT,
           mae_rise: float = V.MAE_RISE_ALERT) -> DataFrame:
    """Metrics of two runs side by side; an alert where r2 fell or the error rose too much."""
    both = baseline.select("metric", F.col("value").alias("baseline")).join(
        current.select("metric", F.col("value").alias("current")), "metric")
    b, c = F.col("baseline"), F.col("current")
    bad = (F.when(F.col("metric") == "r2_score", b - c > r2_drop)
           .when(F.col("metric") == "mae", c > b * (1 + mae_rise)))
    return both.where(F.col("metric").isin("r2_score", "mae")).withColumn("alert", F.coalesce(bad, F.lit(False)))


def prediction_summary(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """Count, mean, median, smallest and largest of the predictions."""
    rows = df.select(F.col(column).cast("double").alias("_p")).where(F.col("_p").isNotNull())
    median = quantiles(rows, "_p", [0.5], ["median"], exact=exact).first()["median"]
    return rows.agg(F.count("_p").alias("rows"), F.avg("_p").alias("mean"),
                    F.lit(median).cast("double").alias("median"), F.min("_p").alias("min"), F.max("_p").alias("max"))
