"""Registered queries of splits and evaluation."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from tallyward.operators import evaluate, split
from tallyward.plans.catalog import query
from tallyward.plans.inputs import predicted, rounded
from tallyward.sources.discharges import discharges

_MAPE = "avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)) * 100"


def _explained(share: str, perfect: str) -> str:
    return (f"CASE WHEN count(*) < 2 THEN NULL WHEN min(y) = max(y) THEN CASE WHEN {perfect} THEN 1e0 ELSE 0e0 END "
            f"ELSE 1 - {share} / nullif(var_pop(y), 0) END")


METRICS = {
    "r2_score": _explained("avg((y - yhat) * (y - yhat))", "max(abs(y - yhat)) = 0"),
    "mae": "avg(abs(y - yhat))",
    "rmse": "sqrt(avg((y - yhat) * (y - yhat)))",
    "mape": _MAPE,
    "explained_variance": _explained("var_pop(y - yhat)", "min(y - yhat) = max(y - yhat)"),
    "mean_prediction": "avg(yhat)",
    "mean_actual": "avg(y)",
    "std_prediction": "stddev_pop(yhat)",
    "std_actual": "stddev_pop(y)",
    "mae_percentage": "CASE WHEN avg(y) > 0 THEN avg(abs(y - yhat)) / avg(y) * 100 ELSE 0 END",
    "rmse_percentage": "CASE WHEN avg(y) > 0 THEN sqrt(avg((y - yhat) * (y - yhat))) / avg(y) * 100 ELSE 0 END",
    "median_ae": "quantile_cont(abs(y - yhat), 0.5)",
}
_RMSLE = "sqrt(avg(power(ln(1 + y) - ln(1 + yhat), 2)))"
_WIDTH = "(max(y) - min(y))"
_EXTENDED = METRICS | {
    "root_mean_squared_log_error": _RMSLE,
    "normalized_mean_absolute_error": f"avg(abs(y - yhat)) / {_WIDTH}",
    "normalized_root_mean_squared_error": f"sqrt(avg((y - yhat) * (y - yhat))) / {_WIDTH}",
    "normalized_root_mean_squared_log_error": f"{_RMSLE} / (ln(1 + max(y)) - ln(1 + min(y)))",
    "normalized_median_absolute_error": f"quantile_cont(abs(y - yhat), 0.5) / {_WIDTH}",
}


def _long(columns: dict[str, str], source: str = "predicted", keys: str = "", digits: int = 6) -> str:
    head = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return " UNION ALL ".join(f"SELECT {head}'{m}' AS metric, round({x}, {digits}) AS value FROM {source}{group}"
                              for m, x in columns.items())


@query("""SELECT discharge_key, CASE WHEN CAST('0x' || substr(md5('42-' || discharge_key), 1, 8) AS BIGINT) % 10000 < 2000
  THEN 'test' ELSE 'train' END AS split FROM discharges""")
def split_train_test(spark, sf_dir):
    return split.hash_split(discharges(spark, sf_dir, "discharge_key"), "discharge_key")


@query("""SELECT discharge_key, hospital_county, CASE WHEN place <= round(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT discharge_key, hospital_county, row_number() OVER (PARTITION BY hospital_county ORDER BY md5('42-' || discharge_key)) AS place,
    count(*) OVER (PARTITION BY hospital_county) AS n FROM discharges) AS t""")
def split_stratified(spark, sf_dir):
    return split.stratified_split(discharges(spark, sf_dir, "discharge_key", "hospital_county"),
                                  "hospital_county", "discharge_key")


@query(_long(METRICS))
def eval_metrics(spark, sf_dir):
    return rounded(evaluate.metrics(predicted(spark, sf_dir), "y", "yhat"))


@query(_long(METRICS, "(SELECT exp(y) - 1 AS y, exp(yhat) - 1 AS yhat FROM predicted) AS p", digits=4))
def eval_inverse(spark, sf_dir):
    return rounded(evaluate.metrics(predicted(spark, sf_dir), "y", "yhat", inverse=True), 4)


@query(_long(_EXTENDED))
def eval_extended(spark, sf_dir):
    return rounded(evaluate.metrics(predicted(spark, sf_dir), "y", "yhat", extended=True))


@query(_long(METRICS, keys="split"))
def eval_by_split(spark, sf_dir):
    return rounded(evaluate.metrics(predicted(spark, sf_dir), "y", "yhat", ["split"]))


@query("""SELECT round(corr(a, b), 6) AS spearman FROM (
  SELECT rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS a,
         rank() OVER (ORDER BY yhat) + (count(*) OVER (PARTITION BY yhat) - 1) / 2.0 AS b FROM predicted) AS r""")
def eval_spearman(spark, sf_dir):
    return rounded(evaluate.spearman(predicted(spark, sf_dir), "y", "yhat"))


@query("SELECT discharge_key, round((exp(y) - 1) - (exp(yhat) - 1), 4) AS residual FROM predicted")
def residuals(spark, sf_dir):
    df = evaluate.residuals(predicted(spark, sf_dir), "y", "yhat", inverse=True)
    return rounded(df.select("discharge_key", "residual"), 4)


@query("""WITH e AS (SELECT y - yhat AS x FROM predicted), r AS (SELECT min(x) AS lo, max(x) AS hi FROM e),
  c AS (SELECT greatest(1, least(50, CAST(floor((x - lo) / ((hi - lo) / 50)) AS INT) + 1)) AS bin, count(*) AS n FROM e, r GROUP BY 1)
  SELECT CAST(g.bin AS INT) AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 50), 6) AS low, coalesce(n, 0) AS rows
  FROM (SELECT unnest(range(1, 51)) AS bin) AS g LEFT JOIN c ON c.bin = g.bin, r""")
def residual_histogram(spark, sf_dir):
    return rounded(evaluate.residual_histogram(predicted(spark, sf_dir), "y", "yhat"))


_NORMAL = NormalDist()


@query("SELECT CAST(share AS DOUBLE) AS share, CAST(normal AS DOUBLE) AS normal, residual FROM (" + " UNION ALL ".join(
    f"SELECT {s / 100} AS share, {_NORMAL.inv_cdf(s / 100):.6f} AS normal, "
    f"round(quantile_cont(y - yhat, {s / 100}), 6) AS residual FROM predicted" for s in range(1, 100)) + ") AS q")
def qq_points(spark, sf_dir):
    return rounded(evaluate.qq_points(predicted(spark, sf_dir), "y", "yhat"))


@query("""WITH r AS (SELECT min(y) AS lo, max(y) AS hi FROM predicted)
  SELECT greatest(1, least(20, CAST(floor((y - lo) / ((hi - lo) / 20)) AS INT) + 1)) AS bin, count(*) AS rows,
    round(avg(y), 6) AS mean_actual, round(avg(yhat), 6) AS mean_prediction, round(stddev_pop(yhat), 6) AS std_prediction
  FROM predicted, r GROUP BY 1""")
def predicted_true(spark, sf_dir):
    return rounded(evaluate.predicted_true(predicted(spark, sf_dir), "y", "yhat"))


@query(f"""WITH m AS ({_long(METRICS)}) SELECT m.metric, value, test, CAST(threshold AS DOUBLE) AS threshold,
    CASE WHEN test = '>=' THEN value >= threshold ELSE value <= threshold END AS passed
  FROM m JOIN (VALUES ('r2_score', '>=', 0.8), ('mae', '<=', 0.5), ('rmse', '<=', 0.8), ('mape', '<=', 15.0)) AS t (metric, test, threshold)
  ON t.metric = m.metric""")
def metric_gate(spark, sf_dir):
    found = evaluate.metrics(predicted(spark, sf_dir), "y", "yhat", median=False)
    return rounded(evaluate.gate(found))


_TRAIN = "(SELECT * FROM predicted WHERE split = 'train') AS p"
_TEST = "(SELECT y, yhat + 0.2 AS yhat FROM predicted WHERE split = 'test') AS p"
_PAIR = {m: METRICS[m] for m in ("r2_score", "mae")}


@query(f"""WITH a AS ({_long(_PAIR, _TRAIN)}), b AS ({_long(_PAIR, _TEST)})
  SELECT a.metric, a.value AS baseline, b.value AS current,
    CASE a.metric WHEN 'r2_score' THEN a.value - b.value > 0.05 ELSE b.value > a.value * 1.1 END AS alert
  FROM a JOIN b ON b.metric = a.metric""")
def metric_alert(spark, sf_dir):
    df = predicted(spark, sf_dir)
    train = evaluate.metrics(df.where("split = 'train'"), "y", "yhat", median=False)
    test = df.where("split = 'test'").withColumn("yhat", F.col("yhat") + 0.2)
    return rounded(evaluate.alerts(train, evaluate.metrics(test, "y", "yhat", median=False)))


@query("""SELECT count(*) AS rows, round(avg(p), 4) AS mean, round(quantile_cont(p, 0.5), 4) AS median,
  round(min(p), 4) AS min, round(max(p), 4) AS max FROM (SELECT exp(yhat) - 1 AS p FROM predicted) AS t""")
def score_summary(spark, sf_dir):
    df = predicted(spark, sf_dir).withColumn("predicted_cost", F.expm1("yhat"))
    return rounded(evaluate.prediction_summary(df, "predicted_cost"), 4)


@query(f"""SELECT strftime(discharge_ts, '%Y-%m-%d') AS day, count(*) AS rows, round({METRICS['r2_score']}, 6) AS r2_score,
  round({METRICS['mae']}, 6) AS mae, round({METRICS['rmse']}, 6) AS rmse FROM predicted GROUP BY 1""")
def metrics_by_day(spark, sf_dir):
    df = predicted(spark, sf_dir, "discharge_ts")
    day = F.date_format(F.window("discharge_ts", "1 day")["start"], "yyyy-MM-dd")
    wide = evaluate.wide_metrics(df.withColumn("day", day), "y", "yhat", ["day"], median=False)
    return rounded(wide.select("day", "rows", "r2_score", "mae", "rmse"))
