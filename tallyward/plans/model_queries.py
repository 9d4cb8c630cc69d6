"""Registered queries of training, tuning, scoring and logging.

Models have the defaults of ``values.MODEL``, searches all of ``values.GRID`` or 50 draws from ``values.RANGES`` and five folds.
Every query reads the whole table.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.operators import boosting, evaluate, models
from tallyward.operators.models import PREDICTION
from tallyward.operators.recipe import Recipe, fit_recipe
from tallyward.operators.split import hash_split
from tallyward.operators.staging import released
from tallyward.operators.tree_growth import LOSSES
from tallyward.plans import jobs
from tallyward.plans.catalog import query
from tallyward.plans.inputs import AMOUNTS, predicted, rounded, typed
from tallyward.plans.source_queries import REQUEST_ROW, requests
from tallyward.session import scratch_path
from tallyward.sources import readers, writers
from tallyward.sources.discharges import discharges
from tallyward.streaming import prediction_log as log

_KEY = "discharge_key"
_RAW = ("discharge_key", *AMOUNTS, "age_group", "apr_severity_of_illness_description", "apr_risk_of_mortality",
        "type_of_admission", "emergency_department_indicator")


def _table(spark, sf_dir):
    return jobs.model_table(discharges(spark, sf_dir, *_RAW), "discharge_key")


def _train(table):
    return table.where("split = 'train'")


def _scores(model, table):
    scored = model.transform(table).select("split", "label", PREDICTION)
    return rounded(evaluate.wide_metrics(scored, "label", PREDICTION, ["split"], median=False)
                   .select("split", "rows", "r2_score", "mae", "rmse", "mape"))


@query(None)
def train_gbt(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    return _scores(boosting.fit(_train(table), names, _KEY), table)


@query(None)
def train_gbt_early_stop(spark, sf_dir):
    """A tenth of the train rows decides when to stop; the test rows take no part."""
    table, names = _table(spark, sf_dir)
    return _scores(boosting.fit(_train(table), names, _KEY, stop=F.col("stopping")), table)


@query(None)
def train_robust(spark, sf_dir):
    """Boosted trees under each loss, scored on both parts."""
    table, names = _table(spark, sf_dir)
    blocks = boosting.make_blocks(_train(table), names, _KEY)
    units = [boosting.Unit(boosting.Settings(loss=loss)) for loss in LOSSES]
    parts = []
    for loss, unit, fitted in zip(LOSSES, units, boosting.fit_units(blocks, units)):
        model = boosting.Model(blocks.binning, unit.settings, fitted.begin, fitted.trees)
        parts.append(_scores(model, table).select(F.lit(loss).alias("loss"), "*"))
    return functools.reduce(DataFrame.unionByName, parts)


@query(None)
def train_leaf_wise(spark, sf_dir):
    """Trees that grow their best leaf first, with a limit of leaves and a regularised gain, scored on both parts."""
    table, names = _table(spark, sf_dir)
    return _scores(boosting.fit(_train(table), names, _KEY, **V.LEAF_WISE), table)


_NUMBERS, _CATEGORIES = ["length_of_stay", "total_charges", "birth_weight"], ["age_group", "type_of_admission", "hospital_county", "ccsr_diagnosis_description"]
_RECIPE = {"scaled": _NUMBERS[:2], "marked": _NUMBERS[2:], "means": ["hospital_county"], "max_categories": 20}


def _recipe_rows(spark, sf_dir):
    rows = typed(spark, sf_dir, _KEY, *_NUMBERS, *_CATEGORIES, "total_costs").where("total_costs > 0")
    return released(hash_split(rows.withColumn("target", F.log1p("total_costs")).drop("total_costs"), _KEY), "recipe-rows")


_ADMISSIONS = ("Elective", "Emergency", "Urgent")


def _dummy_sql(column: str, values) -> str:
    return ", ".join(f"CAST(coalesce({column} = '{v}', FALSE) AS DOUBLE) AS {n}" for v, n in values)


@query(f"""WITH rows AS (SELECT *, ln(1 + total_costs) AS target,
    CAST('0x' || substr(md5('42-' || discharge_key), 1, 8) AS BIGINT) % 10000 >= 2000 AS fit FROM typed WHERE total_costs > 0),
  train AS (SELECT * FROM rows WHERE fit),
  filled AS (SELECT coalesce(length_of_stay, (SELECT avg(length_of_stay) FROM train)) AS stay, coalesce(total_charges, (SELECT avg(total_charges) FROM train)) AS charges FROM train),
  scale AS (SELECT avg(stay) AS s0, stddev_pop(stay) AS s1, avg(charges) AS c0, stddev_pop(charges) AS c1 FROM filled),
  places AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS place FROM (SELECT DISTINCT ccsr_diagnosis_description AS d FROM train)),
  county AS (SELECT hospital_county AS h, avg(target) AS mean FROM train WHERE hospital_county IS NOT NULL GROUP BY 1)
  SELECT discharge_key, round((coalesce(length_of_stay, (SELECT avg(length_of_stay) FROM train)) - s0) / s1, 6) AS length_of_stay,
    round((coalesce(total_charges, (SELECT avg(total_charges) FROM train)) - c0) / c1, 6) AS total_charges,
    round(coalesce(birth_weight, (SELECT avg(birth_weight) FROM train)), 6) AS birth_weight, CAST(birth_weight IS NULL AS DOUBLE) AS birth_weight_missing,
    {_dummy_sql("age_group", [("18-29", "age_group_18_29"), ("30-49", "age_group_30_49"), ("50-69", "age_group_50_69"), ("70 or Older", "age_group_70_or_Older"), ("70+", "age_group_70_")])},
    {_dummy_sql("type_of_admission", [(v, f"type_of_admission_{v}") for v in _ADMISSIONS])},
    round(coalesce(mean, (SELECT avg(target) FROM train)), 6) AS hospital_county_mean, CAST(coalesce(place, -1) AS DOUBLE) AS ccsr_diagnosis_description_code
  FROM rows CROSS JOIN scale LEFT JOIN county ON h = hospital_county LEFT JOIN places ON d = ccsr_diagnosis_description""")
def recipe_features(spark, sf_dir):
    """All rows through a recipe that was fitted on the train part and saved."""
    rows = _recipe_rows(spark, sf_dir)
    path = scratch_path(spark, "recipe")
    fit_recipe(_train(rows), _NUMBERS, _CATEGORIES, "target", **_RECIPE).save(path, spark)
    return rounded(Recipe.load(path, spark).apply(rows, _KEY))


@query("""SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM typed WHERE total_costs > 0
  UNION ALL SELECT 'largest_difference', 0.0 UNION ALL SELECT 'unscored', 0.0""")
def recipe_stream(spark, sf_dir):
    """A saved recipe and model score raw rows as a table and as a stream: rows, and how far the two are apart."""
    rows = _recipe_rows(spark, sf_dir)
    path, out = scratch_path(spark, "model"), scratch_path(spark, "scored")
    rows.drop(_KEY).write.partitionBy("split").parquet(f"{path}/prepared/rows")
    jobs.train(spark, f"{path}/prepared", path, _NUMBERS, _CATEGORIES, {**_RECIPE, "best": 8})
    rows.drop("target", "split").write.parquet(f"{out}/raw")
    raw = spark.read.parquet(f"{out}/raw")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 3).parquet(f"{out}/raw")
    (jobs.predict(spark, path, stream).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress")
     .trigger(availableNow=True).start().awaitTermination())
    streamed = spark.read.parquet(f"{out}/rows").select(_KEY, F.col("predicted_cost").alias("q"))
    both = jobs.predict(spark, path, raw).select(_KEY, F.col("predicted_cost").alias("p")).join(streamed, _KEY, "full")
    apart = F.when(F.col("p").isNotNull() & F.col("q").isNotNull(), F.abs(F.col("p") - F.col("q"))).otherwise(F.lit(1.0))
    found = both.agg(F.count(F.lit(1)).cast("double").alias("rows"), F.max(apart).alias("largest_difference"), F.count_if(F.col("q").isNull()).cast("double").alias("unscored"))
    return rounded(found.unpivot([], ["rows", "largest_difference", "unscored"], "metric", "value"))


@query(None)
def train_rf(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    return _scores(models.fit(models.forest(names, max_depth=None), _train(table), key=_KEY), table)


@query(None)
def score_ensemble(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    pair = [boosting.fit(_train(table), names, _KEY, **settings) for settings in (V.LEAF_WISE, V.LEVEL_WISE)]
    return rounded(models.weighted_vote(pair, table).select("discharge_key", "split", "label", PREDICTION))


@query("""SELECT discharge_key, round((0.538 * yhat + 0.462 * ln(1 + 0.5 * exp(yhat))) / (0.538 + 0.462), 6) AS vote FROM predicted""")
def vote_scores(spark, sf_dir):
    """The weighted vote over two score columns."""
    scored = predicted(spark, sf_dir).withColumn("second", F.log1p(F.lit(0.5) * F.exp("yhat")))
    return rounded(models.vote(scored, ["yhat", "second"], name="vote").select(_KEY, "vote"))


@query(None)
def cv_scores(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    return rounded(models.fold_scores(_train(table), names, _KEY))


def _search(spark, sf_dir, candidates):
    table, names = _table(spark, sf_dir)
    _, found = models.search(candidates, _train(table), names, _KEY)
    return rounded(found)


@query(None)
def tune_grid(spark, sf_dir):
    return _search(spark, sf_dir, models.grid())


@query(None)
def tune_random(spark, sf_dir):
    return _search(spark, sf_dir, models.draws())


@query(None)
def feature_importance(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    model = boosting.fit(_train(table), names, _KEY)
    return rounded(models.native_importance(model, names, spark))


@query(None)
def permutation_importance(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    model = boosting.fit(_train(table), names, _KEY)
    return rounded(models.permutation_importance(model, table.where("split = 'test'"), names, "discharge_key"))


@query(None)
def score_batch(spark, sf_dir):
    table, names = _table(spark, sf_dir)
    model = boosting.fit(_train(table), names, _KEY)
    path = scratch_path(spark, "scored")
    writers.write_file(models.score(model, table), path, "parquet")
    return rounded(readers.read_file(spark, path, "parquet").select("discharge_key", "predicted_cost"), 4)


@query("""SELECT split, count(*) AS rows, CAST(0 AS BIGINT) AS unscored, CAST(0 AS BIGINT) AS below_zero
  FROM (SELECT CASE WHEN CAST('0x' || substr(md5('42-' || discharge_key), 1, 8) AS BIGINT) % 10000 < 2000 THEN 'test' ELSE 'train' END AS split
    FROM typed WHERE total_costs > 0) GROUP BY split""")
def score_batch_rows(spark, sf_dir):
    """The rows of a batch that was scored and written: how many there are, without a score, and with one below zero."""
    rows = _recipe_rows(spark, sf_dir)
    fitted = fit_recipe(_train(rows), _NUMBERS, _CATEGORIES, "target", **_RECIPE)
    table = released(fitted.apply(rows, _KEY, "split", "target"), "model-rows")
    path = scratch_path(spark, "scored")
    writers.write_file(models.score(boosting.fit(_train(table), fitted.features, _KEY, "target"), table), path, "parquet")
    back = readers.read_file(spark, path, "parquet").groupBy("split")
    return back.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("predicted_cost").isNull()).alias("unscored"),
                    F.count_if(F.col("predicted_cost") < 0).alias("below_zero"))


@query("SELECT 'largest_difference' AS metric, CAST(0 AS DOUBLE) AS value UNION ALL SELECT 'train_r2_difference', CAST(0 AS DOUBLE)")
def model_roundtrip(spark, sf_dir):
    """How far a saved model, its predictions and its figures, is from the loaded one."""
    table, names = _table(spark, sf_dir)
    model = boosting.fit(_train(table), names, _KEY)
    path, r2 = scratch_path(spark, "model"), models.r2(model.transform(_train(table)))
    models.save(model, path, {"train_r2": r2}, spark)
    loaded, facts = models.load(path, spark)
    both = loaded.transform(model.transform(table).withColumnRenamed(PREDICTION, "p")).select(_KEY, "p", F.col(PREDICTION).alias("q"))
    # Rows meet by their key. A key that no other row has meets itself where it stands, so only repeated keys are joined; a row without one counts as a difference.
    digest = F.xxhash64(_KEY).alias("digest")
    often = table.where(F.col(_KEY).isNotNull()).groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    repeated = released(both.select("*", digest).join(often, "digest", "left_semi"), "repeated")
    met = repeated.select(_KEY, "p").join(repeated.select(_KEY, "q"), _KEY)
    difference = F.coalesce(F.abs(F.col("p") - F.col("q")), F.lit(1.0))
    apart = both.select(F.when(F.col(_KEY).isNull(), 1.0).otherwise(difference).alias("d")).unionByName(met.select(difference.alias("d"))).agg(F.max("d").alias("value"))
    figures = facts.where("metric = 'train_r2'").select(F.lit("train_r2_difference").alias("metric"), F.abs(F.col("value") - F.lit(r2)).alias("value"))
    return rounded(apart.select(F.lit("largest_difference").alias("metric"), "value").unionByName(figures))


_INPUTS = ["length_of_stay", "total_charges"]


def _request_model(spark, sf_dir):
    """A model of the two columns that requests carry."""
    rows = typed(spark, sf_dir, _KEY, *_INPUTS, "total_costs").where("total_costs > 0")
    rows = models.model_rows(rows.withColumn("log_costs", F.log1p("total_costs")), "log_costs", _INPUTS, _KEY)
    return boosting.fit(released(rows, "request-rows"), _INPUTS, _KEY)


@query(None)
def json_score(spark, sf_dir):
    model = _request_model(spark, sf_dir)
    parsed = readers.parse_requests(requests(spark, sf_dir), "request", REQUEST_ROW, ["order_no"])
    # Malformed requests pass through with the others, so that requests are read once and stay with their order.
    scored = models.score(model, parsed).withColumn("predicted_cost", F.when(F.col("error").isNull(), F.round("predicted_cost", 4)))
    return readers.respond(scored, ["order_no"], "predicted_cost")


@query("""SELECT order_no, CASE WHEN order_no % 29 <> 0 THEN CAST(count(*) AS INT) END AS predictions,
  CASE WHEN order_no % 29 = 0 THEN 'malformed request' END AS error FROM typed GROUP BY order_no""")
def json_score_rows(spark, sf_dir):
    """What each response holds: the number of its predictions, or its error."""
    found = json_score(spark, sf_dir)
    read = F.from_json("response", "predictions array<double>, error string")
    return found.select("order_no", read.alias("r")).select(
        "order_no", F.when(F.col("r.predictions").isNotNull(), F.size("r.predictions")).alias("predictions"), F.col("r.error").alias("error"))


@query("""SELECT strftime(discharge_ts, '%Y-%m') AS period, count(*) AS rows, round(sum(total_charges), 2) AS charges,
  CAST(0 AS BIGINT) AS unscored FROM typed GROUP BY 1""")
def prediction_log(spark, sf_dir):
    """Rows scored as a stream and logged by month; the predictions are checked to be there."""
    model = _request_model(spark, sf_dir)
    landed = scratch_path(spark, "arriving")
    typed(spark, sf_dir, "discharge_key", "discharge_ts", *_INPUTS).write.parquet(landed)
    schema = spark.read.parquet(landed).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(landed)
    out = scratch_path(spark, "log")
    log.start_log(models.score(model, stream), "discharge_ts", f"{out}/rows", f"{out}/progress",
                  period="yyyy-MM").awaitTermination()
    back = log.read_log(spark, f"{out}/rows").groupBy("period")
    return rounded(back.agg(F.count(F.lit(1)).alias("rows"), F.sum("total_charges").alias("charges"),
                            F.count_if(F.col("predicted_cost").isNull()).alias("unscored")), 2)
