"""Whole jobs: prepare, train and evaluate, score, watch for drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.operators import boosting, clean, drift, evaluate, features, models
from tallyward.operators.recipe import Recipe, fit_recipe
from tallyward.operators.split import hash_fold, hash_split, is_test
from tallyward.operators.staging import released
from tallyward.sources import readers, writers

TARGET = "log_total_costs"
# Numbers that name something and are no features.
IDS = ("order_no", "permanent_facility_id")


def prepare(rows: DataFrame, key: str, out: str, test_size: float = 0.2, seed: int = 42) -> None:
    """Clean, derive features, split and write. What is fitted comes from the train part."""
    cleaned = clean.clean_discharges(rows, fit_where=~is_test(key, test_size, seed)).drop(*IDS)
    writers.write_split(features.engineer_features(cleaned), out, TARGET, key, test_size, seed)


def train(spark: SparkSession, prepared: str, out: str, numeric: list[str] | None = None, categories: list[str] | None = None,
          recipe: dict | None = None, **settings) -> DataFrame:
    """Train on the train part, save the recipe and the model with its figures, and return the metrics of both parts.

    Features are all numeric columns, or ``numeric``, and ``categories`` (by default the text columns); ``recipe`` holds further arguments of
    ``fit_recipe``, such as scaling, means of the target or the number of features to select.
    """
    rows = writers.read_split(spark, prepared)
    if numeric is None:
        numeric = models.feature_names(rows, "target")
    if categories is None:
        categories = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string" and f.name not in ("split", *V.LEAKAGE)]
    fitted = fit_recipe(rows.where("split = 'train'"), numeric, categories, "target", **(recipe or {}))
    fitted.save(f"{out}/recipe", spark)
    # The prepared rows have no key; a digest of the row stands for it.
    keyed = rows.withColumn("_key", F.xxhash64(*rows.columns)).where(F.col("target").isNotNull())
    table = released(fitted.apply(keyed, "_key", "split", "target"), "model-rows")
    model = boosting.fit(table.where("split = 'train'"), fitted.features, "_key", "target", **settings)
    scored = model.transform(table).select("split", "target", models.PREDICTION)
    found = evaluate.metrics(scored, "target", models.PREDICTION, ["split"])
    facts = {f"{r['split']}_{r['metric']}": r["value"] for r in found.collect()}
    models.save(model, out, facts, spark)
    return found


def predict(spark: SparkSession, model_path: str, rows: DataFrame, inverse: bool = True, name: str = "predicted_cost") -> DataFrame:
    """``rows``, a table or a stream of raw columns, with the predictions of a saved recipe and model."""
    model, _ = models.load(model_path, spark)
    fitted = Recipe.load(f"{model_path}/recipe", spark)
    kept = [c for c in rows.columns if c != name]
    packed = rows.withColumn("_row", F.struct(*[rows[c] for c in kept]))
    features = fitted.apply(packed, "_row")
    scored = models.score(model, features, inverse, name)
    return scored.select("_row.*", name)


def score(spark: SparkSession, model_path: str, rows: DataFrame, out: str, inverse: bool = True) -> DataFrame:
    """Score rows, write them with ``predicted_cost`` and return a summary of the predictions."""
    writers.write_file(predict(spark, model_path, rows, inverse), out, "parquet")
    return evaluate.prediction_summary(readers.read_file(spark, out, "parquet"), "predicted_cost")


def watch(baseline: DataFrame, current: DataFrame, out: str, threshold: float = V.PSI_DRIFT) -> DataFrame:
    """Write the verdict per column as CSV and the summary as JSON; return the summary."""
    spark = baseline.sparkSession
    writers.write_file(drift.detect(baseline, current, threshold), f"{out}/results", "csv")
    results = readers.read_file(spark, f"{out}/results", "csv", schema=(
        "feature string, drift_detected boolean, psi double, ks_statistic double, ks_pvalue double, "
        "baseline_mean double, current_mean double, baseline_std double, current_std double"))
    found = drift.summary(results, threshold)
    writers.write_file(found, f"{out}/summary", "json")
    return found


def model_table(rows: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, list[str]]:
    """Staged rows with the split, the model's features and the label; a tenth of the train rows are marked ``stopping``."""
    engineered = features.engineer_features(clean.clean_discharges(rows, fit_where=~is_test(key, test_size, seed)))
    names = models.feature_names(engineered, TARGET, drop=IDS)
    table = models.model_rows(hash_split(engineered, key, test_size, seed), TARGET, names, key, "split")
    stopping = hash_fold(table, key, 10, seed + 1, "_tenth").withColumn("stopping", (F.col("split") == "train") & (F.col("_tenth") == 0))
    return released(stopping.drop("_tenth"), "model-rows"), names
