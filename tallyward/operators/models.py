"""Tree ensembles for regression: training, tuning, importance and scoring.

Boosted models are those of ``operators.boosting``, small forests are Spark's and larger ones grow from sums over cells there. All have ``transform``, which adds the predictions to a table
or a stream. Training reads its rows many times, so callers pass rows that are cheap to read again, such as a
table written by ``operators.staging.stage``.
"""

from __future__ import annotations

import functools
import itertools
import math
import random
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.functions.expr import numeric_columns
from tallyward.operators import boosting
from tallyward.operators.evaluate import wide_metrics
from tallyward.operators.split import hash_fold
from tallyward.operators.staging import released
from tallyward.session import ensure_checkpoint_dir

PREDICTION = "prediction"
Model = boosting.Model | PipelineModel

# Setting -> parameter of the forest.
_FOREST = {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode", "subsample": "subsamplingRate",
           "random_state": "seed", "max_features": "featureSubsetStrategy", "max_bins": "maxBins"}
_DEEPEST = 30


def _forest_settings(given: dict) -> dict:
    unknown = set(given) - set(_FOREST)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    out = {}
    for key, value in given.items():
        if key == "max_features":
            value = value or "all"
        if key == "max_depth":
            value = _DEEPEST if value is None else value
            if value > _DEEPEST:
                raise ValueError(f"the forest's trees are at most {_DEEPEST} deep")
        out[_FOREST[key]] = value
    return out


def forest(features: Iterable[str], label: str = "label", prediction: str = PREDICTION, **settings) -> Pipeline:
    """Random forest; gaps are filled with the mean of the training rows.

    Executors keep the node of each row in each tree, so that deep trees need not be sent to every pass; that changes no tree.
    """
    names = list(features)
    filled = [f"{c}_filled" for c in names]
    tree = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol=prediction, cacheNodeIds=True,
                                 **_forest_settings({"n_estimators": 50, "random_state": 42, **settings}))
    return Pipeline(stages=[Imputer(inputCols=names, outputCols=filled, strategy="mean"), VectorAssembler(inputCols=filled, outputCol="features"), tree])


def feature_names(df: DataFrame, target: str, drop: Iterable[str] = (), leakage=V.LEAKAGE) -> list[str]:
    """Numeric columns but for the target, the dropped ones and those computed from the target."""
    out = {target, *drop, *leakage}
    return [c for c in numeric_columns(df) if c not in out]


def model_rows(df: DataFrame, target: str, features: Iterable[str], *keep: str) -> DataFrame:
    """Features as doubles and the label, for rows that have one."""
    return df.where(F.col(target).isNotNull()).select(
        *keep, *[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("label"))


#: Rows up to which a forest is grown by Spark's learner.
FOREST_ROWS = 1 << 14


def _tried(strategy: str, features: int) -> int:
    """How many features each split of a forest for regression may choose from."""
    found = {"auto": features / 3, "onethird": features / 3, "all": features, "sqrt": features**0.5, "log2": max(1.0, math.log2(features))}
    if strategy in found:
        return math.ceil(found[strategy])
    return min(features, int(strategy)) if strategy.isdigit() and int(strategy) > 0 else math.ceil(float(strategy) * features)


def fit(pipeline: Pipeline, rows: DataFrame, key: str | None = None) -> Model:
    """Fit a forest.

    Spark's learner exchanges the sums of every node in every pass, so deep trees of many rows do not end. On more than ``FOREST_ROWS`` rows the
    same trees (number, depth, draws with replacement, features tried) are grown from sums over rows of equal bins, if these are few
    enough for a task; their draws go by the ``key``, or by a digest of the row.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    tree = pipeline.getStages()[-1]
    if isinstance(tree, RandomForestRegressor) and tree.getPredictionCol() == PREDICTION and tree.getBootstrap() and rows.count() > FOREST_ROWS:
        names = pipeline.getStages()[0].getInputCols()
        found = boosting.fit_forest(
            rows, names, key, tree.getLabelCol(), tree.getNumTrees(), tree.getMaxBins(), tree.getSeed(), max_depth=tree.getMaxDepth(),
            min_samples_leaf=tree.getMinInstancesPerNode(), subsample=tree.getSubsamplingRate(), max_features=_tried(tree.getFeatureSubsetStrategy(), len(names)))
        if found is not None:
            return found
    return pipeline.fit(rows)


def r2(rows: DataFrame, label: str = "label", prediction: str = PREDICTION) -> float:
    return wide_metrics(rows, label, prediction, median=False).first()["r2_score"]


def fold_scores(rows: DataFrame, features: list[str], key: str, folds: int = 5, seed: int = 42, **settings) -> DataFrame:
    """Score of each fold by a boosted model trained on the others, with their mean and spread.

    The folds are made by hash, so they are the same on every run. All models grow in the same passes.
    """
    marked = hash_fold(rows, key, folds, seed, "_fold")
    scores = boosting.cross_validate(marked, features, key, [settings], F.col("_fold"), folds)[0]
    found = rows.sparkSession.createDataFrame(list(enumerate(scores)), "fold int, r2_score double")
    whole = Window.partitionBy()  # one row per fold
    return found.select("fold", "r2_score", F.avg("r2_score").over(whole).alias("mean"),
                        F.stddev_pop("r2_score").over(whole).alias("std"))


def grid(options: dict[str, list] | None = None) -> list[dict]:
    """Every combination of the settings, by default those of ``values.GRID``."""
    options = V.GRID if options is None else options
    return [dict(zip(options, picked)) for picked in itertools.product(*options.values())]


def draws(ranges: dict | None = None, n: int = 50, seed: int = 42) -> list[dict]:
    """Random settings, by default from ``values.RANGES``: whole and real numbers from ranges, anything else from a list."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        picked = {}
        for key, choice in (V.RANGES if ranges is None else ranges).items():
            if isinstance(choice, list):
                picked[key] = rng.choice(choice)
            elif isinstance(choice[0], int):
                picked[key] = rng.randint(*choice)
            else:
                picked[key] = rng.uniform(*choice)
        out.append(picked)
    return out


def search(candidates: list[dict], rows: DataFrame, features: list[str], key: str, folds: int = 5, seed: int = 42, refit: bool = True):
    """Cross-validated search by r2. Returns the refitted best model (None without ``refit``) and a table of all candidates.

    The best one has the greatest mean over its folds, the first of equal ones. Folds without a score do not count.
    """
    marked = hash_fold(rows, key, folds, seed, "_fold")
    scores = boosting.cross_validate(marked, features, key, candidates, F.col("_fold"), folds)
    table = [(i, ", ".join(f"{k}={v}" for k, v in sorted(c.items())), k, score)
             for i, (c, line) in enumerate(zip(candidates, scores)) for k, score in enumerate(line)]
    by_fold = rows.sparkSession.createDataFrame(table, "candidate int, settings string, fold int, r2_score double")
    found = by_fold.groupBy("candidate", "settings").agg(F.avg("r2_score").alias("mean_r2"), F.stddev_pop("r2_score").alias("std_r2"))
    best = found.orderBy(F.desc_nulls_last("mean_r2"), "candidate").first()["candidate"]
    model = boosting.fit(rows, features, key, **candidates[best]) if refit else None
    return model, found.withColumn("best", F.col("candidate") == best)


def native_importance(model: Model, features: Iterable[str], spark, top: int | None = None) -> DataFrame:
    weights = model.importances() if isinstance(model, boosting.Model) else model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(list(features), weights)), "feature string, importance double")
    ordered = rows.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)


#: Rows that one partition of a random order holds, about.
_PART_ROWS = 100_000


def _in_random_order(rows: DataFrame, order, *columns) -> DataFrame:
    """The columns with ``_place``, the row's exact place in an order by random numbers and a key.

    Rows are dealt to partitions by equal ranges of the random numbers, counted, and numbered within their partition, so no task
    holds more than a share of them.
    """
    parts = max(1, -(-rows.count() // _PART_ROWS))
    part = F.least(F.floor((F.col("_random") / F.lit(2.0**63) + 1) / 2 * parts), F.lit(parts - 1))
    dealt = rows.withColumn("_random", order).withColumn("_part", part)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_random", "_key"))
    return dealt.withColumn("_inside", inside).join(offsets, "_part").select(*columns, (F.col("_before") + F.col("_inside")).alias("_place"))


def dealt_anew(rows: DataFrame, features: Iterable[str], key: str, *keep: str, seed: int = 42) -> DataFrame:
    """``keep`` and the features of each row, and as ``_other`` the features of any row of the whole table.

    Two random orders are joined by place, so every row's values go to exactly one row.
    """
    names = list(features)
    rows = rows.withColumn("_key", F.xxhash64(F.col(key)))  # it only parts equal random numbers
    first = _in_random_order(rows, F.xxhash64(F.lit(seed), F.col(key)), *keep, *names)
    second = _in_random_order(rows, F.xxhash64(F.lit(-1 - seed), F.col(key)), F.struct(*names).alias("_other"))
    return first.join(second, "_place").drop("_place")


def _changed_values(model: Model, rows: DataFrame, names: list[str], key: str, repeats: int, seed: int) -> DataFrame:
    """(``feature``, ``repeat``, ``label``, ``prediction``) of one copy of each row per column, with that column changed."""
    scored = []
    for k in range(repeats):
        dealt = dealt_anew(rows, names, key, "label", seed=seed + k)
        copies = [F.struct(F.lit(c).alias("feature"), F.lit(k).alias("repeat"), F.col("label"),
                           *[(F.col(f"_other.{n}") if n == c else F.col(n)).alias(n) for n in names]) for c in names]
        changed = dealt.select(F.inline(F.array(*copies)))
        scored.append(model.transform(changed).select("feature", "repeat", "label", PREDICTION))
    return functools.reduce(DataFrame.unionByName, scored)


def _bins_changed(model: boosting.Model, binned: DataFrame, names: list[str], key: str, repeats: int, seed: int) -> DataFrame:
    """The same for a boosted model, which sees nothing of a row but its bins: these are dealt out anew."""
    dealt = [dealt_anew(binned, ["bins"], key, "label", seed=seed + k).select(F.lit(k).alias("repeat"), "label", "bins", F.col("_other.bins").alias("other"))
             for k in range(repeats)]
    known = model.binning.features
    scored = model.changed(functools.reduce(DataFrame.unionByName, dealt), [known.index(c) if c in known else -1 for c in names])
    return scored.withColumn("feature", F.element_at(F.array(*[F.lit(c) for c in names]), F.col("feature") + 1))


def _changed_bins(model: boosting.Model, rows: DataFrame, names: list[str], key: str, repeats: int, seed: int) -> DataFrame:
    return _bins_changed(model, released(model.binned(rows, key, "label"), "bins"), names, key, repeats, seed)


def permutation_importance(model: Model, rows: DataFrame, features: Iterable[str], key: str,
                           repeats: int = 10, seed: int = 42, top: int | None = None) -> DataFrame:
    """Mean and spread of the loss of r2 when the values of one column are dealt out anew over the whole table.

    Each column keeps its values exactly. Rows need a unique ``key`` for the same result on every run. The exchanges of one repeat are done with before the next one begins.
    """
    names = list(features)
    boosted = isinstance(model, boosting.Model)
    given, changed = (released(model.binned(rows, key, "label"), "bins"), _bins_changed) if boosted else (rows, _changed_values)
    base = r2(model.transform(rows))
    scores = [released(wide_metrics(changed(model, given, names, key, 1, seed + k), "label", PREDICTION, ["feature"], median=False).select("feature", "r2_score"), "repeat")
              for k in range(repeats)]
    drops = functools.reduce(DataFrame.unionByName, scores).select("feature", (F.lit(base) - F.col("r2_score")).alias("drop"))
    found = (drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
             .orderBy(F.desc("importance_mean"), "feature"))
    return found if top is None else found.limit(top)


def score(model: Model, rows: DataFrame, inverse: bool = True, name: str = "predicted_cost") -> DataFrame:
    """All input columns and the prediction, back on the scale of the costs if it was a logarithm."""
    out = model.transform(rows)
    p = F.col(PREDICTION)
    added = out.withColumn(name, F.expm1(p) if inverse else p)
    return added.select(*rows.columns, name)


def vote(df: DataFrame, columns: Iterable[str], weights=V.VOTE_WEIGHTS, name: str = PREDICTION) -> DataFrame:
    """Weighted mean of score columns; NULL where one of them is."""
    pairs = list(zip(columns, weights, strict=True))
    total = sum((F.col(c) * F.lit(float(w)) for c, w in pairs), F.lit(0.0))
    return df.withColumn(name, total / F.lit(float(sum(w for _, w in pairs))))


def weighted_vote(models: list[Model], rows: DataFrame, weights=V.VOTE_WEIGHTS,
                  name: str = PREDICTION) -> DataFrame:
    """Weighted mean of the models' predictions."""
    out, scores = rows, []
    for i, model in enumerate(models):
        keep = out.columns
        out = model.transform(out).select(*keep, F.col(PREDICTION).alias(f"_p{i}"))
        scores.append(f"_p{i}")
    return vote(out, scores, weights, name).drop(*scores)


def save(model: Model, path: str, facts: dict[str, float], spark) -> None:
    """The fitted model, and its figures beside it as JSON rows."""
    if isinstance(model, boosting.Model):
        spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/boosted")
    else:
        model.write().overwrite().save(f"{path}/model")
    rows = spark.createDataFrame([(k, float(v)) for k, v in facts.items()], "metric string, value double")
    rows.coalesce(1).write.mode("overwrite").json(f"{path}/facts")


def load(path: str, spark) -> tuple[Model, DataFrame]:
    facts = spark.read.schema("metric string, value double").json(f"{path}/facts")
    try:
        return boosting.Model.from_json(spark.read.text(f"{path}/boosted").first()["value"]), facts
    except AnalysisException:  # no boosted model was saved there
        return PipelineModel.load(f"{path}/model"), facts
