"""Feature edges, bins, encoders, splits, metrics and drift on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from tallyward.functions import bins, expr
from tallyward.operators import boosting, drift, encode, evaluate, features, models, profile, split


def test_stay_bands_at_their_edges(spark):
    days = [-1.0, 0.0, 1.0, 1.5, 3.0, 7.0, 7.5, 14.0, 15.0, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, length_of_stay double")
    got = features.stay(df).orderBy("i").collect()
    assert [r["los_category"] for r in got] == [
        None, "Very Short (0-1)", "Very Short (0-1)", "Short (2-3)", "Short (2-3)", "Medium (4-7)", "Long (8-14)",
        "Long (8-14)", "Very Long (15+)", None]
    assert [r["extended_stay"] for r in got] == [0, 0, 0, 0, 0, 0, 1, 1, 1, 0]
    assert [r["short_stay"] for r in got] == [1, 1, 1, 1, 1, 0, 0, 0, 0, 0]


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,)], "x int")
    history = []
    assert features.all_groups(df, history).columns == ["x"]
    assert history == list(features.GROUPS)
    assert features.engineer_features(df).columns == ["x"]


def test_ratios_and_logs(spark):
    df = spark.createDataFrame([(10.0, 4.0, 1.0), (5.0, -1.0, -1.0)], "total_costs double, total_charges double, length_of_stay double")
    a, b = features.cost_ratios(df).orderBy(F.desc("total_costs")).collect()
    assert (a["cost_per_day"], a["cost_to_charge_ratio"], a["cost_efficiency"]) == (5.0, 2.0, 5.0)
    assert (b["cost_per_day"], b["cost_to_charge_ratio"]) == (None, None)
    back = features.restore_target(features.transform_target(df, "total_costs", "t"), "t", "u").collect()
    assert all(math.isclose(r["u"], r["total_costs"]) for r in back)
    assert features.transform_target(df, "total_charges", "t").where("t is null").count() == 1


def test_flags_ignore_case_and_gaps(spark):
    df = spark.createDataFrame([("EMERGENCY room", "Y"), (None, None)], "type_of_admission string, emergency_department_indicator string")
    got = features.admission(df).select("is_emergency", "is_urgent", "ed_visit").collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0), (1, 0, 1)]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Total Costs` int, `APR MDC Code ` int")
    assert expr.normalize_column_names(df).columns == ["total_costs", "apr_mdc_code"]


def test_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (10.0,), (None,)], "x double")
    lo, hi = F.lit(0.0), F.lit(10.0)
    got = df.select(bins.closed_right_bin(F.col("x"), lo, hi, 10), bins.closed_left_bin(F.col("x"), lo, hi, 10),
                    bins.edge_bin(F.col("x"), lo, hi, 10), bins.closed_left_bin(F.col("x"), lo, lo, 10)).collect()
    assert [tuple(r) for r in got] == [(1, 1, 0, 1), (1, 2, 1, 1), (2, 2, 1, 1), (10, 10, 9, 1), (None,) * 4]


def test_histogram_counts_every_value(spark):
    df = spark.range(1000).select((F.col("id") % 37 * 1.0).alias("x"))
    got = profile.histogram(df, "x", 20).collect()
    assert len(got) == 20 and sum(r["rows"] for r in got) == 1000


def test_grouping_sets_tell_gaps_from_totals(spark):
    df = spark.createDataFrame([("a", "x", 1.0), (None, "x", 3.0), ("a", None, 5.0)], "p string, q string, v double")
    got = {(r["dimension"], r["level"]): (r["mean"], r["rows"]) for r in profile.mean_by_dimension(df, ["p", "q"], "v").collect()}
    assert got == {("p", "a"): (3.0, 2), ("q", "x"): (2.0, 2)}


def test_onehot_and_labels(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), (None, 4)], "s string, i int")
    got = encode.encode(df, ["s"]).orderBy("i").collect()
    assert [(r["s_b"], r["s_c"]) for r in got] == [(1, 0), (0, 0), (0, 1), (0, 0)]
    got = encode.encode(df, ["s"], coded=["s"]).orderBy("i").collect()
    assert [r["s_encoded"] for r in got] == [1, 0, 2, 3]
    new = spark.createDataFrame([("z", 1)], "s string, i int")
    assert encode.encode(new, ["s"], "label", fit_on=df).first()["s_encoded"] is None


def test_labels_of_many_categories_with_one_prefix(spark):
    df = spark.range(5000).select(F.format_string("category-%05d", (F.col("id") * 7) % 2500).alias("s"))
    labels = encode.fit_labels(df, "s").collect()
    assert sorted((r["code"], r["s"]) for r in labels) == [(i, f"category-{i:05d}") for i in range(2500)]


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert [r["x_scaled"] for r in encode.scale(df, ["x"]).orderBy("x").collect()] == [-1.0, 1.0]
    assert [r["x_scaled"] for r in encode.scale(df, ["x"], "minmax").orderBy("x").collect()] == [0.0, 1.0]
    assert [r["c_scaled"] for r in encode.scale(df, ["c"], "minmax").collect()] == [0.0, 0.0]
    assert [r["x_scaled"] for r in encode.scale(df, ["x"], "maxabs").orderBy("x").collect()] == [1 / 3, 1.0]


def test_target_encoding_of_unseen_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "s string, y double")
    got = encode.encode(spark.createDataFrame([("a",), ("z",)], "s string"), ["s"], "target", target="y", fit_on=df)
    assert {r["s"]: r["s_target"] for r in got.collect()} == {"a": 2.0, "z": 4.0}


def test_selection_keeps_the_order_of_the_table(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("noise"), (F.col("id") * 2.0).alias("b"),
                                 (F.col("id") * F.col("id")).alias("a"), F.col("id").cast("double").alias("y"))
    assert encode.select_features(df, "y", 2) == ["b", "a"]
    assert encode.select_features(df, "y", 2, "mutual_info") == ["b", "a"]
    assert encode.select_features(df, "y", 99) == ["noise", "b", "a"]


@pytest.mark.parametrize("partitions", [1, 13])
def test_splits(spark, partitions):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
                                  .otherwise((F.col("id") % 4).cast("string")).alias("s")).repartition(partitions)
    got = split.stratified_split(df, "s", "id", 0.3)
    assert got.count() == 3000
    for r in got.groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["t"] == math.floor(r["n"] * 0.3 + 0.5)
    a = {r["id"] for r in split.hash_split(df, "id").where("split = 'test'").collect()}
    b = {r["id"] for r in split.hash_split(df.orderBy("id"), "id").where("split = 'test'").collect()}
    assert a == b and 450 < len(a) < 750
    assert split.sample_rows(df, "id", 10).count() == 10


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0), (None, 1.0)], "y double, p double")
    row = evaluate.wide_metrics(df, "y", "p", extended=True).first()
    assert (row["rows"], row["r2_score"], row["mae"], row["median_ae"]) == (3, 1.0, 0.0, 0.0)
    off = evaluate.wide_metrics(df.withColumn("p", F.col("p") + 1), "y", "p").first()
    assert off["explained_variance"] == pytest.approx(1.0) and off["mae"] == 1.0 and off["r2_score"] < 1
    constant = spark.createDataFrame([(1.0, 2.0)], "y double, p double")
    assert evaluate.wide_metrics(constant, "y", "p").first()["r2_score"] is None


def test_spearman_with_ties_and_a_hot_value(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") * 1.0).alias("y"),
                                 (F.col("id") % 20 * 1.0).alias("p"))
    pdf = df.toPandas()
    want = pdf["y"].rank().corr(pdf["p"].rank())
    assert evaluate.spearman(df, "y", "p").first()[0] == pytest.approx(want)


def test_gate_and_alerts(spark):
    schema = "metric string, value double"
    good = spark.createDataFrame([("r2_score", 0.9), ("mae", 0.1)], schema)
    bad = spark.createDataFrame([("r2_score", 0.8), ("mae", 0.105)], schema)
    assert {r["metric"]: r["passed"] for r in evaluate.gate(good).collect()} == {"r2_score": True, "mae": True}
    assert {r["metric"]: r["alert"] for r in evaluate.alerts(good, bad).collect()} == {"r2_score": True, "mae": False}


def test_drift_of_equal_and_of_moved_columns(spark):
    df = spark.range(2000).select((F.col("id") % 100 * 1.0).alias("x"), F.lit(3.0).alias("same"))
    moved = df.withColumn("x", F.col("x") + 40)
    got = {r["feature"]: r for r in drift.detect(df, df).collect()}
    assert all(r["psi"] == 0 and r["ks_statistic"] == 0 and not r["drift_detected"] for r in got.values())
    got = {r["feature"]: r for r in drift.detect(df, moved).collect()}
    assert got["x"]["drift_detected"] and got["x"]["ks_statistic"] == pytest.approx(0.4) and not got["same"]["drift_detected"]
    back = {r["feature"]: r for r in drift.detect(moved, df).collect()}
    assert back["x"]["ks_statistic"] == pytest.approx(0.4)
    top = drift.summary(drift.detect(df, moved)).first()
    assert (top["total_features"], top["drifted_features"]) == (2, 1) and top["top_drifted"][0]["feature"] == "x"


def test_drift_with_an_empty_side(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    row = drift.detect(df, df.where("x > 9")).first()
    assert row["psi"] is None and row["ks_statistic"] is None and not row["drift_detected"]


def test_permuted_columns_and_models(spark):
    df = spark.range(600).select("id", (F.col("id") % 30 * 1.0).alias("x"), (F.col("id") % 7 * 1.0).alias("noise"),
                                 (F.col("id") % 30 * 2.0).alias("label"), F.lit(None).cast("double").alias("gap"))
    df = df.withColumn("x", F.when(F.col("id") != 5, F.col("x")))
    model = boosting.fit(df, ["x", "noise"], "id", n_estimators=3, max_depth=3, learning_rate=0.5)
    assert models.r2(model.transform(df)) > 0.8
    found = models.permutation_importance(model, df, ["x", "noise"], "id", 2).collect()
    assert found[0]["feature"] == "x" and found[0]["importance_mean"] > found[1]["importance_mean"]
    names = models.feature_names(df.withColumn("total_costs", F.lit(1.0)), "label", ["id"])
    assert names == ["x", "noise", "gap"]
    assert len(models.grid({"max_depth": [2, 3], "learning_rate": [0.1]})) == 2
    assert len(models.grid()) == 3 * 4 * 4 * 3 * 3 * 3 * 3 and len(models.draws()) == 50
    with pytest.raises(TypeError):
        boosting.fit(df, ["x"], "id", unknown=1)
    for settings in ({"unknown": 1}, {"max_depth": 31}):
        with pytest.raises(ValueError):
            models.forest(["x"], **settings)


def test_forests_keep_the_nodes_of_rows(spark):
    """That saves sending deep trees to every pass, and grows the same trees."""
    df = spark.range(400).select((F.col("id") % 37 * 1.0).alias("x"), (F.col("id") % 11 * 1.0).alias("y"), (F.col("id") * 7 % 101 * 1.0).alias("label"))
    kept, sent = models.forest(["x", "y"], n_estimators=3, max_depth=None), models.forest(["x", "y"], n_estimators=3, max_depth=None)
    assert kept.getStages()[-1].getCacheNodeIds()
    sent.getStages()[-1].setCacheNodeIds(False)
    kept, sent = (models.fit(forest, df).stages[-1].toDebugString.partition("\n")[2] for forest in (kept, sent))  # the first line has a name of its own
    assert kept == sent and "Tree 2" in kept


def test_values_are_dealt_over_the_whole_table(spark, monkeypatch):
    """Every row's values go to exactly one row, far from their own group as well; places are exact ranks over many partitions."""
    monkeypatch.setattr(models, "_PART_ROWS", 100)
    df = spark.range(3_000).select("id", (F.col("id") * 1.0).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).cast("double").alias("y"))
    dealt = models.dealt_anew(df, ["x", "y"], "id", "id", seed=1).collect()
    assert sorted(r["id"] for r in dealt) == sorted(int(r["_other"]["x"]) for r in dealt) == list(range(3_000))
    assert all((r["_other"]["y"] is None) == (r["_other"]["x"] % 3 == 0) for r in dealt)
    apart = [abs(r["id"] - r["_other"]["x"]) for r in dealt]
    assert 900 < sum(apart) / 3_000 < 1_100  # a third of the length for values from anywhere
    places = models._in_random_order(df.withColumn("_key", F.col("id")), F.xxhash64(F.lit(1), F.col("id")), "id", "_random").collect()
    assert [r["_place"] for r in sorted(places, key=lambda r: r["_random"])] == list(range(1, 3_001))
    assert models.dealt_anew(df.limit(0), ["x"], "id").count() == 0


def test_scores_of_constant_targets(spark):
    from tallyward.operators import evaluate

    rows = [("one", 1.0, 2.0), ("same", 3.0, 3.0), ("same", 3.0, 3.0), ("off", 3.0, 3.0), ("off", 3.0, 4.0), ("shift", 2.0, 3.0), ("shift", 2.0, 3.0)]
    wide = evaluate.wide_metrics(spark.createDataFrame(rows, "k string, y double, p double"), "y", "p", ["k"], median=False)
    got = {r["k"]: (r["r2_score"], r["explained_variance"]) for r in wide.collect()}
    assert got == {"one": (None, None), "same": (1.0, 1.0), "off": (0.0, 0.0), "shift": (0.0, 1.0)}
    assert evaluate.wide_metrics(spark.createDataFrame([], "y double, p double"), "y", "p", median=False).first()["r2_score"] is None


def test_dummies_or_codes_as_the_caller_says(spark):
    from tallyward.operators import encode

    df = spark.createDataFrame([(i % 3, i) for i in range(30)], "few int, many int")
    assert encode.propose_codes(df, ["few", "many"]) == ["many"]
    assert {"few_1", "few_2", "many_encoded"} <= set(encode.encode(df, ["few", "many"], coded=["many"]).columns)
    assert "many_29" in encode.encode(df, ["many"]).columns


def test_samples_do_not_depend_on_partitions(spark):
    from tallyward.operators import split

    df = spark.range(5_000)
    got = {r["id"] for r in split.sample_rows(df, "id", 100).collect()}
    assert len(got) == 100 and got == {r["id"] for r in split.sample_rows(df.repartition(7), "id", 100).collect()}
    assert split.sample_rows(df, "id", 9_000).count() == 5_000 and split.sample_rows(df.limit(0), "id", 5).count() == 0


def test_distances_of_windows_are_within_their_bound(spark):
    """Sketches of windows of very unlike sizes and shapes, with ties and far values, against counting at every value."""
    import bisect
    import random

    rng = random.Random(4)
    base = [rng.gauss(0, 1) if i % 3 else float(i % 5) for i in range(20_000)]
    shapes = {"2024-01-01": [rng.gauss(0, 1) for _ in range(15_000)], "2024-01-02": [1.0] * 700, "2024-01-03": [-5.0, 9.0], "2024-01-04": rng.sample(base, 9_000),
              "2024-01-05": [rng.gauss(0.3, 2) for _ in range(5_000)], "2024-01-06": [-1e9]}
    rows = [(f"{day} 10:00:00", x, None) for day, values in shapes.items() for x in values] + [("2024-01-06 10:00:00", None, 1.0), ("2024-01-06 10:00:00", math.nan, 1.0)]
    df = spark.createDataFrame(rows, "ts string, x double, other double").withColumn("ts", F.col("ts").cast("timestamp"))
    profile = drift.distance_profile(spark.createDataFrame([(x, 1.0) for x in base], "x double, other double"), ["x", "other"])
    assert profile.where(F.size("points") > 2 * drift.GRID + 4).count() == 0
    got = {str(r["window_start"])[:10]: r for r in drift.distance_by_window(df, profile, ["x", "other"], "ts", "1 day").where("feature = 'x'").collect()}
    base.sort()
    for day, values in shapes.items():
        values = sorted(values)
        exact = max(abs(side(base, p) / len(base) - side(values, p) / len(values)) for p in {*base, *values} for side in (bisect.bisect_left, bisect.bisect_right))
        assert got[day]["rows"] == len(values) and abs(got[day]["ks_statistic"] - exact) <= drift.distance_error()
        if len(values) <= drift.SKETCH:
            assert abs(got[day]["ks_statistic"] - exact) <= 1 / drift.GRID
    assert drift.distance_error() < 0.005
    empty = drift.distance_profile(spark.createDataFrame([], "x double"), ["x"])
    assert empty.count() == 0 and drift.distance_by_window(df, empty, ["x"], "ts", "1 day").count() == 0


def test_hashed_vectors_are_not_spread_out(spark):
    """The digest of a vector is that of its few cells; the zeros of all slots are not written out for each row."""
    from tallyward.plans import QUERIES

    plan = QUERIES["encode_hash"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "unwrap_udt" in plan.lower() or "unwrapudt" in plan.lower()


def test_distinct_counts_are_dealt_to_tasks_by_the_rows(spark, monkeypatch, capsys):
    """A task holds the values of so many rows; blocks of rows, NULL, columns without values and an empty table count right."""
    monkeypatch.setattr(profile, "BLOCK_ROWS", 7)
    monkeypatch.setattr(profile, "TASK_ROWS", 3)
    rows = [(i % 5, str(i) if i % 3 else None, None, "1") for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d string").repartition(3)
    found = profile.distinct_counts(df)
    assert dict(found.collect()) == {"a": 5, "b": 200, "c": 0, "d": 1}
    found.explain()
    assert ", 100), REPARTITION_BY_NUM" in capsys.readouterr().out
    assert profile.distinct_counts(df.limit(0)).collect() == []
