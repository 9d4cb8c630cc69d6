"""Boosted trees against plain Python, passes against one task, losses, folds and candidates, odd tables."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import boosting, models, split, tree_growth
from tallyward.operators.tree_growth import Growth, Settings, Tree, leaf_quantiles

FEATURES = ["a", "b", "c"]
SCHEMA = "key long, a double, b double, c double, label double, part int, weight double"


def some_rows(n=500, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randint(0, 20), rng.random(), rng.choice([0.0, 1.0, 5.0])
        label = 3 * (a > 7) + 2 * b * (c == 1) + 0.1 * a + rng.gauss(0, 0.3) + (40 if rng.random() < 0.02 else 0)
        out.append((i, float(a) if i % 17 else None, b, c, label, i % 3, 0.5 + i % 4))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(some_rows(), SCHEMA).repartition(4)


def plain_tree(codes, starts, total, gradient, weight, s):
    """Nested tuples (feature, code, left, right) or the leaf's value, by trying every split of every leaf."""
    ends = [*starts[1:], total]

    def score(rows):
        return sum(gradient[i] * weight[i] for i in rows) ** 2 / (sum(weight[i] for i in rows) + s.reg_lambda)

    def best(rows):
        found = None
        for f, (lo, hi) in enumerate(zip(starts, ends)):
            for code in range(lo, hi - 1):
                left = [i for i in rows if codes[f][i] <= code]
                right = [i for i in rows if codes[f][i] > code]
                if min(len(left), len(right)) < s.min_samples_leaf or min(sum(weight[i] for i in x) for x in (left, right)) < s.min_child_weight:
                    continue
                gain = score(left) + score(right) - score(rows)
                if found is None or gain > found[0] + 1e-9:
                    found = gain, f, code, left, right
        return found if found and found[0] > max(s.min_split_gain, 1e-9) and len(rows) >= s.min_samples_split else None

    root = {"rows": list(range(len(gradient))), "depth": 0}
    leaves, n = [root], 1
    while True:
        open_ = [(x, best(x["rows"])) for x in leaves if "tried" not in x and (s.max_depth is None or x["depth"] < s.max_depth)]
        for x, found in open_:
            x["tried"] = found
        ready = [x for x in leaves if x.get("tried")]
        if not ready or (s.max_leaves and n >= s.max_leaves):
            break
        # The best leaf first; without a limit of leaves the order does not matter.
        x = max(ready, key=lambda x: x["tried"][0])
        leaves.remove(x)
        x["children"] = [{"rows": r, "depth": x["depth"] + 1} for r in x["tried"][3:]]
        leaves += x["children"]
        n += 1

    def nested(x):
        if "children" in x:
            return x["tried"][1], x["tried"][2], *map(nested, x["children"])
        return round(sum(gradient[i] * weight[i] for i in x["rows"]) / (sum(weight[i] for i in x["rows"]) + s.reg_lambda), 6)

    return nested(root)


def nested(tree, rate, node=0):
    if tree.feature[node] < 0:
        return round(float(tree.value[node]) / rate, 6)
    return int(tree.feature[node]), int(tree.code[node]), nested(tree, rate, tree.left[node]), nested(tree, rate, tree.left[node] + 1)


GROWN = [
    {"max_depth": 4}, {"max_depth": 3, "min_samples_leaf": 20}, {"max_depth": 5, "min_samples_split": 60}, {"max_depth": None, "max_leaves": 9},
    {"max_depth": 4, "max_leaves": 7, "reg_lambda": 3.0, "min_child_weight": 12.0}, {"max_depth": 3, "reg_lambda": 1.0, "min_split_gain": 15.0},
]


@pytest.mark.parametrize("settings", GROWN)
@pytest.mark.parametrize("weight", [None, "weight"])
def test_splits_are_those_of_plain_python(rows, settings, weight):
    s = Settings(n_estimators=1, learning_rate=0.5, subsample=1.0, **settings)
    blocks = boosting.make_blocks(rows, FEATURES, "key", weight=weight, max_bins=12)
    data = rows.toPandas()
    codes = blocks.binning.codes(blocks.binning.bins([data[c].to_numpy() for c in FEATURES]))
    w = data["weight"].to_numpy() if weight else np.ones(len(data))
    gradient = data["label"].to_numpy() - np.average(data["label"], weights=w)
    want = plain_tree(codes.tolist(), blocks.binning.starts.tolist(), blocks.binning.total, gradient.tolist(), w.tolist(), s)
    for local_rows in (boosting.LOCAL_ROWS, 0):
        assert nested(boosting.fit_units(blocks, [boosting.Unit(s)], local_rows=local_rows)[0].trees[0], 0.5) == want


@pytest.mark.parametrize("settings", [
    {"subsample": 0.7, "max_features": "sqrt"}, {"loss": "absolute_error"}, {"loss": "huber", "alpha": 0.8, "subsample": 0.8}, {"loss": "quantile", "alpha": 0.25},
    {"max_depth": None, "max_leaves": 6, "reg_lambda": 1.0},
])
def test_passes_give_the_models_of_one_task(rows, monkeypatch, settings):
    """Blocks of 40 rows, predictions staged every other tree, one block a pass holding other folds' models too."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    monkeypatch.setattr(boosting, "STAGED_TREES", 2)
    s = Settings(**{"n_estimators": 3, "learning_rate": 0.3, "max_depth": 3, **settings})
    blocks = boosting.make_blocks(rows, FEATURES, "key", fold=F.col("part"), max_bins=16)
    units = [boosting.Unit(s, held, (1, 3)) for held in (None, 1)]
    for here, there in zip(boosting.fit_units(blocks, units), boosting.fit_units(blocks, units, local_rows=0)):
        assert here.begin == pytest.approx(there.begin) and set(here.stats) == set(there.stats) == {1, 3}
        for a, b in zip(here.trees, there.trees, strict=True):
            assert (a.feature.tolist(), a.code.tolist(), a.left.tolist()) == (b.feature.tolist(), b.code.tolist(), b.left.tolist())
            assert np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain)
        for t in here.stats:
            assert np.allclose(here.stats[t][[0, 2, 3, 4]], there.stats[t][[0, 2, 3, 4]])


def losses(rows, model):
    data = rows.toPandas()
    residual = data["label"].to_numpy() - model.predict([data[c].to_numpy() for c in FEATURES])
    return {"squared_error": (residual**2).mean(), "absolute_error": np.abs(residual).mean(),
            "quantile": np.where(residual > 0, 0.9 * residual, -0.1 * residual).mean()}


def test_each_loss_is_less_than_under_the_squares(rows):
    fitted = {loss: losses(rows, boosting.fit(rows, FEATURES, "key", n_estimators=40, max_depth=3, subsample=1.0, loss=loss))
              for loss in ("squared_error", "absolute_error", "quantile", "huber")}
    for loss in ("absolute_error", "quantile"):
        assert fitted[loss][loss] < fitted["squared_error"][loss]
        assert fitted[loss]["squared_error"] > fitted["squared_error"]["squared_error"]
    # Outliers move Huber's model less than that of the squares.
    assert fitted["huber"]["absolute_error"] < fitted["squared_error"]["absolute_error"]


def test_first_values_of_robust_leaves(rows):
    """One split: the leaves hold medians, quantiles and Friedman's values of the residuals, computed here from the rows."""
    data = rows.toPandas()
    label = data["label"].to_numpy()
    for loss, share in (("absolute_error", 0.5), ("quantile", 0.9), ("huber", 0.5)):
        model = boosting.fit(rows, FEATURES, "key", n_estimators=1, max_depth=1, subsample=1.0, learning_rate=1.0, loss=loss)
        assert model.begin == pytest.approx(np.quantile(label, share))
        leaf = model.trees[0].leaves(model.binning.codes(model.binning.bins([data[c].to_numpy() for c in FEATURES])))
        for node in (1, 2):
            residual = label[leaf == node] - model.begin
            value = np.quantile(residual, share)
            if loss == "huber":
                delta = np.quantile(np.abs(label - model.begin), 0.9)
                value += np.clip(residual - value, -delta, delta).mean()
            assert model.trees[0].value[node] == pytest.approx(value)


def test_folds_and_candidates_share_the_work(rows):
    """Scores equal those of models trained one by one; numbers of trees are prefixes; settings that give the same trees are trained once."""
    candidates = [{"n_estimators": n, "max_depth": d, "learning_rate": r, "max_features": m, "subsample": 0.9}
                  for n, d, r, m in itertools.product([2, 5], [2, 3], [0.1, 0.5], ["log2", 1])]
    scores = boosting.cross_validate(rows, FEATURES, "key", candidates, F.col("part"), 3, max_bins=16)
    blocks = boosting.make_blocks(rows, FEATURES, "key", fold=F.col("part"), max_bins=16)
    data = rows.toPandas()
    for c in (0, 3, 9, 15):
        for k in range(3):
            out = boosting.fit_units(blocks, [boosting.Unit(Settings(**candidates[c]), k)])[0]
            model = boosting.Model(blocks.binning, Settings(**candidates[c]), out.begin, out.trees)
            held = data[data["part"] == k]
            y, p = held["label"].to_numpy(), model.predict([held[f].to_numpy() for f in FEATURES])
            assert scores[c][k] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    # log2 of three features is one feature.
    assert all(scores[i] == scores[i + 1] for i in range(0, 16, 2))


def test_early_stop(rows):
    model = boosting.fit(rows, FEATURES, "key", stop=F.col("part") == 0, n_estimators=300, learning_rate=0.5, max_depth=4, n_iter_no_change=3, tol=0.01)
    assert 3 < len(model.trees) < 300


def test_saved_models_tables_and_streams(spark, rows, tmp_path):
    model = boosting.fit(rows, FEATURES, "key", n_estimators=5, max_depth=3)
    again = boosting.Model.from_json(model.to_json())
    data = rows.toPandas()
    wanted = dict(zip(data["key"], model.predict([data[c].to_numpy() for c in FEATURES])))
    assert {r["key"]: r["prediction"] for r in again.transform(rows).collect()} == pytest.approx(wanted)
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    again.transform(stream).writeStream.format("memory").queryName("scored").trigger(availableNow=True).start().awaitTermination()
    assert {r["key"]: r["prediction"] for r in spark.table("scored").collect()} == pytest.approx(wanted)
    assert sum(model.importances()) == pytest.approx(1)


def test_odd_tables(spark):
    """NULL and NaN, a constant column, one without values, no rows, one row, a constant label, repeated rows."""
    nan = math.nan
    table = [(1, None, 1.0, None, 1.0, 0, None), (2, nan, 1.0, None, 3.0, 0, 0.0), (2, 5.0, 1.0, None, 3.0, None, -1.0), (3, 7.0, 1.0, None, None, 0, 1.0), (4, 9.0, 1.0, None, nan, 0, nan)]
    df = spark.createDataFrame(table, SCHEMA)
    model = boosting.fit(df, FEATURES, "key", n_estimators=3, subsample=1.0)
    assert model.transform(df).where("prediction is null or isnan(prediction)").count() == 0
    assert boosting.fit(df.limit(1), FEATURES, "key", n_estimators=2).predict([np.array([nan])] * 3).tolist() == [1.0]
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(df.limit(0), FEATURES, "key")
    with pytest.raises(ValueError, match="unknown loss"):
        boosting.fit(df, FEATURES, "key", loss="other")
    with pytest.raises(ValueError, match="weights"):
        boosting.fit(df, ["a", "c"], "key", weight="b", loss="huber")
    assert boosting.cross_validate(df.where("key = 2"), FEATURES, "key", [{"n_estimators": 1}], F.lit(0), 2) == [[None, None]]


def test_drawn_features_and_quantiles():
    growth = Growth(Settings(max_features="sqrt"), 3, np.arange(10))
    growth.wanted = np.arange(500)
    drawn = growth.allowed()
    assert (drawn.sum(axis=1) == 3).all() and (drawn.sum(axis=0) > 100).all()
    rng = np.random.default_rng(1)
    leaf, values = rng.integers(0, 5, 200), rng.random(200)
    assert np.allclose(leaf_quantiles(leaf, values, 0.3, 5), [np.quantile(values[leaf == i], 0.3) for i in range(5)])


def test_searches(spark, rows):
    """The table of a search: every candidate with the mean and spread of its folds, the best by mean, and the best one refitted on all rows."""
    candidates = models.grid({"n_estimators": [3, 30], "max_depth": [1, 3], "learning_rate": [0.2], "min_samples_split": [2, 50]})
    model, found = models.search(candidates, rows, FEATURES, "key", folds=3)
    table = {r["candidate"]: r for r in found.collect()}
    assert len(table) == 8 and [c for c, r in table.items() if r["best"]] == [min(c for c in table if table[c]["mean_r2"] == max(r["mean_r2"] for r in table.values()))]
    folds = split.hash_fold(rows, "key", 3, 42, "_fold")
    scores = boosting.cross_validate(folds, FEATURES, "key", candidates, F.col("_fold"), 3)
    for c, r in table.items():
        assert r["mean_r2"] == pytest.approx(np.mean(scores[c])) and r["std_r2"] == pytest.approx(np.std(scores[c]))
        assert r["settings"] == ", ".join(f"{k}={v}" for k, v in sorted(candidates[c].items()))
    best = next(c for c, r in table.items() if r["best"])
    assert len(model.trees) == candidates[best]["n_estimators"] == 30
    spread = models.fold_scores(rows, FEATURES, "key", folds=3, **candidates[best]).collect()
    assert [r["r2_score"] for r in sorted(spread, key=lambda r: r["fold"])] == pytest.approx(scores[best])
    assert models.search(candidates[:1], rows, FEATURES, "key", folds=2, refit=False)[0] is None


def test_a_leaf_wise_tree_takes_few_passes(rows, monkeypatch):
    """One pass serves many steps of a leaf-wise tree, with large sums met in tasks and small ones on the driver alike."""
    passes, level = [], boosting._level
    monkeypatch.setattr(boosting, "_level", lambda *given: passes.append(1) or level(*given))
    blocks = boosting.make_blocks(rows, FEATURES, "key")
    unit = boosting.Unit(Settings(n_estimators=1, max_depth=None, max_leaves=16, min_samples_leaf=5, learning_rate=0.5))
    want = boosting.fit_units(blocks, [unit])[0]
    for most in (boosting.DIRECT_BYTES, 0):
        monkeypatch.setattr(boosting, "DIRECT_BYTES", most)
        passes.clear()
        got = boosting.fit_units(blocks, [unit], local_rows=0)[0]
        assert [nested(t, 0.5) for t in got.trees] == [nested(t, 0.5) for t in want.trees]
        assert all((t.feature < 0).sum() == 16 for t in got.trees)
        assert len(passes) <= 11, len(passes)


@pytest.mark.parametrize("cells", [boosting.CELLS, 0])
@pytest.mark.parametrize("settings", [
    {"subsample": 0.7, "max_features": "sqrt"}, {"max_depth": None, "max_leaves": 6, "reg_lambda": 1.0}, {"subsample": 0.8, "min_samples_leaf": 9, "n_iter_no_change": 1, "tol": 0.2},
])
def test_sums_over_cells_give_the_models_of_one_task(rows, monkeypatch, cells, settings):
    """A table with few different rows of bins takes no pass, one with more takes passes: folds, samples, early ends, rows without a part to hold out."""
    passes, level = [], boosting._level
    monkeypatch.setattr(boosting, "_level", lambda *given: passes.append(1) or level(*given))
    monkeypatch.setattr(boosting, "CELLS", cells)
    monkeypatch.setattr(boosting, "CELL_ROWS", 30)
    monkeypatch.setattr(boosting, "TOGETHER", 2)
    s = Settings(**{"n_estimators": 6, "learning_rate": 0.3, "max_depth": 3, "subsample": 1.0, **settings})
    blocks = boosting.make_blocks(rows, FEATURES, "key", fold=F.col("part"), max_bins=6)
    units = [boosting.Unit(s, held, (2, 6)) for held in (None, 1, 1, 1, 2)] + [boosting.Unit(Settings(n_estimators=2, loss="absolute_error"))]
    for here, there in zip(boosting.fit_units(blocks, units), boosting.fit_units(blocks, units, local_rows=0), strict=True):
        assert here.begin == pytest.approx(there.begin)
        for a, b in zip(here.trees, there.trees, strict=True):
            assert (a.feature.tolist(), a.code.tolist(), a.left.tolist()) == (b.feature.tolist(), b.code.tolist(), b.left.tolist())
            assert np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain) and np.allclose(a.rows, b.rows)
        for t in set(here.stats) & set(there.stats) & {2, 6}:
            assert np.allclose(here.stats[t], there.stats[t])
    passes.clear()
    boosting.fit_units(blocks, units[:2], local_rows=0)
    assert bool(passes) == (cells == 0)


def test_cells_are_scored_once(rows, monkeypatch):
    """Rows of like bins walk down the trees once, are remembered within bounds, and have the predictions of a walk of their own."""
    model = boosting.fit(rows, FEATURES, "key", n_estimators=4, max_depth=3)
    data = rows.toPandas()
    bins = model.binning.bins([np.tile(data[c].to_numpy(), 5) for c in FEATURES])
    plain, walked = model.of_bins(bins), []
    of_bins = boosting.Model.of_bins
    monkeypatch.setattr(boosting.Model, "of_bins", lambda self, x: (walked.append(x.shape[1]), of_bins(self, x))[1])
    for limit in (boosting.CELLS, 20):
        monkeypatch.setattr(boosting, "CELLS", limit)
        scorer = boosting._Scorer(model)
        walked.clear()
        for _ in range(2):
            assert (scorer.predict(bins) == plain).all()
        assert walked[0] <= len(data) and len(scorer.cells) <= limit and (walked[1] == 0) == (limit > 20)
    monkeypatch.setattr(boosting, "_radix", lambda binning: None)
    assert (boosting._Scorer(model).predict(bins) == plain).all()


def test_permuted_bins_are_permuted_values(rows):
    model = boosting.fit(rows, FEATURES, "key", n_estimators=4, max_depth=3)
    names = ["c", "a", "part", "b"]  # one that the model does not know
    got, wanted = (sorted(tuple(r[c] for c in ("feature", "repeat", "label", "prediction")) for r in changed(model, rows, names, "key", 2, 42).collect())
                   for changed in (models._changed_bins, models._changed_values))
    assert got == wanted and len(got) == 2 * 4 * 500


def test_few_rows_walk_down_all_trees_at_once(rows, monkeypatch):
    """Trees side by side predict what they do one by one, in the same order of sums; only deep ones are walked one by one."""
    model = boosting.fit(rows, FEATURES, "key", n_estimators=7, max_depth=4)
    data = rows.toPandas()
    bins = model.binning.bins([data[c].to_numpy() for c in FEATURES])
    codes, plain = model.binning.codes(bins), np.full(len(data), model.begin)
    for tree in model.trees:
        plain += tree.value[tree.leaves(codes)]
    monkeypatch.setattr(tree_growth, "_CHUNK", 100)
    walked, leaves = [], Tree.leaves
    monkeypatch.setattr(Tree, "leaves", lambda self, x: (walked.append(1), leaves(self, x))[1])
    assert (model.of_bins(bins) == plain).all() and not walked
    assert (model.of_bins(bins[:, :0]) == plain[:0]).all()
    assert (boosting.Model(model.binning, model.settings, 2.0, []).of_bins(bins) == 2).all()
    monkeypatch.setattr(tree_growth, "SHALLOW", 2)
    assert (boosting.Model(model.binning, model.settings, model.begin, model.trees).of_bins(bins) == plain).all() and len(walked) == 7


def test_rows_are_drawn_once_for_all_models_of_a_search(monkeypatch):
    """One draw a tree serves every sample and held-out part; sums are those of the rows that each model uses."""
    rng, n = np.random.default_rng(5), 400
    cell, fold = rng.integers(0, 6, n), rng.integers(-1, 3, n).astype(np.int32)
    label, digest = rng.normal(size=n), rng.integers(0, 1 << 63, n).astype(np.uint64)
    groups = [(boosting.Unit(Settings(n_estimators=3, subsample=s), held), trees) for s, held, trees in (
        (0.5, None, 3), (0.5, 1, 3), (0.9, 1, 2), (0.7, 2, 3), (1.0, 0, 3), (0.7, 9, 1))]
    calls, draws = [], tree_growth.draws
    monkeypatch.setattr(tree_growth, "draws", lambda *given: calls.append(1) or draws(*given))
    found = {(g, t): v for g, t, v in boosting._sums_by_cell(cell, label, fold, digest, groups)}
    assert len(calls) == 3
    wanted = {}
    for g, (unit, trees) in enumerate(groups):
        used = fold != unit.held if unit.held is not None else np.ones(n, bool)
        if not used.all():
            wanted[g, boosting._HELD_OUT] = [~used, label * ~used, label**2 * ~used]
        wanted[g, boosting._USED] = [used, label * used]
        for t in range(trees if unit.settings.subsample < 1 else 0):
            drawn = used & (draws(digest, 42, t) < unit.settings.subsample)
            wanted[g, t] = [drawn, label * drawn]
    assert set(found) == set(wanted)
    for key, weights in wanted.items():
        assert np.allclose(np.stack(found[key]), np.stack([np.bincount(cell, w, 6) for w in weights]), atol=1e-12), key


def test_forests_grow_from_sums_over_cells(rows, monkeypatch):
    """Every tree is the best one of its own draw of the rows, also where its levels are looked at by parts; a forest of too many cells is Spark's."""
    monkeypatch.setattr(models, "FOREST_ROWS", 100)
    forest = models.forest(FEATURES, n_estimators=3, max_depth=3, max_features="all", max_bins=8)
    model = models.fit(forest, rows, key="key")
    data = rows.select("key", *FEATURES, "label", F.xxhash64("key").alias("digest")).toPandas()
    codes = model.binning.codes(model.binning.bins([data[c].to_numpy() for c in FEATURES]))
    label, digest = data["label"].to_numpy(), data["digest"].to_numpy().astype(np.uint64)
    assert isinstance(model, boosting.Model) and len(model.trees) == 3 and model.begin == pytest.approx(label.mean())
    drawn = []
    for t, tree in enumerate(model.trees):
        s = Settings(max_depth=3, subsample=1.0, bootstrap=True, random_state=42 * 1_000_003 + t)
        times = tree_growth.times_drawn(digest, s, 0)
        at = np.flatnonzero(times)
        assert 0.5 < len(at) / len(times) < 0.75 and 0.85 < times.mean() < 1.15
        assert nested(tree, 1 / 3) == plain_tree(codes[:, at].tolist(), model.binning.starts.tolist(), model.binning.total, (label - model.begin)[at].tolist(), times[at].tolist(), s)
        drawn.append(times.tolist())
    assert drawn[0] != drawn[1]
    deep = models.forest(FEATURES, n_estimators=2, max_depth=None, max_bins=8)
    whole = models.fit(deep, rows, key="key")
    monkeypatch.setattr(tree_growth, "WIDE", 500)
    parts = models.fit(deep, rows.repartition(7), key="key")
    for a, b in zip(whole.trees, parts.trees, strict=True):
        assert a.depth() > 6 and a.feature.tolist() == b.feature.tolist() and a.code.tolist() == b.code.tolist() and np.allclose(a.value, b.value)
    assert [models._tried(s, 7) for s in ("auto", "onethird", "sqrt", "log2", "all", "2", "0.5")] == [3, 3, 3, 3, 7, 2, 4]
    monkeypatch.setattr(boosting, "CELLS", 5)
    assert not isinstance(models.fit(models.forest(FEATURES, n_estimators=1, max_depth=2), rows), boosting.Model)


@pytest.mark.parametrize("errors", [3.0, 0.01])
def test_robust_models_over_cells_are_those_of_one_task(rows, monkeypatch, errors):
    """Two passes a tree where the bounds hold, more where they miss; the same trees and values, no pass a level."""
    monkeypatch.setattr(boosting, "KNOWN_ROWS", 60)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    monkeypatch.setattr(boosting, "_ERRORS", errors)
    monkeypatch.setattr(boosting, "_level", None)
    passes, one = [], boosting._cell_pass
    monkeypatch.setattr(boosting, "_cell_pass", lambda *given: passes.append(1) or one(*given))
    blocks = boosting.make_blocks(rows, FEATURES, "key", max_bins=8)
    units = [boosting.Unit(Settings(n_estimators=n, learning_rate=0.3, max_depth=3, **s)) for n, s in (
        (3, {"loss": "absolute_error", "subsample": 0.7, "max_features": "sqrt"}), (3, {"loss": "huber", "alpha": 0.8}), (2, {"loss": "quantile", "alpha": 0.25, "subsample": 1.0}),
        (2, {"loss": "huber", "max_leaves": 5, "min_samples_leaf": 5}))]
    want, got = (boosting.fit_units(blocks, units, local_rows=n) for n in (boosting.LOCAL_ROWS, 0))
    for a, b in zip(want, got, strict=True):
        assert a.begin == pytest.approx(b.begin)
        for x, y in zip(a.trees, b.trees, strict=True):
            assert (x.feature.tolist(), x.code.tolist(), x.left.tolist()) == (y.feature.tolist(), y.code.tolist(), y.left.tolist())
            assert np.allclose(x.value, y.value) and np.allclose(x.gain, y.gain)
    assert len(passes) <= 16 if errors == 3 else len(passes) > 8


def test_a_repeat_is_done_with_before_the_next(rows, monkeypatch):
    """The scores of each repeat are staged by themselves, cells travel as numbers where they fit, and the importances are those of all repeats at once."""
    model = boosting.fit(rows, FEATURES, "key", n_estimators=4, max_depth=3)
    names, staged, released = ["c", "a", "b"], [], models.released
    monkeypatch.setattr(models, "released", lambda df, name: staged.append((name, dict(df.dtypes).get("bins"))) or released(df, name))
    found = {}
    for kind, radix in (("bigint", boosting._radix), ("binary", lambda binning: None)):
        monkeypatch.setattr(boosting, "_radix", radix)
        staged.clear()
        found[kind] = [tuple(r) for r in models.permutation_importance(model, rows, names, "key", repeats=3).collect()]
        assert staged == [("bins", kind)] + [("repeat", None)] * 3
    data = models._changed_values(model, rows, names, "key", 3, 42).toPandas()
    label = rows.toPandas()["label"]
    base = models.r2(model.transform(rows))
    for name, mean, std in found["bigint"] + found["binary"]:
        drops = [base - 1 + ((x["label"] - x["prediction"]) ** 2).mean() / label.var(ddof=0) for _, x in data[data["feature"] == name].groupby("repeat")]
        assert mean == pytest.approx(np.mean(drops)) and std == pytest.approx(np.std(drops), abs=1e-9)
