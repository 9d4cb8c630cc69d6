"""The registered model queries train with the whole of the settings; nothing is trained here."""

import math

import numpy as np
import pytest

from tallyward.functions import values as V
from tallyward.operators import boosting, models
from tallyward.operators.tree_growth import LOSSES, Settings, Tree
from tallyward.plans import model_queries as queries

SF = "/root/testdata/sf0.001"


class Asked(Exception):
    pass


def asked(monkeypatch, module, name, query, spark):
    """What the query hands to a function of the module."""
    def stop(*given, **named):
        raise Asked(given, named)

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Asked) as found:
        query(spark, SF)
    return found.value.args


@pytest.mark.parametrize("name", ["train_gbt", "train_gbt_early_stop", "feature_importance", "score_batch", "model_roundtrip", "json_score"])
def test_boosted_models(spark, monkeypatch, name):
    given, named = asked(monkeypatch, boosting, "fit", getattr(queries, name), spark)
    assert len(given) == 3 and set(named) <= {"stop"}  # the rest are the defaults
    assert {k: getattr(Settings(), k) for k in V.MODEL} == V.MODEL


def test_forest(spark, monkeypatch):
    (pipeline, _), _ = asked(monkeypatch, models, "fit", queries.train_rf, spark)
    tree = pipeline.getStages()[-1]
    assert tree.getNumTrees() == 50 and tree.getMaxDepth() == 30


def test_losses(spark, monkeypatch):
    (_, units), named = asked(monkeypatch, boosting, "fit_units", queries.train_robust, spark)
    assert [u.settings for u in units] == [Settings(loss=loss) for loss in LOSSES] and not named


@pytest.mark.parametrize("name, n", [("tune_grid", math.prod(map(len, V.GRID.values()))), ("tune_random", 50)])
def test_searches(spark, monkeypatch, name, n):
    given, named = asked(monkeypatch, models, "search", getattr(queries, name), spark)
    assert len(given[0]) == n and all(len(c) == len(V.GRID) for c in given[0])
    assert len(given) == 4 and not named  # five folds are the default


def test_folds_votes_and_repeats(spark, monkeypatch):
    given, named = asked(monkeypatch, models, "fold_scores", queries.cv_scores, spark)
    assert len(given) == 3 and not named
    with monkeypatch.context() as patch:
        patch.setattr(boosting, "fit", lambda *given, **named: named)
        (pair, rows), _ = asked(patch, models, "weighted_vote", queries.score_ensemble, spark)
        assert pair == [V.LEAF_WISE, V.LEVEL_WISE]
        assert {r[0] for r in rows.select("split").distinct().collect()} == {"train", "test"}
        given, named = asked(patch, models, "permutation_importance", queries.permutation_importance, spark)
        assert len(given) == 4 and not named  # ten repeats are the default


def test_requests_are_read_once(spark, monkeypatch, tmp_path, capsys):
    """Good and malformed requests are scored in one pass over them, and only the good ones have predictions."""
    text = '{"data": [{"discharge_key": "k", "length_of_stay": 2.0, "total_charges": %s}, {"discharge_key": "l"}]}'
    spark.createDataFrame([(1, text % 5), (2, '{"data": [{"dis'), (3, "{}"), (4, text % 9), (5, None)], "order_no long, request string").write.parquet(f"{tmp_path}/asked")
    model = boosting.Model(boosting.Binning(["length_of_stay", "total_charges"], [[1.0], [6.0]], [0.0, 0.0]), Settings(), 1.0, [])
    monkeypatch.setattr(queries, "_request_model", lambda *given: model)
    monkeypatch.setattr(queries, "requests", lambda *given: spark.read.parquet(f"{tmp_path}/asked"))
    found = queries.json_score(spark, SF)
    capsys.readouterr()
    found.explain("simple")
    assert capsys.readouterr().out.count("FileScan parquet") == 1
    got = {r["order_no"]: r["response"] for r in found.collect()}
    good = '{"predictions":[1.7183,1.7183]}'
    assert got == {1: good, 2: '{"error":"malformed request"}', 3: '{"error":"no data"}', 4: good, 5: '{"error":"no data"}'}


def test_only_repeated_keys_are_joined(spark, monkeypatch, tmp_path):
    """A saved model against the loaded one: rows meet by key, a row without a key counts as a difference, and keys that stand alone are not exchanged for a join."""
    one = lambda *x: np.array(x)
    tree = Tree(one(0, -1, -1), one(0, 0, 0), one(1, -1, -1), one(0.0, 0.0, 5.0), one(1.0, 0.0, 0.0), one(2.0, 1.0, 1.0))
    model = boosting.Model(boosting.Binning(["x", "y"], [[1.0], []], [0.0, 0.0]), Settings(), 1.0, [tree])
    monkeypatch.setattr(boosting, "fit", lambda *given: model)
    joined, released = [], queries.released
    monkeypatch.setattr(queries, "released", lambda df, name: joined.append((out := released(df, name)).count()) or out)
    alone = [("a", 0.0), ("b", 3.0), ("c", 9.0)]
    for more, want in (([], 0.0), ([("a", 0.5)], 0.0), ([("a", 7.0)], 5.0), ([(None, 0.0)], 1.0), ([(None, 0.0), ("b", 0.0)], 5.0)):
        table = spark.createDataFrame([(k, x, 0.0, x, "train") for k, x in alone + more], "discharge_key string, x double, y double, label double, split string")
        monkeypatch.setattr(queries, "_table", lambda *given, table=table: (table, ["x", "y"]))
        found = {r["metric"]: r["value"] for r in queries.model_roundtrip(spark, SF).collect()}
        assert found == {"largest_difference": want, "train_r2_difference": 0.0}
    assert joined == [0, 2, 2, 0, 2]
