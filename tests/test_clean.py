"""Cleaning operators on small hand-made tables."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyward.operators import clean


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_numbers(spark):
    cells = ["1", " 2.5 ", "1e3", "-4", "n/a", "", "10d", "NaN", "Infinity", "120+", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[0] for r in clean.convert_types(df, {"c": "numeric", "absent": "numeric"}).orderBy("i").select("c").collect()]
    assert got == [1.0, 2.5, 1000.0, -4.0, None, None, None, None, None, None, None]
    got = clean.convert_types(df, {"c": "numeric"}, {"120+": "120"}).where("i = 9").first()["c"]
    assert got == 120.0


def test_other_types(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "7"), ("no", "x")], "t string, n string")
    got = clean.convert_types(df, {"t": "datetime", "n": "int"}).collect()
    assert str(got[0]["t"]) == "2024-01-02 03:04:05" and got[0]["n"] == 7
    assert got[1]["t"] is None and got[1]["n"] is None


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, 5, "b", None), (None, 6, "a", None), (4.0, None, None, "z"), (4.0, 7, "a", None)],
                               "x double, n int, s string, sparse string")
    assert "sparse" not in clean.impute(df, "mean").columns
    assert rows(clean.impute(df, "mean").select("x", "s"), "x", "s") == [(1.0, "b"), (3.0, "a"), (4.0, "Unknown"), (4.0, "a")]
    assert rows(clean.impute(df, "median").select("n"), "n") == [(5.0,), (6.0,), (6.0,), (7.0,)]
    mode = clean.impute(df, "mode", drop_threshold=0.8)
    assert mode.where("s = 'a'").count() == 3 and mode.where("x is null").count() == 1
    dropped = clean.impute(df, "drop")
    assert dropped.count() == 4 and dropped.where("s = 'Unknown'").count() == 1


def test_mode_of_ties_and_of_nothing(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "s string, e string")
    got = clean.impute(df, "mode", drop_threshold=1.0)
    assert got.where("s = 'a'").count() == 2 and got.where("e = 'Unknown'").count() == 3


def test_fit_on_other_rows(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    train = spark.createDataFrame([(10.0,), (30.0,), (None,)], "x double")
    assert rows(clean.impute(df, "mean", fit_on=train), "x") == [(1.0,), (20.0,)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (1, 1, "y"), (2, 9, None)], "k int, o int, v string")
    once = clean.drop_duplicates(df)
    assert once.count() == 3 and clean.drop_duplicates(once).count() == 3
    assert rows(clean.drop_duplicates(df, ["k"], ["o"]), "k") == [(1, 1, "y"), (2, 9, None)]
    with pytest.raises(ValueError):
        clean.drop_duplicates(df, ["k"])


def test_outliers(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(20)] + [(1000.0, 3.0), (None, 1.0)], "x double, y double")
    assert clean.remove_outliers(df, ["x", "absent"]).agg(F.max("x")).first()[0] == 19.0
    assert clean.remove_outliers(df, ["x"], "zscore", 3).count() == 20
    assert clean.remove_outliers(df, ["x", "y"], sequential=False).count() == 20
    constant = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert clean.remove_outliers(constant, ["x"]).count() == 2
    assert clean.remove_outliers(constant, ["x"], "zscore", 3).count() == 0
    capped = clean.cap_outliers(df, ["x"], 0.1, 0.9).agg(F.min("x"), F.max("x"), F.count("x")).first()
    assert tuple(capped) == (2.0, 18.0, 21)


def test_text_and_filters(spark):
    df = spark.createDataFrame([("\t New Born \n", 1), (None, 2)], "s string, n int")
    assert rows(clean.standardize_text(df, ["s"], replace_spaces=True).select("s", "n"), "n") == [("new_born", 1), (None, 2)]
    assert clean.filter_rows(df, {"n": lambda c: c > 1, "absent": 3}).count() == 1
    assert clean.filter_rows(df, {"n": 1}).count() == 1


def test_clean_and_report_agree(spark):
    raw = [("a", "5", "100", "50.0", None), ("a", "5", "100", "50.0", None), ("b", "n/a", "100", "50.0", "x"),
           ("c", "120+", "x", "10.0", "y"), ("d", "2", "100", "-1", "z"), ("e", "0", "70", "8", None)]
    df = spark.createDataFrame(raw, "k string, length_of_stay string, total_charges string, total_costs string, note string")
    got = rows(clean.clean_discharges(df), "k")
    assert got == [("a", 5.0, 100.0, 50.0, "Unknown"), ("c", 120.0, 85.0, 10.0, "y"), ("e", 0.0, 70.0, 8.0, "Unknown")]
    facts = {(r["operation"], r["metric"]): r["value"] for r in clean.cleaning_report(df).collect()}
    assert facts["drop_duplicates", "rows_removed"] == 1 and facts["filter_rows", "rows_removed"] == 2
    assert facts["output", "rows"] == 3 and facts["impute", "missing_before"] == 3
    without = clean.clean_discharges(df, topcode=None)
    assert without.where("k = 'c'").count() == 0


def test_rules(spark):
    df = spark.createDataFrame([(1.0, "M"), (None, "X"), (9.0, None)], "x double, g string")
    got = {(r["column"], r["rule"]): r["violations"] for r in clean.validate(
        df, {"x": {"min": 2, "max": 8, "required": True}, "g": {"allowed": ["M"]}, "absent": {"min": 0}}).collect()}
    assert got == {("x", "min"): 1, ("x", "max"): 1, ("x", "required"): 1, ("g", "allowed"): 1}


def test_fences_follow_from_what_earlier_ones_left(spark):
    """Against plain Python, with NULL, NaN, ties and columns that empty the table."""
    rng = random.Random(9)
    rows = [(i, rng.gauss(0, 1) if i % 11 else None, 5.0 * i if i % 7 == 0 else rng.random(), float(i % 3), math.nan if i % 50 == 0 else rng.expovariate(1)) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    left = rows
    for place in (1, 2, 3, 4):
        values = [r[place] for r in left if r[place] is not None and not math.isnan(r[place])]
        q1, _, q3 = statistics.quantiles(values, n=4, method="inclusive")
        left = [r for r in left if r[place] is not None and q1 - 1.5 * (q3 - q1) <= r[place] <= q3 + 1.5 * (q3 - q1)]
    found = clean.remove_outliers(df, ["a", "b", "c", "d"])
    assert sorted(r["id"] for r in found.collect()) == [r[0] for r in left] and found.columns == df.columns
    assert clean.remove_outliers(df.withColumn("none", F.lit(None).cast("double")), ["a", "none", "b"]).count() == 0
    assert clean.remove_outliers(df.limit(0), ["a", "b"]).count() == 0
