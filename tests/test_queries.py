"""Every registered query, against its SQL where there is one."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert {r["apr_severity_of_illness_description"] for r in entry.entry(spark).collect()} >= {"Minor", "Extreme"}


#: Searches with the whole of the settings train thousands of models; test_boosting.py and test_model_settings.py test their parts.
LONG = {"tune_grid", "tune_random"}


@pytest.mark.parametrize("name", [pytest.param(n, marks=pytest.mark.skipif(n in LONG, reason="takes minutes to hours")) for n in entry.queries()])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) is None
