"""Registered queries against their SQL counterparts on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from check import differences, duck
from textfeat.catalog import ORACLES as SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not found")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Python" not in plan
    assert differences(df.toPandas(), con.execute(SQL[name]).df()) == ""


def test_contract(spark):
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["doc_id", "word", "tfidf"]


@pytest.mark.parametrize("name", ["dt_predict", "lr_predict"])
def test_predictions(spark, name):
    rows = contract.queries()[name](spark, SF_DIR).collect()
    assert rows and {r.prediction for r in rows} <= {0, 1}
    assert len({(r.subject, r.fold, r.doc_id) for r in rows}) == len(rows)
    assert len({(r.subject, r.fold) for r in rows}) == 3 * 2


@pytest.mark.parametrize("name,n_settings", [("lr_grid", 4), ("results_summary", 6)])
def test_grids(spark, name, n_settings):
    rows = contract.queries()[name](spark, SF_DIR).collect()
    assert len(rows) == 3 * n_settings * 2 * 3  # subjects, settings, validation folds, sets
