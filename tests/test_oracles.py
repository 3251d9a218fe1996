"""Every registered query against its SQL on the smallest sample, plus a look at its plan."""

import math

import pytest

import __spark_entry__ as entry
from fleetlake.catalog import ORACLES
from fleetlake.catalog import QUERIES as NAMES

QUERIES = {n: q for n, q in entry.queries().items() if n in NAMES}
SMALL = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(0.0 if v == 0 else v)
    return str(v)


def table(names, rows):
    order = sorted(names)
    idx = [names.index(c) for c in order]
    return order, sorted(tuple(norm(r[i]) for i in idx) for r in rows)


#: Trains four models with hundreds of trees first; test_trees checks the scoring, tools/check.py this query.
MINUTES = {"tree_scores"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - MINUTES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    res = duck.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(names, res.fetchall())


def test_every_query_has_sql_or_a_reason():
    no_sql = {
        "driver_safety_model", "demand_model", "revenue_forecast", "maintenance_model", "pricing_model", "price_surface", "model_report", "feature_importance", "forecast_outlook",
    }
    assert set(QUERIES) - set(ORACLES) == no_sql


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 5
    assert "net_profit" in df.columns
