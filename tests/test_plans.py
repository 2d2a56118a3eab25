"""Physical plans: pruned and pushed-down scans, no pairing joins, bounded shuffles."""

import re

import pytest

import workloads
from tabularium.operators import quantiles
from tabularium.session import stored

QUERIES = workloads.load()[0]
# Eager: their result is read back from a table or a fitted model, so the plan says little.
SKIP = {"train_gbt", "train_gbt_deep", "train_ridge", "tree_attribution", "hybrid_retrieve"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_pairing_join_or_row_udf(name, spark, data):
    text = plan(QUERIES[name](spark, data))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


@pytest.fixture()
def written(monkeypatch):
    """Plans of the tables that quantiles write on their way."""
    plans = []

    def keep(df, label):
        plans.append(plan(df))
        return stored(df, label)

    monkeypatch.setattr(quantiles, "stored", keep)
    return plans


@pytest.mark.parametrize("name", ["group_stats", "distribution_shape", "robust_scale"])
def test_quantiles_pair_nothing_on_the_way(name, spark, data, written):
    QUERIES[name](spark, data)
    assert len(written) > 1
    for text in written:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned(spark, data, written):
    QUERIES["group_stats"](spark, data)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", written[0])
    assert any(s == "l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double" for s in schemas)
    assert "o_orderkey:bigint,o_custkey:bigint" in schemas


def test_filters_reach_the_scan(spark, data):
    text = plan(QUERIES["market_filter"](spark, data))
    assert "GreaterThanOrEqual(l_extendedprice,20000.0)" in text
    assert "EqualTo(c_mktsegment,BUILDING)" in text


def test_top_n_is_trimmed_before_the_shuffle(spark, data):
    text = plan(QUERIES["rrf_fusion"](spark, data))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(QUERIES["latest_n"](spark, data))


def test_zscore_needs_no_join_and_no_shuffle_of_rows(spark, data):
    text = plan(QUERIES["zscore_flags"](spark, data))
    main = text.split("Subquery")[0]
    assert "Join" not in text and "Exchange" not in main
