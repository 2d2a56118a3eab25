import numpy as np
import pandas as pd
import pytest

from tabularium.operators import quantiles as q

PROBS = {"p0": 0.0, "p02": 0.02, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p1": 1.0}


def expected(pdf, key):
    out = {}
    for k, g in pdf.groupby(key, dropna=False):
        v = g["v"].dropna().to_numpy()
        if len(v):
            out[None if pd.isna(k) else k] = [np.quantile(v, p) for p in PROBS.values()]
    return out


@pytest.mark.parametrize("slots,parts_", [(4096, 8), (3, 1), (17, 5)])
def test_groups_of_all_sizes(spark, monkeypatch, slots, parts_):
    """A hot group with most rows, tiny groups, heavy ties and a null key; few cells take more passes."""
    monkeypatch.setattr(q, "SLOTS", slots)
    rng = np.random.default_rng(1)
    parts = [
        pd.DataFrame({"k": "hot", "v": rng.lognormal(3, 2, 20_000)}),
        pd.DataFrame({"k": "ties", "v": rng.choice([1.0, 2.0, 2.5], 5_000)}),
        pd.DataFrame({"k": None, "v": rng.normal(0, 1, 300)}),
        *[pd.DataFrame({"k": f"s{n}", "v": rng.normal(0, 1, n)}) for n in range(1, 9)],
    ]
    pdf = pd.concat(parts, ignore_index=True)
    got = q.quantiles(spark.createDataFrame(pdf).repartition(parts_), ["k"], "v", PROBS).collect()
    want = expected(pdf, "k")
    assert {r["k"] for r in got} == set(want)
    for r in got:
        np.testing.assert_allclose([r[p] for p in PROBS], want[r["k"]], rtol=1e-12, atol=1e-12)


def test_whole_table_and_riders(spark):
    from pyspark.sql import functions as F

    v = np.random.default_rng(2).normal(10, 5, 20_000)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    r = q.quantiles(df, [], "v", {"m": 0.5}, extra={"total": F.sum("v")}).first()
    assert r["n"] == 20_000
    np.testing.assert_allclose([r["m"], r["total"]], [np.median(v), v.sum()])


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert q.quantiles(df, ["k"], "v", {"m": 0.5}).count() == 0
    assert tuple(q.quantiles(df, [], "v", {"m": 0.5}).first()) == (0, None)


def test_extreme_values(spark):
    """Infinite values, both zeros, subnormal and greatest numbers: every rank is a given value."""
    inf, big, tiny = float("inf"), 1.7976931348623157e308, 5e-324
    values = [-inf, -big, -1.0, -tiny, -0.0, 0.0, tiny, 1.0, 1.0 + 2**-52, big, inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = {f"p{k}": k / (len(values) - 1) for k in range(len(values))}
    got = q.quantiles(df, [], "v", probs).first()
    assert [got[f"p{k}"] for k in (0, 10)] == [-inf, inf]
    assert [got[f"p{k}"] for k in range(1, 10)] == sorted(values)[1:10]
