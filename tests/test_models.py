import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabularium.operators import forest, scoring, training
from tabularium.operators.encode import fit_target, one_hot, ordinal_code, apply_target, fit_categories
from tabularium.operators.boosting import fit_boosted
from tabularium.operators.tree_attribution import leaf_paths, batch_attributions, tree_attribution


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (3000, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + np.where(x[:, 2] > 0, 4, 0) + rng.normal(0, 0.1, 3000)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, id=np.arange(3000))
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def test_ridge_equals_closed_form(table):
    pdf, df = table
    model = training.fit_ridge(df, ["a", "b", "c"], "y", ["id"], alphas=[10.0])
    x = pdf[["a", "b", "c"]].to_numpy()
    xc, yc = x - x.mean(0), pdf["y"] - pdf["y"].mean()
    w = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc)
    np.testing.assert_allclose(list(model.coefs.values()), w, rtol=1e-9)
    terms = {r["term"]: r["coefficient"] for r in model.table(df.sparkSession).collect()}
    assert terms == {**model.coefs, "(intercept)": model.intercept}
    assert math.isclose(model.intercept, pdf["y"].mean() - x.mean(0) @ w, rel_tol=1e-9)


def test_ridge_cv_error_equals_refit(table):
    pdf, df = table
    model = training.fit_ridge(df, ["a", "b", "c"], "y", ["id"])
    folds = dict(df.select("id", F.pmod(F.xxhash64("id"), F.lit(5)).alias("f")).collect())
    f = pdf["id"].map(folds).to_numpy()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy()
    for alpha, got in model.cv_rmse.items():
        errs = []
        for k in range(5):
            tr, te = f != k, f == k
            m, ym = x[tr].mean(0), y[tr].mean()
            w = np.linalg.solve((x[tr] - m).T @ (x[tr] - m) + alpha * np.eye(3), (x[tr] - m).T @ (y[tr] - ym))
            errs.append(np.sqrt(np.mean((y[te] - ym - (x[te] - m) @ w) ** 2)))
        assert math.isclose(got, np.mean(errs), rel_tol=1e-6)
    assert model.alpha == min(model.cv_rmse, key=model.cv_rmse.get)


def test_ridge_keeps_its_digits_far_from_zero(spark):
    """Means of 10^9 and a spread of 1: raw products would lose all digits of the slopes."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (4000, 2))
    y = 2 * x[:, 0] - 3 * x[:, 1] + rng.normal(0, 0.01, 4000)
    pdf = pd.DataFrame(x + 1e9, columns=["a", "b"]).assign(y=y + 1e9, id=np.arange(4000))
    model = training.fit_ridge(spark.createDataFrame(pdf).repartition(3), ["a", "b"], "y", ["id"], alphas=[0.1])
    xc, yc = (x + 1e9) - (x + 1e9).mean(0), (y + 1e9) - (y + 1e9).mean()
    want = np.linalg.solve(xc.T @ xc + 0.1 * np.eye(2), xc.T @ yc)
    np.testing.assert_allclose(list(model.coefs.values()), want, rtol=1e-7)
    assert model.cv_rmse[0.1] < 0.02
    assert abs(model.intercept + 1e9 * sum(want) - (y + 1e9).mean() + 0.0) < 1e-3 * 1e9
    empty = training.fit_ridge(spark.createDataFrame(pdf[:1]), ["a", "b"], "y", ["id"], alphas=[0.1])
    assert list(empty.coefs.values()) == [0.0, 0.0]


def test_boosting_and_attribution(table, spark):
    _, df = table
    names = ["a", "b", "c"]
    model = fit_boosted(df, names, "y", F.col("id") % 5 == 0, rounds=6, rate=0.3)
    out = tree_attribution(df, model, names)
    scored = df.select("id", model.predict().alias("p"))
    both = out.join(scored, "id")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9
    spread = both.agg(F.var_samp("y"), F.avg((F.col("y") - F.col("p")) ** 2)).first()
    assert spread[1] < spread[0] / 2


def test_attribution_equals_brute_force(spark, table):
    """Every coalition of every tree evaluated by walking the tree."""
    pdf, df = table
    names = ["a", "b", "c"]
    model = fit_boosted(df, names, "y", F.col("id") % 5 == 0, rounds=3, rate=0.5)
    nodes = model.nodes()
    x = pdf[names].to_numpy()[:5]

    def value(tree, row, known, node=0):
        n = tree[node]
        if n["left"] < 0:
            return n["prediction"]
        if int(n["feature"]) in known:
            child = n["left"] if row[int(n["feature"])] <= n["threshold"] else n["right"]
            return value(tree, row, known, child)
        return sum(
            tree[c]["cover"] / n["cover"] * value(tree, row, known, c) for c in (n["left"], n["right"])
        )

    want = np.zeros(x.shape)
    for _, t in nodes.groupby("tree"):
        tree, w = t.set_index("node").to_dict("index"), t["weight"].iloc[0]
        for i, row in enumerate(x):
            for j in range(3):
                rest = [f for f in range(3) if f != j]
                for size in range(3):
                    coef = math.factorial(size) * math.factorial(2 - size) / 6
                    for s in itertools.combinations(rest, size):
                        want[i, j] += w * coef * (value(tree, row, {*s, j}) - value(tree, row, set(s)))
    np.testing.assert_allclose(batch_attributions(x, leaf_paths(nodes)), want, atol=1e-9)


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (4000, 2))
    x[:20] += 12
    df = spark.createDataFrame(pd.DataFrame(x, columns=["u", "v"]).assign(id=np.arange(4000)))
    results = []
    for parts in (1, 8):
        out = forest.isolation_forest(df.repartition(parts), ["u", "v"], trees=60)
        results.append({r["id"]: (r["iso_flag"], round(r["iso_score"], 12)) for r in out.collect()})
    assert results[0] == results[1]
    flagged = {i for i, (f, _) in results[0].items() if f}
    assert len(flagged) == 80 and set(range(20)) <= flagged


def test_forest_with_copies_and_constant_rows(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 2000, 1.0).otherwise(F.rand(1)).alias("u"), F.lit(2.0).alias("v")
    )
    out = forest.isolation_forest(df, ["u", "v"], trees=20)
    assert out.count() == 3000
    assert out.where("iso_flag").where("id < 2000").count() == 0


def test_forest_samples_ignore_partitions(spark):
    """Every tree samples rows without replacement, the same ones however the table is cut."""
    df = spark.range(50_000).withColumn("u", F.col("id") * 1.5)
    found = []
    for parts in (1, 7):
        s = forest.draw_samples(df.repartition(parts), ["u"], 20, 64, 1)
        found.append(sorted((r["tree"], r["pos"], r["x"][0]) for r in s.collect()))
    assert found[0] == found[1] and len(found[0]) == 20 * 64
    assert len({(t, x) for t, _, x in found[0]}) == 20 * 64
    whole = forest.draw_samples(df.limit(40), ["u"], 3, 64, 1).groupBy("tree").count().collect()
    assert {r["count"] for r in whole} == {40}


def test_forest_samples_copies_by_their_number(spark):
    """A row with a third of all copies is a third of the samples; ranks are those of single copies."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("u"))
    s = forest.draw_samples(df, ["u"], 40, 100, 2)
    share = s.agg(F.avg((F.col("x")[0] == 0.0).cast("int"))).first()[0]
    assert abs(share - 1 / 3) < 0.03
    keys = np.arange(1, 4, dtype=np.uint64)
    rank, number, rows = forest.least_ranks(keys, np.array([5, 1, 2000]), 0, 7, 2.0)
    for row, n in enumerate((5, 1, 2000)):
        mine = rank[rows == row]
        assert len(mine) == n and (np.diff(mine) >= 0).all() and 0 <= mine[0] and mine[-1] <= 1
    assert abs(rank[rows == 2].mean() - 0.5) < 0.05


def test_target_encoding_skew_and_unseen(spark):
    df = spark.createDataFrame(
        [("a", 10.0)] * 900 + [("b", 20.0)] * 50 + [(None, 5.0)] * 50, "c string, y double"
    )
    fit = fit_target(df, ["c"], "y")
    mean = (9000 + 1000 + 250) / 1000
    rows = {r["category"]: r["encoding"] for r in fit.collect()}
    w = 1 / (1 + math.exp(-(50 - 5) / 10))
    assert math.isclose(rows["b"], w * 20 + (1 - w) * mean)
    new = spark.createDataFrame([("zz",), (None,), ("a",)], "c string")
    got = [r[0] for r in apply_target(new, fit, "c").collect()]
    assert sorted(round(v, 6) for v in got) == sorted([round(mean, 6)] * 2 + [round(rows["a"], 6)])


def test_one_hot_drops_first_and_knows_no_new_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "c string")
    cats = fit_categories(df, ["c"])
    assert cats == {"c": ["a", "b", "c"]}
    out = one_hot(spark.createDataFrame([("a",), ("c",), ("new",), (None,)], "c string"), cats)
    assert [tuple(r) for r in out.select("c_b", "c_c").collect()] == [(0, 0), (0, 1), (0, 0), (0, 0)]


def test_ordinal_unknown_is_zero(spark):
    df = spark.createDataFrame([("Ex",), ("??",), (None,)], "q string")
    assert [r[0] for r in df.select(ordinal_code("q", {"Ex": 5, "Gd": 4})).collect()] == [5, 0, 0]


def test_champion_rules(spark):
    rows = [("m1", "val", 0.9, 1.0), ("m1", "test", 0.5, 3.0), ("m2", "val", 0.8, 2.0), ("m2", "test", 0.7, 1.0)]
    metrics = spark.createDataFrame(rows, "model string, split string, r2 double, rmse double")
    assert scoring.champion(metrics, "model", "split").first()["model"] == "m1"
    assert scoring.champion(metrics, "model", "split", "test").first()["model"] == "m2"
