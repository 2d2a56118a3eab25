"""Boosted trees against a plain reference that grows one split at a time over all rows."""

import math
import pathlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabularium.operators import boosting as b

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(8)
    n = 2500
    x = np.column_stack([rng.normal(0, 1, n), rng.integers(0, 6, n), np.where(rng.random(n) < 0.5, 0.0, rng.exponential(2, n))])
    y = 4 * np.sin(x[:, 0]) + x[:, 1] ** 2 / 4 + x[:, 2] + rng.normal(0, 0.3, n)
    pdf = pd.DataFrame(x, columns=NAMES).assign(y=y, id=np.arange(n))
    return pdf, spark.createDataFrame(pdf).repartition(6, "id").cache()


def reference(bins, y, rounds, rate, leaves, depth, penalty, least):
    """Predictions per round, leaves split one at a time by the largest gain."""
    pred, out = np.full(len(y), y.mean()), []
    for _ in range(rounds):
        rest = y - pred
        groups = [(np.arange(len(y)), 0)]

        def best(rows):
            g, n, found = rest[rows].sum(), len(rows), (0, None)
            for f in range(len(bins)):
                for cut in range(bins.max() + 1):
                    left = bins[f, rows] <= cut
                    k = left.sum()
                    if least <= k and least <= n - k:
                        s = rest[rows][left].sum()
                        gain = s**2 / (k + penalty) + (g - s) ** 2 / (n - k + penalty) - g**2 / (n + penalty)
                        if gain > found[0] + 1e-6:
                            found = (gain, (f, cut))
            return found

        gains = [best(r) for r, _ in groups]
        while len(groups) < leaves:
            able = [k for k, (_, level) in enumerate(groups) if level < depth and gains[k][1]]
            if not able:
                break
            k = max(able, key=lambda i: gains[i][0])
            rows, level = groups[k]
            f, cut = gains[k][1]
            left = bins[f, rows] <= cut
            groups[k : k + 1] = [(rows[left], level + 1), (rows[~left], level + 1)]
            gains[k : k + 1] = [best(r) for r, _ in groups[k : k + 2]]
        for rows, _ in groups:
            pred[rows] += rate * rest[rows].sum() / (len(rows) + penalty)
        out.append(pred.copy())
    return out


@pytest.mark.parametrize("shape", [dict(depth=3), dict(leaves=7, depth=20, penalty=0.0, least=15), dict(leaves=6, depth=3)])
def test_equals_one_split_at_a_time(frame, shape):
    pdf, df = frame
    model = b.fit_boosted(df, NAMES, "y", F.lit(False), rounds=4, rate=0.4, bins=12, **shape)
    bins = model.bins(pdf[NAMES].to_numpy())
    rules = {"leaves": 2 ** shape["depth"], "penalty": 1.0, "least": 1} | shape
    want = reference(bins, pdf["y"].to_numpy(), 4, 0.4, **rules)
    np.testing.assert_allclose(model.raw(pdf[NAMES].to_numpy()), want[-1], rtol=1e-7)
    for (number, loss, _), pred in zip(model.history[1:], want):
        assert math.isclose(loss, np.sqrt(np.mean((pdf["y"] - pred) ** 2)), rel_tol=1e-7)
    got = np.array([r.p for r in df.select("id", model.predict().alias("p")).orderBy("id").collect()])
    np.testing.assert_allclose(got, want[-1], rtol=1e-7)


def test_partitions_blocks_and_cuts_change_nothing(frame, monkeypatch):
    pdf, df = frame
    held = F.col("id") % 4 == 0
    one = b.fit_boosted(df.coalesce(1), NAMES, "y", held, rounds=9, rate=0.2, edges=b.even_edges, bins=20)
    monkeypatch.setattr(b, "BLOCK_ROWS", 100)
    monkeypatch.setattr(b, "REFRESH", 2)
    monkeypatch.setattr(b, "CUT", 4)
    monkeypatch.setattr(b, "FAN_IN", 2)
    monkeypatch.setattr(b, "TASK_ROWS", 50)
    many = b.fit_boosted(df.repartition(8), NAMES, "y", held, rounds=9, rate=0.2, edges=b.even_edges, bins=20)
    assert len(one.trees) == len(many.trees) == 9
    for s, t in zip(one.trees, many.trees):
        assert (s.feature == t.feature).all() and (s.cut == t.cut).all() and (s.cover == t.cover).all()
        np.testing.assert_allclose(s.value, t.value, rtol=1e-9)


def test_stops_after_patience_and_keeps_the_best_round(frame, spark):
    _, df = frame
    held = F.col("id") % 3 == 0
    model = b.fit_boosted(df, NAMES, "y", held, rounds=400, rate=0.5, patience=6, **{k: b.LEAF_WISE[k] for k in ("leaves", "depth")})
    losses = [h for _, _, h in model.history]
    assert len(model.history) - 1 < 400
    assert len(model.trees) == int(np.argmin(losses)) == len(losses) - 1 - 6
    train = [t for _, t, _ in model.history]
    assert all(x > y for x, y in zip(train, train[1:]))
    scored = df.where(held).agg(F.avg((F.col("y") - model.predict()) ** 2)).first()[0]
    assert math.isclose(math.sqrt(scored), min(losses), rel_tol=1e-9)
    assert model.trace(spark).count() == len(losses)


def test_histograms_and_siblings(frame):
    rng = np.random.default_rng(1)
    bins, at, whole = rng.integers(0, 5, (2, 300)).astype(np.uint8), rng.integers(0, 4, 300), rng.integers(-9, 9, 300).astype(float)
    got = b.node_sums(bins, at, whole, [2, 0], 5)
    for j, node in enumerate((2, 0)):
        for f in range(2):
            for k in range(5):
                mine = (at == node) & (bins[f] == k)
                assert got[0, j, f, k] == mine.sum() and got[1, j, f, k] == whole[mine].sum()


def test_degenerate_tables(spark):
    rows = [(None, 1.0, 5.0), (2.0, None, 5.0), (float("nan"), 1.0, None), (3.0, 2.0, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    constant = b.fit_boosted(df, ["a", "b"], "y", F.lit(None).cast("boolean"), rounds=5)
    assert constant.base == 5.0 and constant.trees == []
    assert {r[0] for r in df.select(constant.predict()).collect()} == {5.0}
    empty = b.fit_boosted(df.limit(0), ["a", "b"], "y", F.lit(False), rounds=5)
    assert empty.base == 0.0 and empty.trees == [] and len(empty.nodes()) == 0
    assert b.fit_boosted(df, ["a", "b"], "y", F.lit(True), rounds=5).base == 0.0


def kept_part(tmp_path, monkeypatch, trees=()):
    """A partition in files, with a third of its rows held."""
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    monkeypatch.setattr(b, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(3)
    bins, y, held = rng.integers(0, 9, (2, 300)).astype(np.uint8), rng.normal(0, 5, 300), np.arange(300) % 3 == 0
    blocks = [b.Block(bins[:, k : k + 70], y[k : k + 70], held[k : k + 70], np.full(len(y[k : k + 70]), 0.5)) for k in range(0, 300, 70)]
    ((folder, sizes),) = b._Part.keep(0, blocks)
    return (bins, y, held), lambda trees: b._Part(folder, sizes, 2, trees, 0.001)


def test_a_step_reads_the_rows_beside_it_and_walks_no_finished_tree(tmp_path, monkeypatch):
    (bins, y, held), part = kept_part(tmp_path, monkeypatch)
    tree = b.Tree(np.array([1, 0, 0]), np.array([3, b.BINS, b.BINS]), np.array([1, 1, 2]), np.array([0.0, 1.5, -2.0]), np.zeros(3), 1)
    sent = b.pickle.dumps(tuple(tree))
    hist, losses = part([sent]).root(None, None, (2, 9))
    rest = y - 0.5 - np.where(bins[1] <= 3, 1.5, -2.0)
    np.testing.assert_allclose(losses, [(rest[~held] ** 2).sum(), 200, (rest[held] ** 2).sum(), 100, 0])
    whole = np.rint(rest[~held] / 0.001)
    assert (hist[:, 1, 5] == [(bins[1, ~held] == 5).sum(), whole[bins[1, ~held] == 5].sum()]).all()
    tables = np.array([0, b.BINS, b.BINS]), np.array([4, b.BINS, b.BINS]), np.array([1, 1, 2])
    walk = b._Walk(1, 1, tables, 1, tables)
    got, _ = part([b"not a tree"]).sums(walk, [2], (2, 9))  # the state after one tree is there
    mine = bins[0, ~held] > 4
    assert (got[0, 0, 1] == np.bincount(bins[1, ~held][mine], minlength=9)).all()
    assert (got[1, 0, 1] == np.bincount(bins[1, ~held][mine], whole[mine], 9)).all()


@pytest.mark.parametrize("kind", ["state", "at", "folder"])
def test_lost_files_change_nothing(frame, monkeypatch, kind):
    _, df = frame
    held = F.col("id") % 4 == 0
    shape = dict(rounds=6, rate=0.3, leaves=6, depth=4, edges=b.even_edges, bins=20)
    want = b.fit_boosted(df, NAMES, "y", held, **shape)
    monkeypatch.setattr(b, "TASK_ROWS", 300)
    monkeypatch.setattr(b, "BLOCK_ROWS", 100)
    calls, seen = {"root": 0, "sums": 0}, []

    def lose(self, name):
        calls[name] += 1
        folders = [f for f, _ in self.parts.collect()]
        seen.append(len(folders))
        if kind == "folder" and calls["root"] == 3:
            b.shutil.rmtree(folders[0], ignore_errors=True)
        elif kind != "folder" and calls[name] % 2 == 0:
            for path in pathlib.Path(folders[-1]).glob(f"{kind}-*"):
                path.unlink()

    for name in ("root", "sums"):
        old = getattr(b._Files, name)
        monkeypatch.setattr(b._Files, name, lambda self, *a, old=old, name=name: (lose(self, name), old(self, *a))[1])
    got = b.fit_boosted(df, NAMES, "y", held, **shape)
    assert max(seen) > 1 and len(got.trees) == len(want.trees) == 6
    for s, t in zip(got.trees, want.trees):
        assert (s.feature == t.feature).all() and (s.cut == t.cut).all() and (s.cover == t.cover).all()
        np.testing.assert_allclose(s.value, t.value, rtol=1e-12)
    np.testing.assert_allclose([h[1:] for h in got.history], [h[1:] for h in want.history], rtol=1e-9)
