"""Gradient boosting over binned features: best-first trees from histograms, a round at a time.

Features are cut into bins once and rows are packed into blocks of bytes, so a pass over the data
is a pass over a few bytes a row. Per growth step one job sums, in every task and then up a tree of
tasks, a histogram (rows, residuals) per feature of the wanted nodes; of two siblings only the
smaller is counted, the other is its parent less it. The driver sees histograms, never rows: leaves
x features x bins numbers.

Trees grow best first: the leaf with the largest gain is split until ``leaves`` or ``depth`` is
reached. A step fetches the children of all leaves that could still be split, which gives the same
tree as one split at a time in fewer steps. Residuals are summed as whole numbers of a fixed step, so
the model does not depend on how rows are partitioned. After every round the loss on the held rows is
taken; training stops when it has not fallen for ``patience`` rounds, and the best round is kept.

Tasks keep their rows in mapped files of Spark's local folders, so a step neither sends rows to a
Python worker nor walks the trees again: it moves each row at most a level down from the node of the
last step. A cached table of file names draws tasks to the executor that has the files. A lost executor's
files are made anew from the packed blocks and the trees. Where tasks keep starting away from their files,
rows move to cached blocks, which hold the predictions: these are brought up to date every ``REFRESH``
rounds and written to the shared folder every ``CUT`` rounds, so lost executors replay a few rounds, never all.
"""

from __future__ import annotations

import heapq
import math
import os
import pickle
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import suppress
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import new_path
from tabularium.vocabulary import BOOST_DEPTH, BOOST_LEAF_ROWS, BOOST_LEAVES, BOOST_PATIENCE, BOOST_RATE, BOOST_ROUNDS

BINS = 255
BLOCK_ROWS = 1 << 14
STEP_BITS = 38  # a residual is a whole number of at most so many bits; fewer where that many rows would overflow
REFRESH = 8
CUT = 64
LEAF_WISE = {"leaves": BOOST_LEAVES, "depth": BOOST_LEAVES, "penalty": 0.0, "least": BOOST_LEAF_ROWS}
TASK_ROWS = 1 << 16  # rows of a task: steps are short, and starting tasks is most of what a small table costs
FAN_IN = 64  # partial histograms that meet in one task or in the driver
TRIES = 3  # of a step whose tasks do not find their files


class Tree(NamedTuple):
    """Nodes as arrays; the right child follows the left, a leaf is its own left child."""

    feature: np.ndarray
    cut: np.ndarray  # last bin that goes left
    left: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    depth: int

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every column of ``bins`` (features x rows)."""
        at = np.zeros(bins.shape[1], np.int64)
        for _ in range(self.depth):
            at = children(bins, at, self.feature, self.cut, self.left)
        return at


def children(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """One level down from the nodes ``at`` of the rows; a node that is its own left child and cuts at ``BINS`` is kept."""
    rows = bins.shape[1]
    cell = (feature * rows).take(at)
    cell += np.arange(rows)
    out = left.take(at)
    out += bins.ravel().take(cell) > cut.astype(np.uint8).take(at)
    return out


class Block(NamedTuple):
    bins: np.ndarray  # features x rows
    y: np.ndarray
    held: np.ndarray
    pred: np.ndarray


@dataclass
class Boosted:
    """A boosted model: a constant and trees whose values already carry the learning rate."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]
    history: list[tuple[int, float, float]] = field(default_factory=list)  # round, RMSE of training and held rows

    def bins(self, x: np.ndarray) -> np.ndarray:
        return bin_columns(x, self.edges)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Predictions of rows x features."""
        bins, out = self.bins(x), np.full(len(x), self.base)
        for t in self.trees:
            out += t.value[t.nodes(bins)]
        return out

    def predict(self) -> Column:
        """The prediction as a column, computed in Arrow batches; nulls count as 0."""
        own = (self.features, self.edges, self.base, self.trees)

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            model = Boosted(*own)
            for columns in batches:
                yield pd.Series(model.raw(np.column_stack([c.to_numpy(float) for c in columns])))

        return score(*[F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)) for n in self.features])

    def nodes(self) -> pd.DataFrame:
        """Node table (tree, weight, node, prediction, cover, left, right, feature, threshold); leaves have left -1."""
        tables = []
        for k, t in enumerate(self.trees):
            leaf = t.left == np.arange(len(t.left))
            limits = [math.nan if one else float(self.edges[f][c]) for one, f, c in zip(leaf, t.feature, t.cut)]
            tables.append(pd.DataFrame({
                "tree": k, "weight": 1.0, "node": np.arange(len(t.left)), "prediction": t.value, "cover": t.cover.astype(float),
                "left": np.where(leaf, -1, t.left), "right": np.where(leaf, -1, t.left + 1), "feature": t.feature, "threshold": limits,
            }))
        return pd.concat(tables, ignore_index=True) if tables else pd.DataFrame(columns=NODE_COLUMNS)

    def trace(self, spark: SparkSession) -> DataFrame:
        """One row per round: the loss on the training and on the held rows."""
        rows = [(r, float(a), float(b)) for r, a, b in self.history]  # at most as many as rounds
        return spark.createDataFrame(rows, "round long, train_rmse double, held_rmse double")


NODE_COLUMNS = ["tree", "weight", "node", "prediction", "cover", "left", "right", "feature", "threshold"]


def bin_columns(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every value: how many edges lie below it; an edge belongs to the bin it ends."""
    return np.stack([np.searchsorted(e, x[:, k]).astype(np.uint8) for k, e in enumerate(edges)])


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of at most ``bins`` bins per feature, from one sketch over all rows."""
    shares = [k / bins for k in range(1, bins)]
    found = df.agg(*[F.percentile_approx(_number(n), shares, 20 * bins).alias(str(k)) for k, n in enumerate(features)]).first()
    return [np.unique(np.array(found[str(k)] or [0.0], float)) for k in range(len(features))]


def even_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of ``bins`` bins of equal width between the least and the greatest value."""
    pairs = df.agg(*[f(_number(n)).alias(f"{f.__name__}{k}") for k, n in enumerate(features) for f in (F.min, F.max)]).first()
    out = []
    for k in range(len(features)):
        low, high = pairs[f"min{k}"] or 0.0, pairs[f"max{k}"] or 0.0
        out.append(np.unique([low + (high - low) * j / bins for j in range(1, bins)]))
    return out


def _number(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))


PACKED = "bins binary, y binary, held binary, pred binary"


def pack(df: DataFrame, features: Sequence[str], label: str, held: Column, edges: Sequence[np.ndarray], base: float, path: str) -> None:
    """Write the rows with a label as blocks of binned features, labels and predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = np.column_stack([part.column(k).to_numpy(zero_copy_only=False) for k in range(len(features))])
                y = part.column("_y").to_numpy(zero_copy_only=False)
                kept = part.column("_held").fill_null(False).to_numpy(zero_copy_only=False)
                yield to_batch(Block(bin_columns(x, edges), y, kept, np.full(len(y), base)))

    numbers = [_number(n).alias(f"_{k}") for k, n in enumerate(features)]
    rows = df.select(*numbers, F.col(label).cast("double").alias("_y"), held.alias("_held")).where("_y IS NOT NULL AND NOT isnan(_y)")
    rows.mapInArrow(run, PACKED).write.parquet(path)


def to_batch(block: Block) -> pa.RecordBatch:
    parts = (np.ascontiguousarray(block.bins), block.y.astype(float), block.held.astype(np.uint8), block.pred.astype(float))
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], [c.split()[0] for c in PACKED.split(", ")])


def to_row(block: Block) -> tuple:
    return tuple(c[0].as_py() for c in to_batch(block).columns)


def from_row(row) -> tuple:
    y = np.frombuffer(row[1])
    return np.frombuffer(row[0], np.uint8).reshape(-1, len(y)), y, np.frombuffer(row[2], np.uint8) > 0, np.frombuffer(row[3])


def node_sums(bins: np.ndarray, at: np.ndarray, whole: np.ndarray, wanted: Sequence[int], size: int) -> np.ndarray:
    """Rows and residual steps, (2, wanted, features, size), of the rows whose node is wanted."""
    slot = np.full(max(int(at.max(initial=0)), *wanted) + 1, -1)
    slot[list(wanted)] = np.arange(len(wanted)) * size
    own = slot.take(at)
    mine = np.flatnonzero(own >= 0)  # positions: taking by them is several times faster than by a mask
    own, rest, out = own.take(mine), whole.take(mine), np.empty((2, len(bins), len(wanted) * size), np.int64)
    for f, column in enumerate(bins):
        key = own + column.take(mine)
        out[0, f] = np.bincount(key, minlength=len(wanted) * size)
        # Whole numbers below 2 ** 53 in total: their float sums are exact.
        out[1, f] = np.bincount(key, weights=rest, minlength=len(wanted) * size)
    return out.reshape(2, len(bins), len(wanted), size).swapaxes(1, 2)


class Split(NamedTuple):
    gain: float
    feature: int
    cut: int
    left: tuple[int, int]  # rows and residual steps of the left child


def best_split(hist: np.ndarray, step: float, penalty: float, least: int) -> Split | None:
    """The split of the largest gain; ties go to the first feature, then to the lowest bin."""
    n, g = np.cumsum(hist[0], axis=1)[:, :-1], np.cumsum(hist[1], axis=1)[:, :-1]
    total_n, total_g = int(hist[0, 0].sum()), int(hist[1, 0].sum())
    right_n, right_g = total_n - n, total_g - g
    able = (n >= least) & (right_n >= least)
    if not able.any():
        return None
    square = lambda s, c: (s * step) ** 2 / (c + penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = square(g.astype(float), n) + square(right_g.astype(float), right_n) - square(float(total_g), total_n)
    gain = np.where(able, gain, -np.inf)
    at = int(np.argmax(gain))
    f, c = divmod(at, gain.shape[1])
    if not gain[f, c] > 1e-12 * max(1.0, square(float(total_g), total_n)):
        return None
    return Split(float(gain[f, c]), f, c, (int(n[f, c]), int(g[f, c])))


class _Grower:
    """The nodes of one tree while it grows."""

    def __init__(self, root: np.ndarray, rules: tuple[float, float, int], leaves: int, depth: int):
        self.rules, self.leaves, self.depth = rules, leaves, depth
        self.sums = [(int(root[0, 0].sum()), int(root[1, 0].sum()))]
        self.level, self.left, self.hist = [0], [0], {0: root}
        self.split = {0: best_split(root, *rules)}

    def open(self, node: int) -> int:
        """Make the children of a node whose split is known; returns the left one."""
        if self.left[node] == node:
            s, (n, g) = self.split[node], self.sums[node]
            self.left[node] = len(self.sums)
            for pair in (s.left, (n - s.left[0], g - s.left[1])):
                self.left.append(len(self.sums))
                self.sums.append(pair)
                self.level.append(self.level[node] + 1)
        return self.left[node]

    def opened(self) -> list[int]:
        """The nodes that have children, parents before them."""
        return [k for k, left in enumerate(self.left) if left != k]

    def smaller(self, node: int) -> int:
        left = self.open(node)
        return left if self.sums[left][0] <= self.sums[left + 1][0] else left + 1

    def learn(self, node: int, hist: np.ndarray) -> None:
        """Take the histogram of the smaller child; its sibling has what the parent has besides."""
        small = self.smaller(node)
        other = 2 * self.left[node] + 1 - small
        for child, own in ((small, hist), (other, self.hist[node] - hist)):
            self.hist[child] = own
            self.split[child] = best_split(own, *self.rules)
        del self.hist[node]

    def best_first(self) -> tuple[list[int], list[int]]:
        """The nodes split so far in best-first order, and those whose children must be known to go on."""
        done: list[int] = []
        heap = [(-self.split[0].gain, 0)] if self.split[0] and self.depth > 0 else []
        while heap and len(done) + 1 < self.leaves:
            _, node = heapq.heappop(heap)
            left = self.open(node)
            done.append(node)
            if self.level[left] >= self.depth or len(done) + 1 >= self.leaves:
                continue
            if left not in self.split:
                able = sorted([(-self.split[node].gain, node), *heap])[: self.leaves - len(done)]
                closed = [k for _, k in able if self.left[k] == k or self.left[k] not in self.split]
                return done, [k for k in closed if self.level[k] + 1 < self.depth]
            for child in (left, left + 1):
                if self.split[child]:
                    heapq.heappush(heap, (-self.split[child].gain, child))
        return done, []

    def tree(self, split: Sequence[int], rate: float) -> tuple[Tree, list[int]]:
        """The nodes reached by the given splits, renumbered, and their former numbers."""
        chosen, order, todo = set(split), {0: 0}, [0]
        while todo:
            node = todo.pop(0)
            if node in chosen:
                for child in (self.left[node], self.left[node] + 1):
                    order[child] = len(order)
                    todo.append(child)
        old = list(order)
        step, penalty, _ = self.rules
        inner = np.array([k in chosen for k in old])
        value = np.array([0.0 if k in chosen else rate * self.sums[k][1] * step / (self.sums[k][0] + penalty) if self.sums[k][0] else 0.0 for k in old])
        return Tree(
            np.array([self.split[k].feature if i else 0 for k, i in zip(old, inner)]),
            np.array([self.split[k].cut if i else BINS for k, i in zip(old, inner)]),
            np.array([order[self.left[k]] if i else order[k] for k, i in zip(old, inner)]),
            value, np.array([self.sums[k][0] for k in old]), max(self.level[k] for k in old),
        ), old


def sum_nodes(blocks: RDD, trees: Sequence[Tree], tree: Tree, wanted: Sequence[int], step: float, size: int, loss: bool) -> tuple[np.ndarray, np.ndarray]:
    """One job: the histograms of the wanted nodes of the growing ``tree`` and, for its first, the losses."""

    def run(part: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total, losses = 0, np.zeros(4)
        for block in map(Block._make, part):
            rest = block.y - predictions(block, trees)
            if loss:
                for k, rows in ((0, ~block.held), (2, block.held)):
                    losses[k : k + 2] += rest[rows] @ rest[rows], rows.sum()
            own = ~block.held
            at = tree.nodes(block.bins)
            total = total + node_sums(block.bins[:, own], at[own], np.rint(rest[own] / step), wanted, size)
        if not isinstance(total, int):
            yield total, losses

    return added(blocks.mapPartitions(run), np.zeros((2, len(wanted), 1, 1), np.int64), np.zeros(4))


def added(partial: RDD, *empty: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums of pairs of arrays, up a tree of tasks."""
    depth = max(1, math.ceil(math.log(max(partial.getNumPartitions(), 2), FAN_IN)))
    return partial.treeAggregate(empty, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1]), depth)


def predictions(block: Block, trees: Sequence[Tree]) -> np.ndarray:
    out = block.pred.copy()
    for t in trees:
        out += t.value[t.nodes(block.bins)]
    return out


class _Blocks:
    """The packed rows with the predictions so far, brought up to date as trees come in."""

    def __init__(self, spark: SparkSession, path: str, rows: int):
        self.spark, self.pending, self.old, self.tasks = spark, [], [], -(-rows // TASK_ROWS)
        self.rdd = self._read(path)

    def _read(self, path: str) -> RDD:
        packed = self.spark.read.schema(PACKED).parquet(path).coalesce(max(self.tasks, 1))
        return packed.rdd.map(from_row).persist(StorageLevel.MEMORY_AND_DISK)

    def add(self, tree: Tree, number: int) -> None:
        self.pending.append(tree)
        for rdd in self.old:
            rdd.unpersist()
        self.old = []
        if len(self.pending) >= REFRESH:
            self.refresh((number + 1) % CUT == 0)

    def refresh(self, write: bool) -> None:
        """Bring the predictions up to date."""
        pending, last = self.pending, self.rdd
        fresh = last.map(lambda b: (*b[:3], predictions(Block(*b), pending)))  # plain tuples: cached by value
        if write:
            path = new_path(self.spark, "boosting")
            self.spark.createDataFrame(fresh.map(lambda b: to_row(Block(*b))), PACKED).write.parquet(path)
            self.rdd = self._read(path)
        else:
            self.rdd = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        self.pending, self.old = [], [last]

    def close(self) -> None:
        for rdd in [*self.old, self.rdd]:
            rdd.unpersist()


def _step(n: int, base: float, spread: float) -> float:
    """The unit of the whole numbers that residuals are summed as."""
    return max(2 * (spread + abs(base)), 1e-300) / 2 ** min(STEP_BITS, 62 - int(n).bit_length())


class _Rules(NamedTuple):
    rounds: int
    patience: int
    rate: float
    leaves: int
    depth: int
    split: tuple[float, float, int]  # step, penalty and least rows of a child
    shape: tuple[int, int]  # features and bins of a histogram


@dataclass
class _Grown:
    """What a model has come to after some rounds."""

    trees: list[Tree] = field(default_factory=list)
    history: list[tuple[int, float, float]] = field(default_factory=list)
    best: tuple[float, int] = (math.inf, 0)


def _grow(rows: _Files | _Jobs, rules: _Rules) -> _Grown:
    """All rounds over ``rows``, which give sums over all rows."""
    grown = _Grown()
    for number in range(rules.rounds + 1):
        root, losses = rows.root()
        train_loss, held_loss = (math.sqrt(losses[k] / losses[k + 1]) if losses[k + 1] else math.nan for k in (0, 2))
        grown.history.append((number, train_loss, held_loss))
        if not losses[3] or held_loss < grown.best[0]:
            grown.best = (held_loss, number)
        if number == rules.rounds or number - grown.best[1] >= rules.patience:
            break
        grower = _Grower(root, rules.split, rules.leaves, rules.depth)
        while True:
            done, needed = grower.best_first()
            if not needed:
                break
            hists = rows.sums(grower, [grower.smaller(k) for k in needed])
            for j, k in enumerate(needed):
                grower.learn(k, hists[:, j])
        if not done:
            break
        tree, old = grower.tree(done, rules.rate)
        grown.trees.append(tree)
        rows.add(grower, tree, old, number)
    rows.close()
    return grown


class _Jobs:
    """Rows in cached blocks; every sum is a job."""

    def __init__(self, spark: SparkSession, path: str, rows: int, rules: _Rules, trees: Sequence[Tree] = ()):
        self.blocks, self.rules = _Blocks(spark, path, rows), rules
        self.blocks.pending = list(trees)
        if trees:
            self.blocks.refresh(False)
        self.stump = Tree(*[np.zeros(1, np.int64)] * 3, np.zeros(1), np.zeros(1), 0)

    def _sum(self, tree: Tree, wanted: Sequence[int], loss: bool) -> tuple[np.ndarray, np.ndarray]:
        return sum_nodes(self.blocks.rdd, self.blocks.pending, tree, wanted, self.rules.split[0], self.rules.shape[1], loss)

    def root(self) -> tuple[np.ndarray, np.ndarray]:
        hist, losses = self._sum(self.stump, [0], True)
        return hist[:, 0], losses

    def sums(self, grower: _Grower, wanted: Sequence[int]) -> np.ndarray:
        opened, old = grower.tree(grower.opened(), self.rules.rate)
        where = {k: j for j, k in enumerate(old)}
        return self._sum(opened, [where[k] for k in wanted], False)[0]

    def add(self, grower: _Grower, tree: Tree, old: list[int], number: int) -> None:
        self.blocks.add(tree, number)

    def close(self) -> None:
        self.blocks.close()


class _Kept(NamedTuple):
    """Rows of a partition, all of them training rows or all of them held; only training rows have a residual."""

    held: bool
    bins: np.ndarray
    y: np.ndarray
    pred: np.ndarray
    whole: np.ndarray | None


class _Walk(NamedTuple):
    """How rows get to the nodes of a step: ``moves`` levels down by the tables from step ``step`` - 1, or ``levels`` by ``whole`` from the root."""

    step: int
    moves: int
    tables: tuple[np.ndarray, ...]
    levels: int
    whole: tuple[np.ndarray, ...]


def merged(blocks: Iterable[Block]) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """Training and held rows apart (held, bins, y, pred), two times ``BLOCK_ROWS`` at a time but for the last.

    Twice the rows halve what a wide histogram costs a row, and sums of them are still exact.
    """
    waiting: dict[bool, list[tuple]] = {False: [], True: []}

    def full(held: bool, least: int) -> Iterator[tuple]:
        parts = waiting[held]
        if sum(len(p[1]) for p in parts) < least:
            return
        bins, y, pred = (np.concatenate([p[k] for p in parts], axis=-1) for k in range(3))
        start = 0
        while len(y) - start >= least:
            own = slice(start, start + 2 * BLOCK_ROWS)
            yield held, bins[:, own], y[own], pred[own]
            start += 2 * BLOCK_ROWS
        parts[:] = [(bins[:, start:], y[start:], pred[start:])]

    for block in blocks:
        for held in waiting:
            mine = np.flatnonzero(block.held == held)
            waiting[held].append((block.bins.take(mine, axis=1), block.y.take(mine), block.pred.take(mine)))
            yield from full(held, 2 * BLOCK_ROWS)
    for held in waiting:
        yield from full(held, 1)


class _Part:
    """The rows of a partition as files of a folder.

    A file is named by what it holds and gets its name when it is whole, so any attempt of a task finds
    all of it or nothing: ``base`` has bins, labels and first predictions, ``state-k`` predictions and
    residuals after k trees, ``at-k-s`` the nodes of training rows at step s of the next tree.
    """

    def __init__(self, folder: str, sizes: Sequence[tuple[bool, int]], features: int, trees: Sequence[bytes], step: float):
        self.folder, self.sizes, self.features, self.trees, self.step = folder, sizes, features, trees, step

    @classmethod
    def keep(cls, index: int, blocks: Iterable[Block]) -> Iterator[tuple[str, list[tuple[bool, int]]]]:
        """Write the base of a partition; yields its folder and the sizes of its chunks."""
        places = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")
        folder, sizes = tempfile.mkdtemp(prefix="boosting-", dir=places[index % len(places)]), []
        with open(f"{folder}/base", "wb") as out:
            for held, bins, y, pred in merged(blocks):
                for part in (y, pred, bins):
                    out.write(np.ascontiguousarray(part))
                out.write(bytes(-bins.size % 8))
                sizes.append((held, len(y)))
        yield folder, sizes

    def _map(self, name: str) -> np.ndarray | None:
        """A file as bytes, None where there is none."""
        path = f"{self.folder}/{name}"
        with suppress(FileNotFoundError):
            return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.empty(0, np.uint8)
        return None

    def _name(self, path: str, name: str, *old: str) -> None:
        """Give a whole file its name; the files it replaces go."""
        os.replace(path, f"{self.folder}/{name}")
        for n in old:
            with suppress(FileNotFoundError):
                os.unlink(f"{self.folder}/{n}")

    def _base(self) -> Iterator[_Kept]:
        data, start = self._map("base"), 0
        if data is None:
            raise FileNotFoundError(self.folder)
        for held, n in self.sizes:
            y, pred = data[start : start + 16 * n].view(np.float64).reshape(2, n)
            cells = self.features * n
            bins = np.asarray(data[start + 16 * n : start + 16 * n + cells]).reshape(self.features, n)
            yield _Kept(held, bins, np.asarray(y), np.asarray(pred), None)
            start += 16 * n + cells + -cells % 8

    def chunks(self, walk: _Walk | None = None, values: np.ndarray | None = None) -> Iterator[_Kept]:
        """The rows after all trees; ``walk`` leads to the nodes of the last tree, whose ``values`` they take."""
        k = len(self.trees)
        known, was = self._map(f"state-{k}"), self._map(f"state-{k - 1}") if walk else None
        nodes = self._nodes(k - 1, walk) if known is None and was is not None else None
        read, start = known if known is not None else was if nodes is not None else None, 0
        trees = [] if known is not None else [Tree(*pickle.loads(t)) for t in (self.trees if read is None else self.trees[-1:])]
        handle, path = (None, None) if known is not None else tempfile.mkstemp(dir=self.folder)
        with open(handle, "wb") if handle is not None else suppress() as out:
            for base in self._base():
                n, pred, whole = len(base.y), base.pred, None
                if read is not None:
                    size = 8 * n if base.held else 16 * n
                    own = np.asarray(read[start : start + size]).view(np.float64)
                    pred, whole, start = own[:n], None if base.held else own[n:], start + size
                if known is None:
                    if nodes is not None and not base.held:
                        pred = pred + values.take(self._down(base.bins, next(nodes), walk.moves, walk.tables))
                    else:
                        pred = predictions(Block(base.bins, base.y, None, pred), trees)
                    out.write(pred)
                    if not base.held:
                        whole = np.rint((base.y - pred) / self.step)
                        out.write(whole)
                yield base._replace(pred=pred, whole=whole)
        if known is None:
            self._name(path, f"state-{k}", f"state-{k - 1}", *([f"at-{k - 1}-{walk.step - 1}"] if walk else ()))

    @staticmethod
    def _down(bins: np.ndarray, at: np.ndarray, moves: int, tables: tuple[np.ndarray, ...]) -> np.ndarray:
        for _ in range(moves):
            at = children(bins, at, *tables)
        return at

    def _nodes(self, k: int, walk: _Walk) -> Iterator[np.ndarray] | None:
        """The nodes of training rows before a step of tree k, None where they are not known."""
        rows = [n for held, n in self.sizes if not held]
        if walk.step == 1:
            return (np.zeros(n, np.int64) for n in rows)
        data = self._map(f"at-{k}-{walk.step - 1}")
        if data is None:
            return None
        ends = np.cumsum([0, *rows]) * 4
        return (np.asarray(data[a:b]).view(np.int32).astype(np.int64) for a, b in zip(ends, ends[1:]))

    def root(self, walk: _Walk | None, values: np.ndarray | None, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """The histogram of all training rows, and the losses."""
        out, losses = np.zeros((2, *shape), np.int64), np.zeros(5)
        for chunk in self.chunks(walk, values):
            rest, k = chunk.y - chunk.pred, 2 if chunk.held else 0
            losses[k : k + 2] += rest @ rest, len(rest)
            if not chunk.held:
                # As in node_sums, but all rows are of one node.
                out[0] += np.stack([np.bincount(c, minlength=shape[1]) for c in chunk.bins])
                out[1] += np.stack([np.bincount(c, chunk.whole, shape[1]).astype(np.int64) for c in chunk.bins])
        return out, losses

    def sums(self, walk: _Walk, wanted: Sequence[int], shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """The histograms of the wanted nodes."""
        out, k = np.zeros((2, shape[0], len(wanted), shape[1]), np.int64).swapaxes(1, 2), len(self.trees)
        nodes = self._nodes(k, walk)
        handle, path = tempfile.mkstemp(dir=self.folder)
        with open(handle, "wb") as to:
            for chunk in self.chunks():
                if chunk.held:
                    continue
                if nodes is not None:
                    at = self._down(chunk.bins, next(nodes), walk.moves, walk.tables)
                else:
                    at = self._down(chunk.bins, np.zeros(len(chunk.y), np.int64), walk.levels, walk.whole)
                to.write(at.astype(np.int32))
                out += node_sums(chunk.bins, at, chunk.whole, wanted, shape[1])
        self._name(path, f"at-{k}-{walk.step}", f"at-{k}-{walk.step - 1}")
        return out, np.zeros(5)


class _Files:
    """Rows in files beside their tasks (``_Part``); ``_Jobs`` take over where tasks do not find them."""

    def __init__(self, spark: SparkSession, path: str, rows: int, rules: _Rules):
        self.spark, self.path, self.rows, self.rules, self.jobs = spark, path, rows, rules, None
        self.trees: list[Tree] = []
        self.sent: list[bytes] = []
        self.moved: set[int] = set()  # nodes of the growing tree whose rows have moved to their children
        self.steps, self.last = 0, (None, None)
        tasks = max(1, min(-(-rows // TASK_ROWS), spark.sparkContext.defaultParallelism))  # starting a task costs as much as many rows
        packed = spark.read.schema(PACKED).parquet(path).repartition(tasks)  # a step lasts as long as its largest task
        kept = packed.rdd.mapPartitionsWithIndex(lambda k, part: _Part.keep(k, (Block(*from_row(r)) for r in part)))
        self.parts = kept.persist(StorageLevel.MEMORY_AND_DISK)

    def _sum(self, work: Callable[[_Part], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray] | None:
        """What ``work`` finds in all partitions, None where some are not found again and again."""
        trees, features, step = list(self.sent), self.rules.shape[0], self.rules.split[0]

        def run(parts: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for folder, sizes in parts:
                try:
                    yield work(_Part(folder, sizes, features, trees, step))
                except FileNotFoundError:
                    yield np.zeros(1, np.int64), np.array([0.0, 0.0, 0.0, 0.0, 1.0])

        for _ in range(0 if self.jobs else TRIES):
            found = added(self.parts.mapPartitions(run), np.zeros(1, np.int64), np.zeros(5))
            if not found[1][4]:
                return found
        self.jobs = self.jobs or _Jobs(self.spark, self.path, self.rows, self.rules, self.trees)
        return None

    def _walk(self, grower: _Grower) -> _Walk:
        """To the nodes opened since the last step."""
        opened, levels = grower.opened(), {}
        fresh = set(opened) - self.moved
        self.moved |= fresh
        self.steps += 1
        for k in sorted(fresh, reverse=True):
            levels[k] = 1 + max(levels.get(grower.left[k], 0), levels.get(grower.left[k] + 1, 0))

        def tables(own: set[int]) -> tuple[np.ndarray, ...]:
            nodes = range(len(grower.left))
            splits = [(grower.split[k].feature, grower.split[k].cut, grower.left[k]) if k in own else (0, BINS, k) for k in nodes]
            return tuple(np.array(splits, np.int64).T.copy())

        return _Walk(self.steps, max(levels.values(), default=0), tables(fresh), max(grower.level), tables(set(opened)))

    def root(self) -> tuple[np.ndarray, np.ndarray]:
        (walk, values), shape = self.last, self.rules.shape
        self.moved, self.steps = set(), 0
        found = self._sum(lambda part: part.root(walk, values, shape))
        return found or self.jobs.root()

    def sums(self, grower: _Grower, wanted: Sequence[int]) -> np.ndarray:
        walk, shape = self._walk(grower), self.rules.shape
        found = self._sum(lambda part: part.sums(walk, wanted, shape))
        return found[0] if found else self.jobs.sums(grower, wanted)

    def add(self, grower: _Grower, tree: Tree, old: list[int], number: int) -> None:
        """Take a tree; rows below a leaf of it, at nodes opened in vain, have the value of the leaf."""
        if self.jobs:
            return self.jobs.add(grower, tree, old, number)
        where, leaf = {k: j for j, k in enumerate(old)}, [0] * len(grower.left)
        for k in grower.opened():  # parents come first
            inner = k in where and tree.left[where[k]] != where[k]
            for child in (grower.left[k], grower.left[k] + 1):
                leaf[child] = child if inner else leaf[k]
        self.last = self._walk(grower), np.array([tree.value[where[k]] for k in leaf])
        self.trees.append(tree)
        self.sent.append(pickle.dumps(tuple(tree)))

    def close(self) -> None:
        self.parts.foreach(lambda part: shutil.rmtree(part[0], ignore_errors=True))
        self.parts.unpersist()
        if self.jobs:
            self.jobs.close()


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    validation: Column,
    rounds: int = BOOST_ROUNDS,
    rate: float = BOOST_RATE,
    leaves: int | None = None,
    depth: int = BOOST_DEPTH,
    patience: int = BOOST_PATIENCE,
    penalty: float = 1.0,
    least: int = 1,
    bins: int = BINS,
    edges: Callable[[DataFrame, Sequence[str], int], list[np.ndarray]] = quantile_edges,
) -> Boosted:
    """Boosted regression trees for squared loss with early stopping on the rows where ``validation`` is true.

    ``leaves`` bounds a tree that grows best first (``depth`` then bounds it too); without it trees are
    full to ``depth``. Rows without a label are left out; null features count as 0. Without held rows
    all rounds are kept; without training rows the model is the constant 0.
    """
    spark = df.sparkSession
    held = F.coalesce(validation, F.lit(False))
    train = df.where(~held & F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")))
    n, base, spread = train.agg(F.count("*"), F.avg(label).cast("double"), F.max(F.abs(label)).cast("double")).first()
    limits = edges(train, features, bins)
    model = Boosted(list(features), limits, base or 0.0, [])
    if not n:
        return model
    step = _step(n, base, spread)
    path, size = new_path(spark, "boosting"), max(len(e) for e in limits) + 1
    pack(df, features, label, held, limits, model.base, path)
    rules = _Rules(rounds, patience, rate, leaves or 2**depth, depth, (step, penalty, least), (len(features), size))
    grown = _grow(_Files(spark, path, n, rules), rules)
    model.history = grown.history
    model.trees = grown.trees[: grown.best[1]]
    return model


def first_histogram(
    df: DataFrame, features: Sequence[str], label: str, bins: int = BINS,
    edges: Callable[[DataFrame, Sequence[str], int], list[np.ndarray]] = quantile_edges,
) -> DataFrame:
    """(feature, bin, n, residual): what the first growth step sums over all rows; empty bins are left out."""
    spark, path = df.sparkSession, new_path(df.sparkSession, "boosting")
    n, base, spread = df.agg(F.count(label), F.avg(label).cast("double"), F.max(F.abs(label)).cast("double")).first()
    limits, step = edges(df, features, bins), _step(n, base or 0.0, spread or 0.0)
    pack(df, features, label, F.lit(False), limits, base or 0.0, path)
    blocks = _Blocks(spark, path, n)
    stump, size = Tree(*[np.zeros(1, np.int64)] * 3, np.zeros(1), np.zeros(1), 0), max(len(e) for e in limits) + 1
    hist, _ = sum_nodes(blocks.rdd, [], stump, [0], step, size, False)
    blocks.close()
    filled = zip(*np.nonzero(hist[0, 0])) if n else ()
    rows = [(features[f], int(k), int(hist[0, 0, f, k]), float(hist[1, 0, f, k] * step)) for f, k in filled]
    return spark.createDataFrame(rows, "feature string, bin long, n long, residual double")  # features x bins numbers
