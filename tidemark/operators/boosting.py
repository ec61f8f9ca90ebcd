"""Second-order boosted trees on binned rows, and a search that grows many trials in one pass.

Features are cut into bins once, at quantiles.  Rows are packed into blocks of ``BLOCK`` rows, one task each.  A
level of a tree is one Spark job: every block sums gradient and hessian per (trial, node,
feature, bin), the sums of the blocks are added after an exchange on (trial, node, feature), and the driver
receives the best split of each node - never rows.  A table of one block needs no exchange.  The
trees of all trials of a round are grown by the same jobs.

The leaf weight is ``-T(G) / (H + reg_lambda)``, the gain of a split the usual difference of
``T(G)^2 / (H + reg_lambda) / 2`` less ``gamma``, where T draws G towards 0 by ``reg_alpha``.  Missing values
(null or NaN) go to the side that gains more.  The loss is the squared error.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, new_dir

BLOCK = 65_536
REFRESH = 8  # trees between two writes of the blocks' margins
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class TreeParams:
    """Parameter names follow the usual boosting vocabulary."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    max_bins: int = 64

    @classmethod
    def of(cls, params: dict | None) -> TreeParams:
        unknown = set(params or {}) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        out = cls(**(params or {}))
        if not (2 <= out.max_bins <= 255 and 0 < out.subsample <= 1 and 0 < out.colsample_bytree <= 1 and out.max_depth >= 1):
            raise ValueError(f"parameter out of range: {out}")
        return out


@dataclass
class Tree:
    """Nodes in order of creation; ``feature`` is -1 in a leaf.  A row goes left if its bin is at most ``split``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    split: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, split: int, missing_left: bool, gain: float, values: tuple[float, float]) -> int:
        """Split a leaf; the right child follows the left one, whose number is returned."""
        at = len(self.feature)
        self.feature[node], self.split[node], self.missing_left[node], self.left[node], self.gain[node] = feature, split, missing_left, at, gain
        for name, more in (("feature", (-1, -1)), ("split", (0, 0)), ("missing_left", (False, False)), ("left", (0, 0)), ("value", values), ("gain", (0.0, 0.0))):
            getattr(self, name).extend(more)
        return at

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node each column of ``bins`` (features x rows, 0 = missing) ends in."""
        feature, split, missing, left = (np.asarray(v) for v in (self.feature, self.split, self.missing_left, self.left))
        node = np.zeros(bins.shape[1], np.int64)
        rows = np.arange(bins.shape[1])
        while len(rows) and (inner := feature[node[rows]] >= 0).any():
            rows = rows[inner]
            at = node[rows]
            b = bins[feature[at], rows]
            node[rows] = left[at] + ~np.where(b == 0, missing[at], b <= split[at])
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaves(bins)]


def to_bins(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin of each value: 1 + number of cuts below it; 0 where it is missing."""
    return np.where(np.isnan(values), 0, 1 + np.searchsorted(cuts, values, side="left")).astype(np.uint8)


def bin_cuts(df: DataFrame, features: Sequence[str], max_bins: int = 64) -> list[list[float]]:
    """Distinct quantiles of each feature from one pass with a mergeable sketch."""
    shares = [k / max_bins for k in range(1, max_bins)]
    number = [F.col(f"`{c}`").cast("double") for c in features]
    aggs = [F.percentile_approx(F.when(~F.isnan(c), c), shares, 20 * max_bins).alias(f"q{i}") for i, c in enumerate(number)]
    row = df.agg(*aggs).first()
    return [sorted(set(q or [])) for q in row]


# ------------------------------------------------------------------ blocks

_BLOCKS = "block long, n int, bins binary, y binary, ids binary, val binary, margin binary"


def _pack(df: DataFrame, features: Sequence[str], label: str, val: str | None, cuts: list[list[float]], rows: int) -> DataFrame:
    """The rows as binned blocks; rows without a label are left out."""
    numbers = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    flag = F.col(val) if val else F.lit(False)
    kept = df.select(*numbers, F.col(label).cast("double").alias("y"), flag.alias("val")).where(F.col("y").isNotNull() & ~F.isnan("y"))
    edges = [np.asarray(c) for c in cuts]
    parts = max(1, -(-rows // BLOCK))
    key = F.xxhash64(*[f"f{i}" for i in range(len(features))], "y")
    kept = kept.withColumn("id", key).repartition(parts).sortWithinPartitions("id", "y") if parts > 1 else kept.withColumn("id", key).coalesce(1).sortWithinPartitions("id", "y")

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= BLOCK:
                table = pa.Table.from_batches(held)
                yield block_of(table.slice(0, BLOCK))
                held, n = table.slice(BLOCK).to_batches(), n - BLOCK
        if n:
            yield block_of(pa.Table.from_batches(held))

    def block_of(table: pa.Table) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in table.columns]
        bins = np.stack([to_bins(columns[i], e) for i, e in enumerate(edges)])
        ids = columns[-1].astype(np.int64)
        # Equal rows count as rows of their own in subsampling.
        ids = (ids.view(np.uint64) + np.arange(len(ids), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        row = [int(ids[0]), len(ids), bins.tobytes(), columns[-3].astype(np.float64).tobytes(), ids.tobytes(), columns[-2].astype(np.uint8).tobytes(), b""]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["block", "n", "bins", "y", "ids", "val", "margin"])

    return kept.mapInArrow(run, _BLOCKS)


def _blocks(batch: pa.RecordBatch):
    for row in batch.to_pylist():
        n = row["n"]
        yield row, np.frombuffer(row["bins"], np.uint8).reshape(-1, n), np.frombuffer(row["y"]), np.frombuffer(row["ids"], np.uint64), np.frombuffer(row["val"], np.uint8).astype(bool)


def _chosen(ids: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Rows of a tree's subsample, by a hash of row and tree."""
    if share >= 1:
        return np.ones(len(ids), bool)
    h = (ids ^ np.uint64(seed * 0x9E3779B97F4A7C15 & _MASK)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share


# ------------------------------------------------------------------ splits


def best_split(g: np.ndarray, h: np.ndarray, p: TreeParams) -> tuple[np.ndarray, ...]:
    """Best split of each row of (rows x bins) sums, bin 0 holding the missing values.

    Returns gain, split bin, whether missing go left, and the left sums; the gain is -inf where no split is
    allowed.
    """

    def worth(g, h):
        t = np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)
        return np.where(h + p.reg_lambda > 0, t * t / np.where(h + p.reg_lambda > 0, h + p.reg_lambda, 1.0), 0.0)

    total_g, total_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
    below_g, below_h = np.cumsum(g[:, 1:], 1)[:, :-1], np.cumsum(h[:, 1:], 1)[:, :-1]
    options = []
    for with_missing in (False, True):
        lg, lh = below_g + (g[:, :1] if with_missing else 0.0), below_h + (h[:, :1] if with_missing else 0.0)
        rg, rh = total_g - lg, total_h - lh
        gain = 0.5 * (worth(lg, lh) + worth(rg, rh) - worth(total_g, total_h)) - p.gamma
        floor = max(p.min_child_weight, 1e-12)
        options.append((np.where((lh >= floor) & (rh >= floor), gain, -np.inf), lg, lh))
    rows = np.arange(len(g))
    gain = np.concatenate([options[0][0], options[1][0]], 1)
    at = gain.argmax(1)
    width = below_g.shape[1]
    side, b = at >= width, at % width
    lg, lh = (np.where(side, options[1][k][rows, b], options[0][k][rows, b]) for k in (1, 2))
    return gain[rows, at], b + 1, side, lg, lh


def leaf(g: float, h: float, p: TreeParams) -> float:
    if h + p.reg_lambda <= 0:
        return 0.0
    return -math.copysign(max(abs(g) - p.reg_alpha, 0.0), g) / (h + p.reg_lambda)


_SUMS = "trial int, node int, feature int, g binary, h binary"
_SPLITS = "trial int, node int, feature int, gain double, split int, missing_left boolean, lg double, lh double, g double, h double"


@dataclass
class _Trial:
    number: int
    params: TreeParams
    seed: int
    trees: list[Tree] = field(default_factory=list)
    written: int = 0  # trees that the margins of the blocks hold
    open: dict[int, tuple[float, float]] = field(default_factory=dict)  # leaves to split, their sums
    columns: list[int] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # validation RMSE before the 1st, 2nd, ... tree


def _level_sums(trials: list[_Trial], n_features: int, bins_n: int):
    """For each block and trial: validation loss and the sums of the open nodes."""

    def run(block):
        row, bins, y, ids, val = block
        margins = np.frombuffer(row["margin"]).reshape(-1, len(y))
        for t in trials:
            p = t.params
            margin = margins[t.number].copy()
            for tree in t.trees[t.written : -1]:
                margin += p.learning_rate * tree.predict(bins)
            tree, opened = t.trees[-1], sorted(t.open)
            if opened == [0] and val.any():
                miss = (margin - y)[val]
                yield t.number, -1, [(-1, np.array([miss @ miss]), np.array([float(len(miss))]))]
            node = tree.leaves(bins)
            place = np.full(len(tree.feature), -1)
            place[opened] = np.arange(len(opened))
            rows = np.flatnonzero((place[node] >= 0) & ~val & _chosen(ids, p.subsample, t.seed * 1_000_003 + len(t.trees)))
            where, grad = place[node[rows]], (margin - y)[rows]
            g = np.empty((len(opened), len(t.columns), bins_n))
            h = np.empty_like(g)
            for k, f in enumerate(t.columns):
                cell = where * bins_n + bins[f, rows]
                g[:, k] = np.bincount(cell, grad, len(opened) * bins_n).reshape(-1, bins_n)
                h[:, k] = np.bincount(cell, minlength=len(opened) * bins_n).reshape(-1, bins_n)
            for k, name in enumerate(opened):
                yield t.number, name, [(f, g[k, j], h[k, j]) for j, f in enumerate(t.columns)]

    return run


def _found(trial: int, node: int, features: list, g: np.ndarray, h: np.ndarray, p: TreeParams) -> list[tuple]:
    if node < 0:
        return [(trial, node, -1, 0.0, 0, False, 0.0, 0.0, float(g.sum()), float(h.sum()))]
    gain, split, side, lg, lh = best_split(g, h, p)
    k = int(gain.argmax())
    return [(trial, node, int(features[k]), float(gain[k]), int(split[k]), bool(side[k]), float(lg[k]), float(lh[k]), float(g[k].sum()), float(h[k].sum()))]


def _splits(blocks: DataFrame, trials: list[_Trial], n_features: int, bins_n: int, parts: int) -> list:
    """Best split of every open node, and the validation losses (node -1)."""
    sums = _level_sums(trials, n_features, bins_n)
    params = {t.number: t.params for t in trials}
    schema = pa.schema([("trial", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("split", pa.int32()), ("missing_left", pa.bool_()), *[(c, pa.float64()) for c in ("lg", "lh", "g", "h")]])

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def alone(batches):
        """One block holds the whole table: its sums are the totals."""
        found = [
            x for batch in batches for block in _blocks(batch) for trial, node, cells in sums(block)
            for x in _found(trial, node, [c[0] for c in cells], np.stack([c[1] for c in cells]), np.stack([c[2] for c in cells]), params[trial])
        ]
        if found:
            yield rows_of(found)

    def partial(batches):
        for batch in batches:
            for block in _blocks(batch):
                for trial, node, cells in sums(block):
                    n = len(cells)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([trial] * n, pa.int32()), pa.array([node] * n, pa.int32()), pa.array([c[0] for c in cells], pa.int32()), *[pa.array([c[k].tobytes() for c in cells], pa.binary()) for k in (1, 2)]],
                        names=["trial", "node", "feature", "g", "h"],
                    )

    def total(batches):
        key, g, h = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                now = row["trial"], row["node"], row["feature"]
                a, b = np.frombuffer(row["g"]), np.frombuffer(row["h"])
                if now == key:
                    g, h = g + a, h + b
                    continue
                if key:
                    yield rows_of(_found(key[0], key[1], [key[2]], g[None], h[None], params[key[0]]))
                key, g, h = now, a, b
        if key:
            yield rows_of(_found(key[0], key[1], [key[2]], g[None], h[None], params[key[0]]))

    if parts == 1:
        return blocks.mapInArrow(alone, _SPLITS).collect()
    keys = ["trial", "node", "feature"]
    best = blocks.mapInArrow(partial, _SUMS).repartition(min(parts, 200), *keys).sortWithinPartitions(*keys).mapInArrow(total, _SPLITS)
    order = F.struct("gain", (-F.col("feature")).alias("first"))
    picked = best.groupBy("trial", "node").agg(F.max_by(F.struct(*best.columns), order).alias("s"))
    return picked.select("s.*").collect()


def _grow(trials: list[_Trial], found: list) -> None:
    """Split the open nodes that gain, in all trials; their children are open next."""
    nodes: dict[int, list] = {t.number: [] for t in trials}
    for r in found:
        nodes[r["trial"]].append(r)
    for t in trials:
        p, tree, opened = t.params, t.trees[-1], {}
        deepest = len(t.open) > 0 and _depth(tree) + 1 >= p.max_depth
        for r in sorted(nodes[t.number], key=lambda r: r["node"]):
            if r["node"] < 0:
                t.losses.append(math.sqrt(r["g"] / r["h"]))
                continue
            if r["node"] == 0:
                tree.value[0] = leaf(r["g"], r["h"], p)
            if not r["gain"] > 0:
                continue
            sides = ((r["lg"], r["lh"]), (r["g"] - r["lg"], r["h"] - r["lh"]))
            at = tree.grow(r["node"], r["feature"], r["split"], r["missing_left"], r["gain"], tuple(leaf(*s, p) for s in sides))
            opened |= {at: sides[0], at + 1: sides[1]}
        t.open = {} if deepest else opened


def _depth(tree: Tree) -> int:
    depth = [0] * len(tree.feature)
    for node, f in enumerate(tree.feature):
        if f >= 0:
            depth[tree.left[node]] = depth[tree.left[node] + 1] = depth[node] + 1
    return max(depth)


class Grower:
    """Binned blocks of a table and the trials that grow on it."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, val: str | None, max_bins: int):
        self.features = list(features)
        train = df.where(~F.col(val)) if val else df
        stats = train.select(F.col(label).cast("double").alias("y")).where("y IS NOT NULL AND NOT isnan(y)").agg(F.avg("y").alias("mean"), F.count("*").alias("n")).first()
        if not stats.n:
            raise ValueError("no labelled training rows")
        self.base = float(stats.mean)
        self.cuts = bin_cuts(train, self.features, max_bins)
        self.bins_n = max_bins + 1
        rows = df.count() if val else stats.n
        self.blocks = cut(_pack(df, self.features, label, val, self.cuts, rows))
        self.parts = self.blocks.rdd.getNumPartitions() if rows > BLOCK else 1
        self.spark = df.sparkSession
        self._write = 0

    def start(self, trials: list[_Trial]) -> None:
        base, n = self.base, max(t.number for t in trials) + 1
        self._margins(lambda row, bins: np.full((n, bins.shape[1]), base))

    def _margins(self, of) -> None:
        """Write the blocks anew with the margins ``of(row, bins)``."""

        def run(batches):
            for batch in batches:
                margins = [of(block[0], block[1]).tobytes() for block in _blocks(batch)]
                yield batch.set_column(6, "margin", pa.array(margins, pa.binary()))

        path = new_dir(self.spark, "margins")
        old = self.blocks
        old.mapInArrow(run, _BLOCKS).write.parquet(path)
        self.blocks = self.spark.read.schema(old.schema).parquet(path).cache()

    def refresh(self, trials: list[_Trial]) -> None:
        """Add the trees since the last write to the margins."""
        new = [(t.number, t.params.learning_rate, t.trees[t.written :]) for t in trials if len(t.trees) > t.written]

        def of(row, bins):
            margin = np.frombuffer(row["margin"]).reshape(-1, bins.shape[1]).copy()
            for number, rate, trees in new:
                for tree in trees:
                    margin[number] += rate * tree.predict(bins)
            return margin

        old = self.blocks
        self._margins(of)
        old.unpersist()
        for t in trials:
            t.written = len(t.trees)

    def round(self, trials: list[_Trial]) -> None:
        """One more tree for each trial."""
        for t in trials:
            rng = random.Random(t.seed * 7_919 + len(t.trees))
            n = max(1, round(t.params.colsample_bytree * len(self.features)))
            t.columns = sorted(rng.sample(range(len(self.features)), n))
            t.trees.append(Tree())
            t.open = {0: (0.0, 0.0)}
        growing = trials
        while growing:
            _grow(growing, _splits(self.blocks, growing, len(self.features), self.bins_n, self.parts))
            growing = [t for t in growing if t.open]
        if any(len(t.trees) - t.written >= REFRESH for t in trials):
            self.refresh(trials)

    def loss(self, trials: list[_Trial]) -> None:
        """Validation losses after the last tree."""
        self.refresh(trials)
        numbers = [t.number for t in trials]

        def run(batches):
            for batch in batches:
                for row, bins, y, _, val in _blocks(batch):
                    miss = (np.frombuffer(row["margin"]).reshape(-1, len(y)) - y)[:, val]
                    yield pa.RecordBatch.from_pandas(pd.DataFrame({"trial": numbers, "s": [float(miss[k] @ miss[k]) for k in numbers], "n": float(val.sum())}), preserve_index=False)

        found = self.blocks.mapInArrow(run, "trial long, s double, n double").groupBy("trial").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
        for r in found:
            next(t for t in trials if t.number == r.trial).losses.append(math.sqrt(r.s / r.n))

    def model(self, trial: _Trial, trees: int | None = None) -> BoostedModel:
        return BoostedModel(self.features, self.cuts, self.base, trial.params.learning_rate, trial.trees[:trees])

    def close(self) -> None:
        self.blocks.unpersist()


@dataclass
class BoostedModel:
    """Trees with the bins they split; ``transform`` adds ``prediction``."""

    features: list[str]
    cuts: list[list[float]]
    base: float
    rate: float
    trees: list[Tree]

    def transform(self, df: DataFrame) -> DataFrame:
        cuts, base, rate, trees = [np.asarray(c) for c in self.cuts], self.base, self.rate, self.trees

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            bins = np.stack([to_bins(rows.iloc[:, i].to_numpy(np.float64, na_value=np.nan), c) for i, c in enumerate(cuts)])
            return pd.Series(base + rate * sum((t.predict(bins) for t in trees), np.zeros(len(rows))))

        inputs = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(self.features)]
        return df.withColumn("prediction", predict(F.struct(*inputs)))

    def importances(self) -> list[float]:
        """Mean gain of each feature's splits, as a share of all."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            for f, gain in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += gain
                    count[f] += 1
        mean = total / np.maximum(count, 1)
        return [float(v) for v in (mean / mean.sum() if mean.sum() else mean)]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The model as rows: one of kind ``head``, one per feature with its cuts, one per node."""
        rows = [("head", 0, 0, None, -1, 0, False, 0, self.base, self.rate, [])]
        rows += [("feature", 0, i, name, i, 0, False, 0, 0.0, 0.0, [float(c) for c in cuts]) for i, (name, cuts) in enumerate(zip(self.features, self.cuts))]
        rows += [
            ("node", k, i, None, t.feature[i], t.split[i], t.missing_left[i], t.left[i], t.value[i], t.gain[i], [])
            for k, t in enumerate(self.trees) for i in range(len(t.feature))
        ]
        return spark.createDataFrame(rows, "kind string, tree int, place int, name string, feature int, split int, missing_left boolean, left int, value double, gain double, cuts array<double>")

    def save(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: (r.kind, r.tree, r.place))
        head = next(r for r in rows if r.kind == "head")
        inputs = [r for r in rows if r.kind == "feature"]
        trees: list[Tree] = []
        for r in (r for r in rows if r.kind == "node"):
            if r.place == 0:
                trees.append(Tree([], [], [], [], [], []))
            for name in ("feature", "split", "missing_left", "left", "value", "gain"):
                getattr(trees[-1], name).append(r[name])
        return cls([r["name"] for r in inputs], [list(r.cuts) for r in inputs], head.value, head.gain, trees)


@dataclass(frozen=True)
class Booster:
    """``fit`` grows the trees of one set of parameters."""

    features: tuple[str, ...]
    label: str
    params: TreeParams = TreeParams()
    seed: int = 42

    def fit(self, df: DataFrame) -> BoostedModel:
        grower = Grower(df, self.features, self.label, None, self.params.max_bins)
        try:
            trial = _Trial(0, self.params, self.seed)
            grower.start([trial])
            for _ in range(self.params.n_estimators):
                grower.round([trial])
            return grower.model(trial)
        finally:
            grower.close()


# Rungs of the search as numbers of trees; after each the better quarter goes on.
RUNGS = (12, 48, 192)
PATIENCE = 20


def search(
    train: DataFrame, val: DataFrame, features: Sequence[str], label: str, trials: Sequence[dict], *, seed: int = 42,
    rungs: Sequence[int] = RUNGS, keep: float = 0.25, patience: int = PATIENCE,
) -> tuple[list[dict], BoostedModel, dict]:
    """All trials over one binned table, the losing ones dropped by successive halving.

    All trials of a round are grown by the same jobs.  At each rung (a number of trees) only the
    share ``keep`` with the smallest validation RMSE so far goes on; a trial also ends at its own
    number of trees, or when ``patience`` trees in a row brought nothing.  Returns a row per trial (trees grown,
    best RMSE, the trees it took, the rung it left at), the best model cut to its best
    number of trees, and its parameters.
    """
    params = [TreeParams.of(p) for p in trials]
    bins = {p.max_bins for p in params}
    if len(bins) != 1:
        raise ValueError("trials share one binned table: max_bins must be the same")
    both = train.select(*features, label).withColumn("__val", F.lit(False)).unionByName(val.select(*features, label).withColumn("__val", F.lit(True)))
    grower = Grower(both, features, label, "__val", bins.pop())
    every = [_Trial(k, p, seed + k) for k, p in enumerate(params)]
    left: dict[int, str] = {}

    def best(t: _Trial) -> float:
        return min(t.losses[1:], default=math.inf)

    try:
        grower.start(every)
        active = list(every)
        grown = 0
        while active:
            grower.round(active)
            grown += 1
            ended = []
            for t in active:
                stale = len(t.losses) - 1 - int(np.argmin(t.losses)) if t.losses else 0
                if grown >= t.params.n_estimators:
                    ended.append((t, "complete"))
                elif stale >= patience:
                    ended.append((t, "no gain"))
            rung = grown in rungs
            measured = rung or any(why == "complete" for _, why in ended)
            if measured:
                grower.loss(active)
            left |= {t.number: why for t, why in ended}
            active = [t for t in active if t.number not in left]
            if rung and active:
                order = sorted(active, key=lambda t: (best(t), t.number))
                n = max(1, math.ceil(keep * len(order)))
                left |= {t.number: f"rung {grown}" for t in order[n:]}
                active = order[:n]
            if measured:
                for t in active:  # the same loss is measured again before the next tree
                    t.losses.pop()
        rows = [
            {"trial": t.number, "n_trees": len(t.trees), "rmse": best(t), "best_trees": int(np.argmin(t.losses[1:])) + 1, "ended": left[t.number], "params": {k: float(v) for k, v in trials[t.number].items()}}
            for t in every
        ]
        winner = min(every, key=lambda t: (best(t), t.number))
        return rows, grower.model(winner, int(np.argmin(winner.losses[1:])) + 1), dict(trials[winner.number])
    finally:
        grower.close()
