"""Tree ensembles as arrays: fitted ones of MLlib flattened, and additive ones that can leave any vehicle out.

A flattened ensemble is broadcast and walked by numpy in the tasks, so that a forecast which feeds on its own output is one pass
over the vehicles, however many steps it takes.

An additive ensemble's trees choose their cuts without a look at the labels, so a leaf is nothing but sums, and the sums of all
vehicles but one are a subtraction away: one pass over the rows gives as many models as there are vehicles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Flat(NamedTuple):
    """Nodes of all trees on end: feature (-1 at a leaf), cut, left and right child, value (a leaf's, times its tree's weight); roots."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node that is each row's leaf in each tree; a NaN goes right."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[node]
            inner = f >= 0
            goes_left = x[row, np.maximum(f, 0)] <= self.cut[node]
            node = np.where(inner, np.where(goes_left, self.left[node], self.right[node]), node)
        return node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features; NaN where a feature is."""
        out = self.value[self.leaves(x)].sum(axis=1)
        return np.where(np.isnan(x).any(axis=1), np.nan, out)


_LINE = re.compile(r"^( *)(?:(If|Else) \(feature (\d+) (?:<=|>) ([^)]+)\)|Predict: (\S+)|Tree \d+ \(weight ([^)]+)\):)$")


def flatten(model) -> Flat:  # noqa: ANN001
    """The nodes of an MLlib regression ensemble over continuous features, from its printed form, which has all digits."""
    feature, cut, left, right, value, roots = [], [], [], [], [], []
    weight, open_nodes, deepest = 1.0, [], 0
    for line in model.toDebugString.splitlines():
        found = _LINE.match(line)
        if not found:
            continue
        _, word, number, edge, leaf, tree = found.groups()
        if tree is not None:
            weight, open_nodes = float(tree), []
            roots.append(len(feature))
            continue
        if word == "Else":  # its node is known from the If
            while open_nodes[-1][1]:
                open_nodes.pop()
            open_nodes[-1][1] = True
            continue
        at = len(feature)
        while open_nodes and open_nodes[-1][1] and right[open_nodes[-1][0]] >= 0:
            open_nodes.pop()
        if open_nodes:
            parent, in_else = open_nodes[-1]
            (right if in_else else left)[parent] = at
        feature.append(int(number) if word else -1)
        cut.append(float(edge) if word else 0.0)
        value.append(0.0 if word else weight * float(leaf))
        left.append(-1)
        right.append(-1)
        if word:
            open_nodes.append([at, False])
            deepest = max(deepest, len(open_nodes))
    return Flat(*(np.array(x) for x in (feature, cut, left, right, value, roots)), deepest)


def leaf_labels(rows: DataFrame, trees: Flat, features: list[str], label: Column, most: int = 1 << 17) -> DataFrame:
    """leaf, y (the label, rounded to a hundredth), k: rows with it in each leaf of each tree, counted for about ``most`` rows at once
    before they are shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def counted(x: list[np.ndarray], y: list[np.ndarray]) -> pa.RecordBatch:
        values, place = np.unique(np.concatenate(y), return_inverse=True)
        key, k = np.unique(np.concatenate(x).astype(np.int64) * len(values) + place[:, None], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key // len(values)), pa.array(values[key % len(values)]), pa.array(k)], names=["leaf", "y", "k"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, n = [], [], 0
        for batch in batches:
            x.append(shared.value.leaves(matrix(batch, features)).astype(np.int32))
            y.append(batch.column("_label").to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= most:
                yield counted(x, y)
                x, y, n = [], [], 0
        if n:
            yield counted(x, y)

    taken = rows.select(*features, F.round(label, 2).cast("double").alias("_label")).where("_label is not null")
    return taken.mapInArrow(count, "leaf long, y double, k long").groupBy("leaf", "y").agg(F.sum("k").alias("k"))


class Shares(NamedTuple):
    """The labels in order, and the share of each among the rows of a leaf; ``at``: places of the nodes' shares, which are 0 without rows."""

    labels: np.ndarray
    at: np.ndarray
    share: np.ndarray

    @staticmethod
    def of(counts: DataFrame, trees: Flat) -> Shares:
        """From :func:`leaf_labels`, which come to the driver."""
        found = counts.toArrow()
        leaf, y, k = (found.column(name).to_numpy() for name in ("leaf", "y", "k"))
        labels, place = np.unique(y, return_inverse=True)
        leaves, row = np.unique(leaf, return_inverse=True)
        share = np.zeros((len(leaves) + 1, len(labels)))
        share[row, place] = k
        at = np.full(len(trees.feature), len(leaves))
        at[leaves] = np.arange(len(leaves))
        return Shares(labels, at, share / np.maximum(share.sum(axis=1, keepdims=True), 1))

    def quantiles(self, leaf: np.ndarray, wanted: tuple[float, ...]) -> np.ndarray:
        """Quantiles of the labels in the rows' leaves, each leaf weighing one, as ``percentile`` has them of whole thousandths of weights;
        NaN without any."""
        out = np.full((len(leaf), len(wanted)), np.nan)
        step = max((1 << 21) // max(len(self.labels), 1), 1)
        for start in range(0, len(leaf), step):
            weight = np.zeros((len(leaf[start : start + step]), len(self.labels)))
            for tree in self.at[leaf[start : start + step]].T:
                weight += self.share[tree]
            upto = np.ceil(weight * 1000).cumsum(axis=1)
            for i, q in enumerate(wanted):
                place = (upto[:, -1] - 1) * q
                low, high = (self.labels[(upto <= edge[:, None]).sum(axis=1)] for edge in (np.floor(place), np.ceil(place)))
                down = np.ceil(place) - place
                out[start : start + step, i] = np.where(upto[:, -1] == 0, np.nan, np.where(low == high, low, down * low + (1 - down) * high))
        return out


def next_loss(predicted: np.ndarray, observed: np.ndarray, most: float, gate: tuple[float, float] | None) -> np.ndarray:
    """A step's loss: between 0 and ``most``; with ``gate`` flat vehicles lose 0.35 of it, fast ones at least 1.25 of what was observed."""
    step = np.clip(predicted, 0.0, most)
    if gate:
        low, high = gate
        share = np.clip((observed - low) / (high - low), 0.0, 1.0)
        step = np.minimum((1 - share) * 0.35 * step + share * np.maximum(step, 1.25 * observed), most)
    return step


def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns], axis=1) if columns else np.empty((batch.num_rows, 0))


def stacked(batch: pa.RecordBatch, columns: dict[str, np.ndarray], months: int) -> pa.RecordBatch:
    """vin, h and columns (vehicle by step) as rows; NaN is null."""
    names = ["vin", "h", *columns]
    vin = batch.column("vin").take(pa.array(np.repeat(np.arange(batch.num_rows), months)))
    h = pa.array(np.tile(np.arange(1, months + 1, dtype=np.int32), batch.num_rows))
    return pa.RecordBatch.from_arrays([vin, h, *(pa.array(x.reshape(-1), from_pandas=True) for x in columns.values())], names=names)


def rolled(shared, bias: float, features: list[str], months: int, most: float, gate: tuple[float, float] | None):  # noqa: ANN001, ANN201
    """For ``mapInArrow``: the monthly model applied to its own output, all else frozen but the age."""

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = shared.value
        for batch in batches:
            x, state = matrix(batch, features), matrix(batch, ["soh", "age_months", "recent_loss"])
            out = np.empty((batch.num_rows, months))
            for h in range(months):
                state[:, 0] -= next_loss(flat(x) + bias, state[:, 2], most, gate)
                state[:, 1] += 1
                for name, column in (("soh", 0), ("age_months", 1)):
                    if name in features:
                        x[:, features.index(name)] = state[:, column]
                out[:, h] = state[:, 0]
            yield stacked(batch, {"p50": out}, months)

    return roll


class Additive(NamedTuple):
    """Trees of one cut for each level: feature and cut by tree and level. ``features`` are the columns' names."""

    features: list[str]
    feature: np.ndarray
    cut: np.ndarray

    @property
    def leaves(self) -> int:
        return 1 << self.feature.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, leaves of all trees numbered on end; a NaN is over every cut."""
        out = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for level in range(self.feature.shape[1]):
            out = 2 * out + ~(x[:, self.feature[:, level]] <= self.cut[:, level])
        return out + np.arange(len(self.feature)) * self.leaves


def additive(rows: DataFrame, features: list[str], trees: int = 48, depth: int = 6, bins: int = 32, seed: int = 0, always: tuple[str, ...] = ()) -> Additive:
    """Trees with cuts drawn from ``bins`` quantiles of the features, which is all that comes to the driver.

    Each tree cuts once by each of the features ``always``, and else by features drawn anew.
    """
    shares = [(k + 1) / (bins + 1) for k in range(bins)]
    edges = rows.select(*[F.percentile_approx(F.col(f).cast("double"), shares, 1000).alias(f) for f in features]).first()
    rng = np.random.default_rng(seed)
    feature, cut = np.empty((trees, depth), dtype=np.int64), np.zeros((trees, depth))
    for tree in range(trees):
        drawn = rng.integers(0, len(features), depth)
        drawn[: len(always)] = [features.index(f) for f in always]
        feature[tree] = drawn
        cut[tree] = [(edges[features[f]] or [0.0])[int(rng.integers(0, len(edges[features[f]] or [0.0])))] for f in drawn]
    return Additive(list(features), feature, cut)


def leaf_sums(rows: DataFrame, trees: Additive, label: str, weight: str) -> DataFrame:
    """vin, cell, s (sum of weight times label), w (sum of weights): added up in each task before they are shuffled.

    A vehicle has at most as many rows as the trees have leaves.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, w = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            cells = trees.cells(matrix(batch, trees.features))
            vins, own = np.unique(batch.column("vin").to_numpy(zero_copy_only=False), return_inverse=True)
            n = len(trees.feature)
            key, place = np.unique((own[:, None] * (n * trees.leaves) + cells).reshape(-1), return_inverse=True)
            s, k = (np.bincount(place, weights=np.repeat(v, n), minlength=len(key)) for v in (w * y, w))
            yield pa.RecordBatch.from_arrays([pa.array(vins[key // (n * trees.leaves)]), pa.array(key % (n * trees.leaves)), pa.array(s), pa.array(k)], names=["vin", "cell", "s", "w"])

    taken = rows.select(F.col("vin").cast("long").alias("vin"), *trees.features, F.col(label).alias("y"), F.col(weight).alias("w")).dropna(subset=["vin", "y", "w"])
    return taken.mapInArrow(add_up, "vin long, cell long, s double, w double").groupBy("vin", "cell").agg(F.sum("s").alias("s"), F.sum("w").alias("w"))


class Sums(NamedTuple):
    """Sums of labels and weights in each leaf, and of a tree as a whole."""

    s: np.ndarray
    w: np.ndarray

    def without(self, cells: np.ndarray, s: np.ndarray, w: np.ndarray) -> Sums:
        out = Sums(self.s.copy(), self.w.copy())
        out.s[cells] -= s
        out.w[cells] -= w
        return out

    def predict(self, trees: Additive, x: np.ndarray) -> np.ndarray:
        """Means of the rows' leaves over the trees; a leaf that has nothing left counts as the mean of all."""
        of_tree = slice(0, trees.leaves)
        whole = self.s[of_tree].sum() / max(self.w[of_tree].sum(), 1e-12)
        cells = trees.cells(x)
        w = self.w[cells]
        return np.where(w > 1e-9, self.s[cells] / np.maximum(w, 1e-9), whole).mean(axis=1)


def totals(sums: DataFrame, trees: Additive) -> Sums:
    """Sums over all vehicles: as many numbers as the trees have leaves."""
    rows = sums.groupBy("cell").agg(F.sum("s").alias("s"), F.sum("w").alias("w")).toArrow()
    out = Sums(*(np.zeros(len(trees.feature) * trees.leaves) for _ in range(2)))
    for part, name in zip(out, ("s", "w"), strict=True):
        part[rows.column("cell").to_numpy()] = rows.column(name).to_numpy()
    return out


def own_sums(sums: DataFrame, name: str) -> DataFrame:
    """vin and its sums as one array."""
    return sums.groupBy("vin").agg(F.collect_list(F.struct("cell", "s", "w")).alias(name))


class Lists:
    """Cells, sums and weights of each row of a column of :func:`own_sums`, as views of the column's own buffers; a null has none."""

    def __init__(self, column: pa.ListArray) -> None:
        self.ends, self.valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
        self.parts = [column.values.field(name).to_numpy(zero_copy_only=False) for name in ("cell", "s", "w")]

    def __getitem__(self, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = slice(self.ends[row], self.ends[row + 1]) if self.valid[row] else slice(0)
        return tuple(part[at] for part in self.parts)
