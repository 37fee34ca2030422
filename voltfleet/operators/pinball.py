"""Quantiles by boosted trees under the pinball loss.

Each tree is grown on the loss's gradient, which only says on which side of the present prediction a label lies, and its leaves
are then set to a quantile of what the labels still differ. All quantiles are fitted together. A level of a tree is one pass that
counts labels above and below by node, feature and bin in each task, so what is shuffled and comes to the driver is models times
nodes times bins, whatever the number of rows; counts are whole numbers, so a fit is the same in any order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut
from .ensembles import matrix


class Boosted(NamedTuple):
    """Bin edges by feature; start by quantile; feature and cut (last bin that goes left) by quantile, tree and node; leaf values."""

    features: list[str]
    quantiles: tuple[float, ...]
    edges: list[np.ndarray]
    start: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return self.value.shape[2].bit_length() - 1

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bins of rows; a null or NaN is in the last one, over all edges."""
        out = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)], axis=1)
        return np.where(np.isnan(x), np.array([len(e) + 1 for e in self.edges]), out).astype(np.int64)

    def node(self, bins: np.ndarray, model: int, tree: int, levels: int) -> np.ndarray:
        """The node of each row on a level, numbered from its left. A compare for each node; columns of ``bins`` should be contiguous."""
        at = np.zeros(len(bins), dtype=np.int16)
        for level in range(levels):
            right = np.zeros(len(bins), dtype=bool)
            for k in range(1 << level):
                place = (1 << level) - 1 + k
                right |= (bins[:, self.feature[model, tree, place]] > int(self.cut[model, tree, place])) & (at == k)
            at = 2 * at + right
        return at

    def predict(self, bins: np.ndarray, model: int, trees: int | None = None) -> np.ndarray:
        out = np.full(len(bins), self.start[model])
        for tree in range(self.value.shape[1] if trees is None else trees):
            out += self.value[model, tree, self.node(bins, model, tree, self.depth)]
        return out


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Labels, and bins with each feature's on end."""
    return batch.column("y").to_numpy(), np.stack([batch.column(i).to_numpy() for i in range(1, batch.num_columns)]).T


def _counts(rows: DataFrame, model: Boosted, tree: int, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(labels above the prediction, all labels) by model, node, feature and bin."""
    shape = (len(model.quantiles), 1 << level, len(model.features), width)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((*shape, 2), dtype=np.int64)
        for batch in batches:
            y, bins = _unpacked(batch)
            if not len(y):
                continue
            twice = 2 * bins.T.astype(np.int64)
            for m in range(shape[0]):
                over = y > model.predict(bins, m, tree)
                node = model.node(bins, m, tree, level).astype(np.int64) * (2 * width) + over
                for f in range(shape[2]):
                    sums[m, :, f] += np.bincount(node + twice[f], minlength=shape[1] * width * 2).reshape(shape[1], width, 2)
        above, every = sums[..., 1].reshape(-1), sums.sum(axis=-1).reshape(-1)
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(above[at]), pa.array(every[at])], names=["place", "above", "every"])

    total = rows.mapInArrow(add_up, "place long, above long, every long").groupBy("place").agg(F.sum("above").alias("above"), F.sum("every").alias("every")).toArrow()
    out = np.zeros((2, int(np.prod(shape))), dtype=np.int64)
    for i, name in enumerate(("above", "every")):
        out[i, total.column("place").to_numpy()] = total.column(name).to_numpy()
    return out[0].reshape(shape), out[1].reshape(shape)


def _split(model: Boosted, tree: int, level: int, above: np.ndarray, every: np.ndarray, least: int) -> None:
    """Cut each node of a level where the gradient's squared sums gain most; a node without a gain sends all rows left."""
    width = every.shape[3]
    for m, q in enumerate(model.quantiles):
        gradient = above[m] - (1 - q) * every[m]  # q for a label above, q - 1 for one below
        g, n = gradient.cumsum(axis=2), every[m].cumsum(axis=2)
        whole_g, whole_n = g[:, :, -1:], n[:, :, -1:]
        fits = (n >= least) & (whole_n - n >= least)
        gain = np.where(fits, g * g / np.maximum(n, 1) + (whole_g - g) ** 2 / np.maximum(whole_n - n, 1) - whole_g**2 / np.maximum(whole_n, 1), 0.0)
        gain = gain.reshape(len(gain), -1).round(9)
        best = gain.argmax(axis=1)
        found = gain[np.arange(len(gain)), best] > 0
        place = (1 << level) - 1 + np.arange(len(gain))
        model.feature[m, tree, place] = np.where(found, best // width, 0)
        model.cut[m, tree, place] = np.where(found, best % width, width)


def _leaves(rows: DataFrame, model: Boosted, tree: int, rate: float) -> None:
    """Set a tree's leaves to quantiles of what labels differ from the trees before, times the rate."""
    leaves = model.value.shape[2]

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, bins = _unpacked(batch)
            for m in range(len(model.quantiles)):
                yield pa.RecordBatch.from_arrays([pa.array(m * leaves + model.node(bins, m, tree, model.depth).astype(np.int64)), pa.array(y - model.predict(bins, m, tree))], names=["leaf", "rest"])

    found = rows.mapInArrow(rest, "leaf long, rest double").groupBy("leaf").agg(F.percentile_approx("rest", list(model.quantiles), 10_000).alias("q")).collect()
    for r in found:
        m, leaf = divmod(r["leaf"], leaves)
        model.value[m, tree, leaf] = rate * r["q"][m]


def fit(rows: DataFrame, features: list[str], label: str, quantiles: tuple[float, ...] = (0.1, 0.5, 0.9), trees: int = 12, depth: int = 3, rate: float = 0.3, bins: int = 32, least: int = 20) -> Boosted:
    """``trees`` for each quantile. Rows without a label don't count; with no rows predictions are NaN.

    ``least``: rows on either side of a cut. Quantiles of leaves are within a ten-thousandth in rank.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    rows = rows.select(number(label).alias("y"), *[number(f).alias(f) for f in features]).where("y is not null")
    shares = [k / bins for k in range(1, bins)]
    first = rows.agg(F.percentile_approx("y", list(quantiles), 10_000).alias("y"), *[F.percentile_approx(f, shares, 1000).alias(f) for f in features]).first()
    nodes, m = (1 << depth) - 1, len(quantiles)
    start = np.array(first["y"] or [np.nan] * m)
    model = Boosted(list(features), tuple(quantiles), [np.unique(first[f] or []) for f in features], start, np.zeros((m, trees, nodes), dtype=np.int64), np.full((m, trees, nodes), bins + 1), np.zeros((m, trees, nodes + 1)))
    if first["y"] is None:
        return model

    names = [f"bin{i}" for i in range(len(model.features))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.bins(matrix(batch, model.features)).astype(np.int16)
            yield pa.RecordBatch.from_arrays([batch.column("y"), *(pa.array(column) for column in found.T)], names=["y", *names])

    packed = cut(rows.mapInArrow(pack, ", ".join(["y double", *(f"{n} smallint" for n in names)])))  # read once for each level of each tree
    for tree in range(trees):
        for level in range(depth):
            _split(model, tree, level, *_counts(packed, model, tree, level, bins + 2), least)
        _leaves(packed, model, tree, rate)
    return model


def predict(model: Boosted, rows: DataFrame, key: str) -> DataFrame:
    """key and q: an array of the quantiles, in order (those that cross change places)."""
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.bins(matrix(batch, model.features))
            q = np.sort(np.stack([model.predict(bins, m) for m in range(len(model.quantiles))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(q.tolist(), type=pa.list_(pa.float64()))], names=[key, "q"])

    return rows.select(key, *[F.col(f).cast("double").alias(f) for f in model.features if f != key]).mapInArrow(run, f"`{key}` {kind}, q array<double>")


def loss(rows: DataFrame, label: str, quantiles: tuple[float, ...], q: str = "q") -> DataFrame:
    """One row: mean pinball loss of each quantile (array), and the share of labels at or under it (array)."""
    off = [F.col(label) - F.col(q)[i] for i in range(len(quantiles))]
    means = [F.avg(F.greatest(s * o, (s - 1) * o)) for s, o in zip(quantiles, off, strict=True)]
    return rows.agg(F.array(*means).alias("loss"), F.array(*[F.avg((o <= 0).cast("int")) for o in off]).alias("under"), F.count("*").alias("n"))
