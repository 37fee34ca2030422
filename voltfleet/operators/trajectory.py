"""Boosted trees for the loss over a horizon, fitted on vehicles' histories instead of a table of pairs of months.

A vehicle's row holds its months in order; a task makes the pairs of a month and each later one in pieces of bounded size, adds
them up and forgets them, so what is stored grows with the months and not with their pairs. Of a pair only the horizon is not its
anchor's, so pairs are added up by anchor and bin of the horizon, and trees are walked by anchors. A level of a tree is one pass;
what is shuffled and comes to the driver is nodes times bins, whatever the number of vehicles.

The trees are those of gradient boosting with absolute loss: the first fits the loss itself, each later one the side of the
present prediction that a pair lies on, and adds ``rate`` of it.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..sources.shared import cut_once

#: Pairs that a task holds at once.
PIECE = 1 << 17
#: Models that are fitted by the same passes, and tasks whose sums come to the driver as they are.
TOGETHER, FEW = 16, 64


class Trees(NamedTuple):
    """Feature (-1: all go left), edge (up to it rows go left), its number and gain by tree and node; leaf values by tree.

    ``features`` are the columns' names, the horizon being the first; ``edges`` what they are cut at.
    """

    features: list[str]
    edges: list[np.ndarray]
    feature: np.ndarray
    edge: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        return self.value.shape[1].bit_length() - 1

    def reached(self, bins: np.ndarray, trees: slice, levels: int) -> np.ndarray:
        """Nodes of a level of the trees by anchors: whether the anchor's own features lead to the node at some horizon.

        ``bins``: features by anchors, the horizon's being 0.
        """
        f, edge = self.feature[trees, : (1 << levels) - 1], self.edge[trees, : (1 << levels) - 1]
        left = bins[np.maximum(f, 0)] <= edge[:, :, None].astype(bins.dtype)
        right = ~left | (f == 0)[:, :, None]
        out = np.ones((len(f), 1, bins.shape[1]), dtype=bool)
        for level in range(levels):
            own, n = slice((1 << level) - 1, (2 << level) - 1), 1 << level
            out = np.stack([out & left[:, own], out & right[:, own]], axis=2).reshape(len(f), 2 * n, -1)
        return out.reshape(-1, bins.shape[1])

    def spans(self, tree: int, levels: int) -> np.ndarray:
        """Nodes of a level by bins of the horizon: 1 where the horizon leads to the node for some anchor."""
        bins = np.arange(len(self.edges[0]) + 1)
        out = np.ones((1, len(bins)))
        for level in range(levels):
            at = (1 << level) - 1 + np.arange(1 << level)
            left = np.where((self.feature[tree, at] == 0)[:, None], bins <= self.edge[tree, at][:, None], 1)
            right = np.where((self.feature[tree, at] == 0)[:, None], 1 - left, 1)
            out = np.stack([out * left, out * right], axis=1).reshape(-1, len(bins))
        return out

    def steps(self, trees: int) -> np.ndarray:
        """What each leaf of the first trees adds, by bins of the horizon."""
        return np.concatenate([self.spans(t, self.depth) * self.value[t][:, None] for t in range(trees)]).T if trees else np.empty((0, 0))

    def by_horizon(self, bins: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """The prediction of those trees by bins of the horizon and anchors."""
        return steps @ self.reached(bins, slice(steps.shape[1] >> self.depth), self.depth).astype(float)

    def column(self) -> Column:
        """The prediction as an expression, in SQL since a call of the JVM for each node takes seconds; null where a feature is."""
        name = [f"`{f.replace('`', '``')}`" for f in self.features]

        def node(tree: int, place: int) -> str:
            if place >= self.feature.shape[1]:
                return f"{float(self.value[tree, place - self.feature.shape[1]])!r}D"
            f = int(self.feature[tree, place])
            if f < 0:
                return node(tree, 2 * place + 1)
            edge = float(self.edges[f][self.edge[tree, place]])
            return f"CASE WHEN {name[f]} <= {edge!r}D THEN {node(tree, 2 * place + 1)} ELSE {node(tree, 2 * place + 2)} END"

        known = " AND ".join(f"{f} IS NOT NULL AND NOT isnan(CAST({f} AS DOUBLE))" for f in name)
        return F.expr(f"CASE WHEN {known} THEN {' + '.join(node(tree, 0) for tree in range(len(self.feature)))} END")

    def losses(self, x: np.ndarray, months: int) -> np.ndarray:
        """The prediction by rows of the anchors' features and horizons of 1 to ``months``; NaN where a feature is."""
        bins = np.stack([np.zeros(len(x), dtype=int), *(np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges[1:]))])
        at, out = np.searchsorted(self.edges[0], np.arange(1, months + 1), "left"), np.zeros((len(x), months))
        for tree in range(len(self.feature)):  # of a tree's leaves one counts, so sums are those of the expression
            out += self.reached(bins, slice(tree, tree + 1), self.depth).T.astype(float) @ (self.spans(tree, self.depth) * self.value[tree][:, None])[:, at]
        out[np.isnan(x).any(axis=1)] = np.nan
        return out

    def ahead(self, at: DataFrame, months: int) -> DataFrame:
        """``at`` with h and horizon, 1 to ``months``, and raw, the prediction: an anchor walks each tree once for all its steps."""

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in self.features[1:]], axis=1)
                raw = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * months), pa.array(self.losses(x, months).reshape(-1), from_pandas=True))
                yield pa.RecordBatch.from_arrays([*batch.columns, raw], names=[*batch.schema.names, "raws"])

        rows = at.mapInArrow(predict, StructType([*at.schema.fields, StructField("raws", ArrayType(DoubleType()))]))
        steps = rows.select(*at.columns, F.posexplode("raws").alias("h", "raw")).withColumn("h", F.col("h") + 1)
        return steps.withColumn("horizon", F.col("h").cast("double"))

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", self.column())

    def importances(self) -> np.ndarray:
        """Shares of the features in all gains."""
        out = np.bincount(self.feature[self.feature >= 0], self.gain[self.feature >= 0], len(self.features))
        return out / max(out.sum(), 1e-300)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("features", f, e.tolist()) for f, e in zip(self.features, self.edges, strict=True)]
        rows += [(name, str(t), x.astype(float).tolist()) for name in ("feature", "edge", "gain", "value") for t, x in enumerate(getattr(self, name))]
        spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "place int, part string, name string, numbers array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Trees:
        rows = spark.read.parquet(path).orderBy("place").collect()
        part = lambda name: [np.array(r["numbers"]) for r in rows if r["part"] == name]
        grown = {name: np.stack(part(name)).astype(kind) for name, kind in (("feature", int), ("edge", int), ("gain", float), ("value", float))}
        return Trees([r["name"] for r in rows if r["part"] == "features"], part("features"), **grown)


class Piece(NamedTuple):
    """Anchors' features, and the pairs: place of the anchor, horizon and loss."""

    x: np.ndarray
    anchor: np.ndarray
    horizon: np.ndarray
    loss: np.ndarray


def pieces(batch: pa.RecordBatch, features: list[str], least: int) -> Iterator[Piece]:
    """All pairs of the vehicles of a batch, at most about ``PIECE`` at once.

    Anchors have ``least`` months or more, themselves included, and all features; later months are those of a greater age.
    """
    if not len(batch):
        return
    sizes, age, soh, x = _columns(batch, features)
    yield from _pieces(sizes, age, soh, x, ~np.isnan(x).any(axis=1), least)


def _columns(batch: pa.RecordBatch, features: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of months of the vehicles; age, soh and the features of the months."""
    months = batch.column("months")
    flat = months.flatten()
    column = lambda name: flat.field(name).to_numpy(zero_copy_only=False).astype(float)
    return np.diff(months.offsets.to_numpy()), column("age_months"), column("soh"), np.stack([column(f) for f in features], axis=1)


def _pieces(sizes: np.ndarray, age: np.ndarray, soh: np.ndarray, x: np.ndarray, known: np.ndarray, least: int) -> Iterator[Piece]:
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(ends))
    at = at[(at - (ends - np.repeat(sizes, sizes)) >= least - 1) & (ends - at > 1) & known]
    later = ends[at] - at - 1
    before = np.cumsum(later) - later
    for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(before // PIECE)) + 1):
        part = part[np.argsort(-later[part], kind="stable")]  # so those with a k-th later month come first
        own, n = at[part], later[part]
        reach = np.searchsorted(-n, -np.arange(1, n[0] + 1 if len(n) else 1), "right")
        stops = reach.cumsum()
        anchor, horizon, loss = np.empty(n.sum(), dtype=np.int64), np.empty(n.sum()), np.empty(n.sum())
        places, own_age, own_soh = np.arange(len(own)), age[own], soh[own]
        for k, (m, stop) in enumerate(zip(reach.tolist(), stops.tolist(), strict=True), 1):
            other = own[:m] + k
            anchor[stop - m : stop] = places[:m]
            np.subtract(age[other], own_age[:m], out=horizon[stop - m : stop])
            np.subtract(own_soh[:m], soh[other], out=loss[stop - m : stop])
        np.maximum(loss, 0.0, out=loss)
        good = (horizon > 0) & (loss >= 0)
        yield Piece(x[own], anchor, horizon, loss) if good.all() else Piece(x[own], anchor[good], horizon[good], loss[good])


PACKED = "sets long, sizes binary, age binary, soh binary, bins binary"


def _by_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The vehicles of a batch by the models that they train, whose numbers are the bits of sets; without that column they train one."""
    if "sets" not in batch.schema.names:
        yield 1, batch
        return
    sets = batch.column("sets").to_numpy()
    kinds = np.unique(sets).tolist()
    for kind in kinds:
        yield kind, batch if len(kinds) == 1 else batch.take(pa.array(np.flatnonzero(sets == kind)))


def _numbers(sets: int) -> list[int]:
    return [k for k in range(sets.bit_length()) if sets >> k & 1]


def packed(rows: DataFrame, features: list[str], edges: list[np.ndarray]) -> DataFrame:
    """:func:`packed_each` for one model, which all vehicles train."""
    return packed_each(rows, features, [edges])


def packed_each(rows: DataFrame, features: list[str], edges: list[list[np.ndarray]]) -> DataFrame:
    """A row for each run of vehicles that train the same models, with about ``PIECE`` pairs: those models, numbers of months, and by
    month age, soh and the features' bins (-1 unknown) in each of the models. ``edges``: of each model."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for sets, batch in _by_sets(whole):
                if not len(batch):
                    continue
                sizes, age, soh, x = _columns(batch, features)
                own = [(i, e) for k in _numbers(sets) for i, e in enumerate(edges[k])]
                bins = np.stack([np.where(np.isnan(x[:, i]), -1, np.searchsorted(e, x[:, i], "left")) for i, e in own], axis=1).astype(np.int16)
                pairs = np.cumsum(sizes * (sizes - 1) // 2)
                stops = np.append(np.flatnonzero(np.diff(pairs // PIECE)) + 1, len(sizes))
                months = np.append(0, np.cumsum(sizes))
                for start, stop in zip(np.append(0, stops[:-1]), stops, strict=True):
                    run = slice(months[start], months[stop])
                    values = (sizes[start:stop].astype(np.int64), age[run], soh[run], bins[run])
                    yield pa.RecordBatch.from_arrays([pa.array([sets]), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names=["sets", "sizes", "age", "soh", "bins"])

    return rows.mapInArrow(pack, PACKED)


def _unpacked(batch: pa.RecordBatch, features: int, least: int) -> Iterator[tuple[list[int], Piece]]:
    """Of :func:`packed_each` rows the models, and the pairs; x has the features' bins in each of the models, in order."""
    kinds = {"sizes": np.int64, "age": float, "soh": float, "bins": np.int16}
    for sets, *row in zip(batch.column("sets").to_pylist(), *(batch.column(name) for name in kinds), strict=True):
        sizes, age, soh, bins = (np.frombuffer(v.as_buffer(), kind) for v, kind in zip(row, kinds.values(), strict=True))
        own = _numbers(sets)
        bins = bins.reshape(-1, len(own) * features)
        for piece in _pieces(sizes, age, soh, bins, (bins[:, :features] >= 0).all(axis=1), least):
            yield own, piece


def _horizon_bins(horizon: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """``np.searchsorted(edges, horizon)`` for edges of :func:`_horizons`, which lie half way between hundredths, by a table of hundredths."""
    whole = (edges * 100).astype(np.int64)
    below = np.searchsorted(whole, np.arange((whole[-1] if len(whole) else 0) + 2), "left")
    bins = below[np.minimum((horizon * 100).astype(np.int64), len(below) - 1)]
    return bins + (horizon > np.append(edges, np.inf)[bins])


def _horizons(rows: DataFrame, features: list[str], least: int, bins: int, models: int) -> list[np.ndarray]:
    """Quantiles of the horizon of each model's pairs, counted to a hundredth of a month."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for sets, batch in _by_sets(whole):
                for p in pieces(batch, features, least):
                    at, n = np.unique(np.rint(p.horizon * 100).astype(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), sets)), pa.array(at), pa.array(n)], names=["sets", "at", "n"])

    found = rows.mapInArrow(count, "sets long, at long, n long").groupBy("sets", "at").agg(F.sum("n").alias("n")).orderBy("at").toArrow()
    sets, at, n = (found.column(name).to_numpy() for name in ("sets", "at", "n"))

    def quantiles(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.unique(at[np.searchsorted(n.cumsum(), n.sum() * np.arange(1, bins) / bins)]) / 100 + 0.005 if len(at) else np.empty(0)

    return [quantiles(at[own], n[own]) for own in (sets >> k & 1 == 1 for k in range(models))]


def _sums(rows: DataFrame, model: Trees, tree: int, level: int, least: int, heavier: float) -> np.ndarray:
    """:func:`_sums_each` for one model."""
    return _sums_each(rows, [model], tree, level, least, heavier)[0]


def _sums_each(rows: DataFrame, models: list[Trees], tree: int, level: int, least: int, heavier: float, tasks: int = 1) -> np.ndarray:
    """Sums of weights and of weighted targets by model, node, feature and bin; ``rows``: those of :func:`packed_each`, in ``tasks`` parts.

    A task gives its sums as one row. Those of over ``FEW`` tasks are added up by others before they come to the driver.
    """
    features = len(models[0].features)
    width = max(len(e) for model in models for e in model.edges) + 1
    shape = (2, 1 << level, features, width)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, spans, steps = np.zeros((len(models), *shape)), [m.spans(tree, level) for m in models], [m.steps(tree) for m in models]
        alike = [next(j for j, other in enumerate(models) if np.array_equal(other.edges[0], m.edges[0])) for m in models]
        for batch in batches:
            for own, p in _unpacked(batch, features - 1, least):
                anchors, weight, horizons = len(p.x), 1 + heavier * p.loss, {}
                for i, k in enumerate(own):
                    model, h = models[k], spans[k].shape[1]
                    bins = np.concatenate([np.zeros((1, anchors), dtype=np.int16), p.x[:, i * (features - 1) : (i + 1) * (features - 1)].T])
                    reached = model.reached(bins, slice(tree, tree + 1), level)
                    if alike[k] not in horizons:
                        horizons[alike[k]] = _horizon_bins(p.horizon, model.edges[0]) * anchors + p.anchor
                    cell = horizons[alike[k]]
                    if tree:
                        under = p.loss < model.by_horizon(bins, steps[k]).reshape(-1)[cell]
                        over, under = np.bincount(cell + under * (h * anchors), weight, 2 * h * anchors).reshape(2, h, anchors)
                        masses = over + under, over - under
                    else:
                        masses = [np.bincount(cell, mass, h * anchors).reshape(h, anchors) for mass in (weight, weight * p.loss)]
                    node, anchor = np.nonzero(reached)
                    places = [node * width + bins[f, anchor] for f in range(features)]
                    for kind, cells in enumerate(masses):
                        out[k, kind, :, 0, :h] += (reached.astype(float) @ cells.T) * spans[k]
                        mass = (spans[k] @ cells)[node, anchor]
                        for f in range(1, features):
                            out[k, kind, :, f] += np.bincount(places[f], mass, shape[1] * width).reshape(shape[1], width)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    def add_more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(models), *shape))
        for batch in batches:
            _add_rows(out, batch.column("sums"))
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    parts = rows.mapInArrow(add_up, "sums binary")
    if tasks > FEW:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(add_more, "sums binary")
    out = np.zeros((len(models), *shape))
    for column in parts.toArrow().column("sums").chunks:
        _add_rows(out, column)
    return out


def _add_rows(out: np.ndarray, column: pa.Array) -> None:
    for row in column:
        out += np.frombuffer(row.as_buffer()).reshape(out.shape)


def _split(model: Trees, tree: int, level: int, sums: np.ndarray, rate: float) -> None:
    """Cut each node of a level where squared sums gain most; the last level's sides are the leaves' means."""
    (w, s), width = sums.cumsum(axis=3), sums.shape[3]
    whole_w, whole_s = w[:, :, -1:], s[:, :, -1:]
    score = lambda a, b: a * a / np.maximum(b, 1e-12)
    fits = (w > 1e-9) & (whole_w - w > 1e-9)
    gain = np.where(fits, score(s, w) + score(whole_s - s, whole_w - w) - score(whole_s, whole_w), 0.0).reshape(len(w), -1)
    best = np.where(gain >= gain.max(axis=1, keepdims=True) * (1 - 1e-12), 1, 0).argmax(axis=1)
    for node, place in enumerate(best):
        at, (f, b) = (1 << level) - 1 + node, divmod(int(place), width)
        found = gain[node, place] > 1e-9 * max(whole_w[node, 0, 0], 1e-12)
        if found:
            model.feature[tree, at], model.edge[tree, at], model.gain[tree, at] = f, b, gain[node, place]
        if level == model.depth - 1:
            all_w, all_s = whole_w[node, 0, 0], whole_s[node, 0, 0]
            sides = ((w[node, f, b], s[node, f, b]), (all_w - w[node, f, b], all_s - s[node, f, b])) if found else ((all_w, all_s), (all_w, all_s))
            model.value[tree, 2 * node : 2 * node + 2] = [rate * b / a if a > 0 else 0.0 for a, b in sides]


def fit(rows: DataFrame, features: list[str], trees: int = 12, depth: int = 4, rate: float = 0.2, bins: int = 32, least: int = 4, heavier: float = 0.15) -> Trees:
    """``rows``: a row for each vehicle, with months (array of structs in order: age_months, soh and the features but the first, the
    horizon). Pairs weigh one and ``heavier`` for each point that they lose. With no pairs predictions are 0."""
    return fit_each(rows, features, [F.lit(True)], trees, depth, rate, bins, least, heavier)[0]


def fit_each(
    rows: DataFrame, features: list[str], sets: list[Column], trees: int = 12, depth: int = 4, rate: float = 0.2, bins: int = 32, least: int = 4, heavier: float = 0.15
) -> list[Trees]:
    """A model for each condition on ``rows``, of the vehicles that meet it; else as :func:`fit`.

    ``TOGETHER`` models are fitted by the same passes, which make a vehicle's pairs once for all of them.
    """
    if len(sets) > TOGETHER:
        return [m for k in range(0, len(sets), TOGETHER) for m in fit_each(rows, features, sets[k : k + TOGETHER], trees, depth, rate, bins, least, heavier)]
    slots = rows.sparkSession.sparkContext.defaultParallelism
    bits = [F.when(one, F.lit(1 << k)).otherwise(F.lit(0)) for k, one in enumerate(sets)]
    rows = cut_once(rows.select("months", functools.reduce(Column.__add__, bits).cast("long").alias("sets")).where("sets > 0"))
    own, models = features[1:], range(len(sets))
    anchor = rows.select("sets", F.size("months").alias("n"), F.posexplode(F.slice("months", least, F.greatest(F.size("months") - least, F.lit(0)))).alias("at", "m")).select("sets", (F.col("n") - least - F.col("at")).alias("later"), "m.*")
    number = lambda k, c: F.when(F.col("sets").bitwiseAND(1 << k) > 0, F.nanvl(F.col(c), F.lit(None).cast("double")))
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    first = anchor.agg(F.sum("later").alias("pairs"), *[F.percentile_approx(number(k, f), shares, 1000).alias(f"{f}_{k}") for k in models for f in own]).first()
    horizons = _horizons(rows, own, least, bins, len(sets))
    edges = [[horizons[k], *(np.unique(first[f"{f}_{k}"] or []).astype(float) for f in own)] for k in models]
    tasks = _tasks(first["pairs"] or 0, slots)
    rows = cut_once(packed_each(rows.repartition(tasks), own, [e[1:] for e in edges]))  # read once for each level of each tree
    nodes = (1 << depth) - 1
    grown = [Trees(list(features), e, np.full((trees, nodes), -1), np.zeros((trees, nodes), dtype=int), np.zeros((trees, nodes)), np.zeros((trees, nodes + 1))) for e in edges]
    for tree in range(trees):
        for level in range(depth):
            for model, sums in zip(grown, _sums_each(rows, grown, tree, level, least, heavier, tasks), strict=True):
                _split(model, tree, level, sums, rate if tree else 1.0)
    return grown


def _tasks(pairs: int, slots: int) -> int:
    """Tasks of a pass: some work in each, no more than 16 pieces, and where there are more than slots a whole number for each."""
    least = max(min(slots, pairs // (2 * PIECE)), pairs // (16 * PIECE), 1)
    return least if least < slots else -(-least // slots) * slots
