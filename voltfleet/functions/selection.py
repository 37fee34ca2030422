"""Order statistics and resampling that no single task holds the values for.

``exact_quantiles`` narrows down to each wanted rank by passes of counts; ``bootstrap_correlation`` needs six sums for each draw;
``later_medians`` walks a vehicle's values once, backwards, between two heaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of a pass, for each wanted rank; values that are left when they are simply sorted; groups, at most.
CELLS, FEW_LEFT, MOST_GROUPS = 4096, 2048, 10_000
#: The prime of the draws' hash, and where the distribution function of Poisson(1) steps.
PRIME = 2_147_483_647
POISSON = (0.36788, 0.73576, 0.91970, 0.98101, 0.99634, 0.99941)
#: Weights that a task holds at once.
_HELD = 1 << 21


def exact_quantiles(df: DataFrame, column: str, shares: tuple[float, ...], by: str | None = None, cells: int = CELLS, few: int = FEW_LEFT) -> DataFrame:
    """(by,) n and q: exact quantiles with linear interpolation, over all rows or in each group of ``by``, of which there are few.

    A pass counts, for each wanted rank, the values of equal cells between the bounds it is known to lie in; the cell that
    holds the rank has the next bounds. Counts are added up in each task, so at most ranks times cells rows are shuffled and
    come to the driver. Null, NaN and infinite values do not count; a group without others has no row. Null groups are one.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[by] if by else "int"
    value = F.col(column).cast("double")
    rows = df.select((F.col(by) if by else F.lit(0)).alias("g"), value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    ends = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).limit(MOST_GROUPS + 1).collect()
    if len(ends) > MOST_GROUPS:
        raise ValueError(f"over {MOST_GROUPS} groups of {by}")
    # a rank: its group's number, how many values of its bounds are below it, and the bounds
    wanted = {(k, r): (r, e["n"], e["low"], e["high"]) for k, e in enumerate(ends) for s in shares for r in {int(s * (e["n"] - 1)), min(int(s * (e["n"] - 1)) + 1, e["n"] - 1)}}
    found = {key: low for key, (_, _, low, high) in wanted.items() if low == high}
    while open_ := {key: t for key, t in wanted.items() if key not in found}:
        bounds: dict[tuple, list] = {}
        for key, (_, n, low, high) in open_.items():
            bounds.setdefault((key[0], low, high, n <= few), []).append(key)
        listed = list(bounds)
        asked = spark.createDataFrame([(i, ends[k]["g"], low, high, all_) for i, (k, low, high, all_) in enumerate(listed)], f"t int, g {kind}, low double, high double, every boolean")
        inside = rows.join(F.broadcast(asked.withColumnRenamed("g", "h")), F.col("g").eqNullSafe(F.col("h")) & F.col("v").between(F.col("low"), F.col("high")))
        # the halves keep the differences finite
        share = (F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        cell = F.when(F.col("every"), F.lit(-1)).otherwise(F.least(F.floor(share * cells), F.lit(cells - 1)).cast("int"))
        counted = inside.groupBy("t", cell.alias("cell"), F.when(F.col("every"), F.col("v")).alias("own")).agg(F.count("*").alias("k"), F.min("v").alias("least"), F.max("v").alias("most")).collect()
        parts: dict[int, list] = {}
        for r in counted:
            parts.setdefault(r["t"], []).append(r)
        for i, at in enumerate(listed):
            mine = sorted(parts[i], key=lambda r: r["least"])
            below = np.concatenate([[0], np.cumsum([r["k"] for r in mine])])
            for key in bounds[at]:
                rank = open_[key][0]
                r = mine[j := int(np.searchsorted(below, rank, "right")) - 1]
                wanted[key] = (rank - int(below[j]), r["k"], r["least"], r["most"])
                if r["least"] == r["most"]:
                    found[key] = r["least"]
    out = []
    for k, e in enumerate(ends):
        at = [s * (e["n"] - 1) for s in shares]
        pairs = [(found[k, int(a)], found[k, min(int(a) + 1, e["n"] - 1)], a - int(a)) for a in at]
        out.append((e["g"], e["n"], [low if low == high else low + (high - low) * part for low, high, part in pairs]))
    table = spark.createDataFrame(out, f"g {kind}, n long, q array<double>")
    return table.withColumnRenamed("g", by) if by else table.drop("g")


def poisson_weights(ids: np.ndarray, draws: int) -> np.ndarray:
    """Weights of rows (by id) in draws 1 to ``draws``, Poisson(1) of a hash of both; ids count modulo the prime."""
    i, d = (ids.astype(np.int64) % PRIME)[:, None], np.arange(1, draws + 1, dtype=np.int64)[None, :]
    h = (i * 16807 + d * 48271 + 12345) % PRIME
    h = (h * h + i) % PRIME
    h = (h * h + d) % PRIME
    return np.searchsorted(np.array(POISSON), h / PRIME, "right")


def bootstrap_correlation(df: DataFrame, x: str, y: str, draws: int = 2000, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """One row: Pearson correlation of x and y, its bootstrap interval, and n. ``df`` has a key column id, not negative.

    Each row's weight in each draw is :func:`poisson_weights`. A task adds up six sums for each draw over all its rows, so what is
    shuffled is tasks times draws. Rows with a null take no part. Draws in which a side does not vary are left out.
    """
    rows = df.select(F.col("id").cast("long").alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    mid = rows.agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))  # sums of squares keep their digits about the means
    centred = rows.crossJoin(F.broadcast(mid)).select("id", (F.col("x") - F.col("mx")).alias("x"), (F.col("y") - F.col("my")).alias("y"))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, draws))
        for batch in batches:
            step = max(1, _HELD // draws)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                a, b = part.column("x").to_numpy(), part.column("y").to_numpy()
                w = poisson_weights(part.column("id").to_numpy(), draws).astype(float)
                sums += np.stack([np.ones(len(a)), a, b, a * a, b * b, a * b]) @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, draws + 1)), *map(pa.array, sums)], names=["draw", "w", "x", "y", "xx", "yy", "xy"])

    total = centred.mapInArrow(add_up, "draw long, w double, x double, y double, xx double, yy double, xy double").groupBy("draw").agg(*[F.sum(c).alias(c) for c in ("w", "x", "y", "xx", "yy", "xy")])
    across = (F.col("xx") - F.col("x") * F.col("x") / F.col("w")) * (F.col("yy") - F.col("y") * F.col("y") / F.col("w"))
    rho = total.where("w > 1").withColumn("across", across).where("across > 1e-18").select(((F.col("xy") - F.col("x") * F.col("y") / F.col("w")) / F.sqrt("across")).alias("rho"))
    bounds = rho.agg(F.percentile("rho", low).alias("low"), F.percentile("rho", high).alias("high"))  # of as many numbers as there are draws
    return rows.agg(F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("rho"), F.count("*").alias("n")).crossJoin(F.broadcast(bounds))


def medians_of_later(values: list) -> list:
    """For each value the median of those after it, None where there is none; null and NaN values do not count."""
    low: list[float] = []  # the smaller half, negated
    high: list[float] = []
    out = [None] * len(values)
    for i in range(len(values) - 1, -1, -1):
        if low:
            out[i] = -low[0] if len(low) > len(high) else (high[0] - low[0]) / 2
        v = values[i]
        if v is None or v != v:
            continue
        heapq.heappush(high, -heapq.heappushpop(low, -v))
        if len(high) > len(low):
            heapq.heappush(low, -heapq.heappop(high))
    return out


def later_medians(df: DataFrame, column: str, name: str, order: str = "month", by: str = "vin") -> DataFrame:
    """``df`` with ``name``: the median of a vehicle's later values at each row, in time that n log n bounds."""

    def walk(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        return table.append_column(name, pa.array(medians_of_later(table.column(column).cast(pa.float64()).to_pylist()), type=pa.float64()))

    fields = ", ".join(f"`{n}` {k}" for n, k in df.dtypes)
    return df.groupBy(by).applyInArrow(walk, f"{fields}, `{name}` double")
