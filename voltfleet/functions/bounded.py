"""Non-increasing cubic fits: moments are summed in Spark, and a small bounded least-squares problem is solved per vehicle row."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import series as sr
from . import stats

_DEGREE = 3


def moments(df: DataFrame, y: str, anchored: bool = False) -> DataFrame:
    """vin, n, x0, x1 and sums of powers of age (from the first age; with ``anchored`` in years from 0) and their products with y."""
    x = F.col("age_months") / 12 if anchored else F.col("age_months") - F.min("age_months").over(sr.own())
    rows = df.where(F.col(y).isNotNull() & F.col("age_months").isNotNull()).select("vin", "age_months", x.alias("x"), F.col(y).alias("y"))
    powers = [F.sum(F.pow("x", F.lit(float(k)))).alias(f"sx{k}") for k in range(2 * _DEGREE + 1)]
    products = [F.sum(F.pow("x", F.lit(float(k))) * F.col("y")).alias(f"sxy{k}") for k in range(_DEGREE + 1)]
    return rows.groupBy("vin").agg(F.count("*").alias("n"), F.min("age_months").alias("x0"), F.max("age_months").alias("x1"), *powers, *products)


def solve(gram: np.ndarray, right: np.ndarray, free: int) -> np.ndarray:
    """Least squares with all but the first ``free`` unknowns at least 0: the best feasible one of all active sets."""
    best, least = np.zeros(len(right)), np.inf
    for k in range(len(right) - free + 1):
        for chosen in combinations(range(free, len(right)), k):
            at = [*range(free), *chosen]
            c = np.zeros(len(right))
            if at:
                c[at] = np.linalg.lstsq(gram[np.ix_(at, at)], right[at], rcond=None)[0]
            cost = c @ gram @ c - 2 * c @ right
            if (c[free:] >= -1e-12).all() and cost < least - 1e-12:
                best, least = c, cost
    return best


def _scaled(gram: np.ndarray, right: np.ndarray, span: float, powers: range, free: int) -> list[float]:
    """:func:`solve` with ages in units of ``span``, since sums of high powers of months would cost most of the digits."""
    unit = np.array([span**-k for k in powers])
    return list(solve(gram * np.outer(unit, unit), right * unit, free) * unit)


def _solver(anchored: bool):  # noqa: ANN202
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                sx, sxy = ([getattr(row, f"{n}{k}") for k in range(m)] for n, m in (("sx", 2 * _DEGREE + 1), ("sxy", _DEGREE + 1)))
                if anchored:
                    degree = min(_DEGREE, max(1, row.n))
                    gram = np.array([[sx[i + j] for j in range(1, degree + 1)] for i in range(1, degree + 1)])
                    c = [100.0, *_scaled(gram, np.array([100 * sx[i] - sxy[i] for i in range(1, degree + 1)]), row.x1 / 12, range(1, degree + 1), 0)]
                else:
                    degree = min(_DEGREE, max(1, row.n // 4))
                    sign = np.array([1.0, *[-1.0] * degree])
                    gram = np.array([[sx[i + j] for j in range(degree + 1)] for i in range(degree + 1)]) * np.outer(sign, sign)
                    c = _scaled(gram, np.array(sxy[: degree + 1]) * sign, row.x1 - row.x0, range(degree + 1), 1)
                c += [0.0] * (_DEGREE + 1 - len(c))
                out.append((row.vin, row.n, row.x0, row.x1, *map(float, c)))
            yield pd.DataFrame(out, columns=["vin", "n", "x0", "x1", "c0", "c1", "c2", "c3"])

    return run


def decreasing_cubic(df: DataFrame, y: str, anchored: bool = False) -> DataFrame:
    """vin, n, x0, x1, c0 to c3 of y = c0 - c1 u - c2 u^2 - c3 u^3 with c1, c2, c3 >= 0, so it never rises.

    u is months since the first age, or with ``anchored`` years since age 0, where y is 100. Fewer points get a lower degree;
    vehicles with under three points (two if anchored) or no span have no row.
    """
    rows = moments(df, y, anchored).where((F.col("n") >= (2 if anchored else 3)) & (F.col("x1") > (F.lit(0.0) if anchored else F.col("x0"))))
    return rows.mapInPandas(_solver(anchored), f"vin {dict(rows.dtypes)['vin']}, n long, x0 double, x1 double, c0 double, c1 double, c2 double, c3 double")


def evaluate(coefficients: DataFrame, ages: DataFrame, anchored: bool = False) -> DataFrame:
    """``ages`` (vin, age_months) with fitted."""
    rows = ages.join(coefficients.select("vin", "x0", "c0", "c1", "c2", "c3"), "vin")
    u = F.col("age_months") / 12 if anchored else F.col("age_months") - F.col("x0")
    return rows.withColumn("fitted", F.col("c0") - F.col("c1") * u - F.col("c2") * u * u - F.col("c3") * u * u * u).drop("x0", "c0", "c1", "c2", "c3")


def greyed(df: DataFrame, y: str, ceiling: float = 99.95, most_per_year: float = 10.0) -> DataFrame:
    """Adds inlier. Readings at the ceiling go but for the first, so do fades from 100 steeper than plausible; of the rest, if four
    or more, those far from a robust line by the median deviation of its residuals."""
    at_top = F.col(y) >= ceiling
    top = F.row_number().over(Window.partitionBy("vin", "at_top").orderBy("month"))
    df = df.withColumn("at_top", at_top).withColumn("nth", top)
    out = (F.col("at_top") & (F.col("nth") > 1)) | ((100 - F.col(y)) / F.greatest(F.col("age_months") / 12, F.lit(0.25)) > most_per_year)
    df = df.withColumn("out", out).drop("at_top", "nth")
    kept = df.where(~F.col("out"))
    line = stats.theil_sen(kept, "age_months", y)
    rest = kept.drop("n").join(line, "vin").withColumn("res", F.col(y) - F.col("slope") * F.col("age_months") - F.col("intercept"))
    rest = rest.withColumn("off", F.abs(F.col("res") - F.median("res").over(Window.partitionBy("vin"))))
    rest = rest.withColumn("limit", F.greatest(3.5 * 1.4826 * F.median("off").over(Window.partitionBy("vin")), F.lit(3.0)))
    far = rest.where((F.col("n") >= 4) & (F.col("off") > F.col("limit"))).select("vin", "month", F.lit(True).alias("far"))
    return df.join(far, ["vin", "month"], "left").withColumn("inlier", ~F.col("out") & F.col("far").isNull()).drop("out", "far")
