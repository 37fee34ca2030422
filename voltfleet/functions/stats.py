"""Robust statistics and small fits as aggregates; per-group ones read groups of a vehicle's months."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import series as sr
from . import counting


def cv(column: str) -> Column:
    """Coefficient of variation in %; null with fewer than two values."""
    return F.when(F.count(column) > 1, F.stddev_samp(column) / F.avg(column) * 100)


def quantile(column: str, q: float) -> Column:
    """Exact, with linear interpolation between the neighbouring values."""
    return F.percentile(column, q)


def mad(df: DataFrame, column: str, by: str = "vin") -> DataFrame:
    """Median absolute deviation from the group's median."""
    off = df.withColumn("off", F.abs(F.col(column) - F.median(column).over(Window.partitionBy(by))))
    return off.groupBy(by).agg(F.median("off").alias("mad"))


def theil_sen(df: DataFrame, x: str, y: str, by: str = "vin") -> DataFrame:
    """by, slope (median over pairs), intercept (median of y - slope x), n; slope 0 where no two x differ.

    Points with a null or NaN don't count; a group without others has no row. Slopes are found by rank (``counting``), not listed.
    """
    number = {c: F.col(c).cast("double") for c in (x, y)}
    good = [number[c].isNotNull() & ~F.isnan(number[c]) for c in (x, y)]
    groups = df.where(good[0] & good[1]).groupBy(by).agg(F.collect_list(number[x]).alias("xs"), F.collect_list(number[y]).alias("ys"))
    kind = dict(df.dtypes)[by]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column("xs"), batch.column("ys")
            out = []
            for i in range(batch.num_rows):
                u, v = xs[i].values.to_numpy(), ys[i].values.to_numpy()
                slope = counting.median_slope(u, v) or 0.0
                out.append((slope, float(np.median(v - slope * u)), len(u)))
            columns = [pa.array(list(c), type=t) for c, t in zip(zip(*out, strict=True) if out else ([], [], []), (pa.float64(), pa.float64(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(by), *columns], names=[by, "slope", "intercept", "n"])

    return groups.mapInArrow(fit, f"`{by}` {kind}, slope double, intercept double, n int")


def decline_per_year(df: DataFrame, value: str, least: int = 4, span: float = 4.0) -> DataFrame:
    """vin, ppy: points lost per year by the median slope; null with too few points or too short a span."""
    fit = theil_sen(df, "age_months", value)
    spans = df.where(F.col(value).isNotNull()).groupBy("vin").agg((F.max("age_months") - F.min("age_months")).alias("span"))
    return fit.join(spans, "vin").select("vin", F.when((F.col("n") >= least) & (F.col("span") >= span), -12 * F.col("slope")).alias("ppy"))


def line(df: DataFrame, x: str, y: str, by: str = "vin") -> DataFrame:
    """Least-squares slope, intercept and R squared of each group."""
    return df.groupBy(by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def sqrt_trend(df: DataFrame, value: str) -> DataFrame:
    """Trend on the root of age, never rising: else the mean level."""
    df = df.withColumn("root", F.sqrt(F.greatest("age_months", F.lit(0.0))))
    fit = df.groupBy("vin").agg(F.regr_slope(value, "root").alias("slope"), F.regr_intercept(value, "root").alias("intercept"), F.avg(value).alias("mean"))
    falls = F.col("slope") <= 0
    return fit.select("vin", F.when(falls, F.col("slope")).otherwise(0.0).alias("slope"), F.when(falls, F.col("intercept")).otherwise(F.col("mean")).alias("intercept"))


def spearman(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """Rank correlation of each group, over rows that have both values."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.select(by, sr.average_rank(x, by).alias("rx"), sr.average_rank(y, by).alias("ry")).groupBy(by).agg(F.corr("rx", "ry").alias("rho"), F.count("*").alias("n"))


def partial_correlation(df: DataFrame, x: str, y: str, given: str) -> DataFrame:
    """One row: correlation of what is left of x and y after a line on ``given``."""
    good = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(given).isNotNull())
    fits = good.agg(*[f(v, given).alias(f"{n}_{v}") for v in (x, y) for n, f in (("slope", F.regr_slope), ("cut", F.regr_intercept))])
    rest = good.crossJoin(F.broadcast(fits)).select(*[(F.col(v) - F.col(f"slope_{v}") * F.col(given) - F.col(f"cut_{v}")).alias(v) for v in (x, y)])
    return rest.agg(F.corr(x, y).alias("r"), F.count("*").alias("n"))


def detrended_spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """vin, rho_detrended, rho_diff: rank correlation of residuals on age, and of first differences."""
    fits = df.groupBy("vin").agg(*[f(v, "age_months").alias(f"{n}_{v}") for v in (x, y) for n, f in (("slope", F.regr_slope), ("cut", F.regr_intercept))])
    rows = df.join(fits, "vin")
    rows = rows.select("vin", *[(F.col(v) - F.col(f"slope_{v}") * F.col("age_months") - F.col(f"cut_{v}")).alias(f"res_{v}") for v in (x, y)], *[(F.col(v) - F.lag(v).over(sr.by_month())).alias(f"dif_{v}") for v in (x, y)])
    a = spearman(rows, f"res_{x}", f"res_{y}", "vin").select("vin", F.col("rho").alias("rho_detrended"))
    return a.join(spearman(rows, f"dif_{x}", f"dif_{y}", "vin").select("vin", F.col("rho").alias("rho_diff")), "vin", "left")


def sqrt_fade(df: DataFrame, value: str, eol: float = 80.0) -> DataFrame:
    """Fade through 100 at age 0: k of 100 - k sqrt(age), and the age at which ``eol`` is reached."""
    good = df.where(F.col("age_months") > 0)
    fit = good.groupBy("vin").agg((F.sum((100 - F.col(value)) * F.sqrt("age_months")) / F.sum("age_months")).alias("k"))
    return fit.withColumn("eol_age", F.when(F.col("k") > 0, F.pow((100 - eol) / F.col("k"), 2.0)))


def bootstrap_median(df: DataFrame, column: str, draws: int = 200, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """One row: median and its bootstrap interval. Each row's weight in each draw is Poisson(1) of a hash of its key column ``id``."""
    digits = F.substring(F.md5(F.concat_ws(":", "id", "draw")), 1, 8)
    uniform = F.conv(digits, 16, 10).cast("long") % 1_000_000 / 1e6
    weight = F.lit(0)
    for limit in (0.36788, 0.73576, 0.91970, 0.98101, 0.99634, 0.99941):
        weight = weight + (uniform >= limit).cast("int")
    rows = df.where(F.col(column).isNotNull()).select("id", column, F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw")).withColumn("w", weight).where("w > 0")
    medians = rows.groupBy("draw").agg(F.percentile(column, 0.5, F.col("w")).alias("m"))
    bounds = medians.agg(F.percentile("m", low).alias("low"), F.percentile("m", high).alias("high"))
    return df.agg(F.median(column).alias("median")).crossJoin(F.broadcast(bounds))


def relative_slopes(df: DataFrame, value: str, least: int = 6) -> DataFrame:
    """vin, rel_slope: slope per month in % of the mean."""
    fit = df.groupBy("vin").agg((F.regr_slope(value, "age_months") / F.avg(value) * 100).alias("rel_slope"), F.count(value).alias("n"))
    return fit.where(F.col("n") >= least)


def errors(df: DataFrame, predicted: str, actual: str, by: tuple[str, ...] = ()) -> DataFrame:
    """rmse, mae, bias (predicted less actual) and n."""
    off = F.col(predicted) - F.col(actual)
    return df.where(off.isNotNull()).groupBy(*by).agg(F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"), F.avg(off).alias("bias"), F.count("*").alias("n"))
