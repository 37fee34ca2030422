"""Window operators over each vehicle's monthly series (vin, month), and over forecast steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import folds


def by_month() -> WindowSpec:
    return Window.partitionBy("vin").orderBy("month")


def so_far() -> WindowSpec:
    return by_month().rowsBetween(Window.unboundedPreceding, 0)


def own() -> WindowSpec:
    return Window.partitionBy("vin")


def centred(k: int):  # noqa: ANN201
    return by_month().rowsBetween(-(k // 2), k // 2)


def rolling_median(column: str | Column, k: int) -> Column:
    return F.percentile(column, 0.5).over(centred(k))


def rolling_mean(column: str, k: int) -> Column:
    return F.avg(column).over(centred(k))


def trailing_median(column: str | Column, k: int) -> Column:
    return F.percentile(column, 0.5).over(by_month().rowsBetween(-(k - 1), 0))


def gap_months(per_month: float = 30.4) -> Column:
    """Months since the vehicle's last row; 1 at its first."""
    return F.coalesce(F.datediff("month", F.lag("month").over(by_month())) / per_month, F.lit(1.0))


def km_from_odometer(odo: str = "odo_max", most: float | None = None) -> Column:
    """Distance since the last month, never negative, 0 at the first; of the running maximum and capped if ``most`` is given."""
    column = F.col(odo) if most is None else F.max(odo).over(so_far())
    step = column - F.lag(column).over(by_month()) if most is None else column - F.coalesce(F.max(odo).over(by_month().rowsBetween(Window.unboundedPreceding, -1)), column)
    out = F.coalesce(F.greatest(step, F.lit(0.0)), F.lit(0.0))
    return out if most is None else F.least(out, F.lit(most))


def cumulative(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Running sums under new names."""
    return df.withColumns({new: F.sum(old).over(so_far()) for old, new in columns.items()})


def ages(df: DataFrame, anchor: str) -> DataFrame:
    """age_months since an anchor date in whole days, its inverse root, and the missing health."""
    age = F.datediff("month", anchor) / 30.4
    return df.withColumn("age_months", age).withColumn("inv_sqrt_age", 1 / F.sqrt(F.greatest("age_months", F.lit(0.0)) + 1)).withColumn("soh_deficit", 100 - F.col("soh"))


def running_min(column: str) -> Column:
    return F.min(column).over(so_far())


def running_max(column: str) -> Column:
    return F.max(column).over(so_far())


def greedy_envelope(df: DataFrame, raw: str = "soh_raw", max_drop: float = 6.0) -> DataFrame:
    """Adds soh: running minimum whose fall is capped per elapsed month, so each value depends on the last result."""
    df = df.withColumn("gap", gap_months())
    return folds.per_vehicle(df, "month", [raw, "gap"], {"soh": folds.limited_descent(F.col(raw), F.col("gap"), max_drop)}).drop("gap")


def isotonic_envelope(df: DataFrame, raw: str = "soh_raw", top: float | None = 100.0) -> DataFrame:
    """Adds soh: least-squares non-increasing fit, capped after the fit."""
    out = folds.per_vehicle(df.where(F.col(raw).isNotNull()), "month", [raw], {"soh": folds.isotonic(F.col(raw))})
    return out if top is None else out.withColumn("soh", F.least("soh", F.lit(top)))


def hampel(df: DataFrame, column: str, k: int = 5, width: float = 3.0) -> DataFrame:
    """Adds clipped: values pulled into the rolling median plus or minus ``width`` robust deviations."""
    df = df.withColumn("mid", rolling_median(column, k))
    df = df.withColumn("off", F.abs(F.col(column) - F.col("mid"))).withColumn("band", width * 1.4826 * F.greatest(rolling_median("off", k), F.lit(1e-6)))
    return df.withColumn("clipped", F.greatest(F.least(F.col(column), F.col("mid") + F.col("band")), F.col("mid") - F.col("band"))).drop("mid", "off", "band")


def robust_isotonic(df: DataFrame, raw: str = "soh_raw", max_drop: float = 6.0) -> DataFrame:
    """Adds soh: Hampel clip, non-increasing fit capped at 100, then a cap on the fall per month. A single month keeps its value."""
    df = hampel(df.withColumn("gap", F.greatest(gap_months(), F.lit(1e-9))), raw)
    fitted = F.transform(folds.isotonic(F.col("clipped")), lambda x: F.least(x, F.lit(100.0)))
    alone = F.transform(F.col(raw), lambda x: F.least(x, F.lit(100.0)))
    new = {"fit": F.when(F.size("clipped") == 1, alone).otherwise(fitted), "soh": folds.limited_descent(F.col("fit"), F.col("gap"), max_drop)}
    return folds.per_vehicle(df, "month", ["clipped", "gap", raw], new).drop("clipped", "gap", "fit")


def last_values(df: DataFrame, column: str, k: int = 6) -> DataFrame:
    """Median of each vehicle's last k rows."""
    rn = F.row_number().over(Window.partitionBy("vin").orderBy(F.desc("month")))
    return df.withColumn("rn", rn).where(F.col("rn") <= k).groupBy("vin").agg(F.median(column).alias(column))


def recent_loss_rate(df: DataFrame, soh: str = "soh", k: int = 8, least: int = 3) -> Column:
    """Health lost per month over the last k rows up to each row, at least 0; 0 with fewer than ``least`` rows or no time passed."""
    recent = by_month().rowsBetween(-(k - 1), 0)
    span = F.col("age_months") - F.first("age_months").over(recent)
    rate = F.greatest((F.first(soh).over(recent) - F.col(soh)) / span, F.lit(0.0))
    return F.when((F.count(F.lit(1)).over(recent) >= least) & (span > 0), rate).otherwise(0.0)


def trailing_run(df: DataFrame, column: str) -> DataFrame:
    """vin, run: how many of the last rows have the last value."""
    back = Window.partitionBy("vin").orderBy(F.desc("month"))
    change = F.coalesce((F.col(column) != F.lag(column).over(back)).cast("int"), F.lit(0))
    rows = df.withColumn("change", change).withColumn("seen", F.sum("change").over(back.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("vin").agg(F.count_if(F.col("seen") == 0).alias("run"))


def z_score(column: str, by: str = "vin") -> Column:
    """Distance from the group's mean in its standard deviations; 0 where the group does not vary."""
    w = Window.partitionBy(by)
    sd = F.stddev_samp(column).over(w)
    return F.when(F.col(column).isNotNull(), F.when(sd > 0, (F.col(column) - F.avg(column).over(w)) / sd).otherwise(0.0))


def average_rank(column: str, by: str | None = None) -> Column:
    """Ranks from 1, ties share their mean rank; nulls have none. Without ``by`` all rows are one group, for small tables only."""
    keys = [by] if by else [F.lit(0)]
    ordered, tied = Window.partitionBy(*keys).orderBy(F.col(column).asc_nulls_last()), Window.partitionBy(*keys, column)
    return F.when(F.col(column).isNotNull(), F.rank().over(ordered) + (F.count(F.lit(1)).over(tied) - 1) / 2)


def percentile_below(column: str, by: str | None = None) -> Column:
    """Share in % of the group's values that are strictly less."""
    keys = [by] if by else [F.lit(0)]
    w = Window.partitionBy(*keys)
    return F.when(F.col(column).isNotNull(), (F.rank().over(w.orderBy(F.col(column).asc_nulls_last())) - 1) / F.count(column).over(w) * 100)


#: Cells that a large group's values are cut into before they are ranked, and the rows over which a group is large.
CELLS, LARGE = 256, 65_536


def with_ranks(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Rows whose value is not null, with below (values of the group that are less), ties (equal ones, itself included) and of (all).

    Approximate quantiles cut each large group's values into cells; counts of cells and ranks within cells add up to exact ranks, so a
    group of all vehicles is ranked by as many tasks as it has cells. Equal values share a cell, and are counted as one row there.
    """
    rows = df.where(F.col(column).isNotNull())
    edges = rows.groupBy(*by).agg(F.percentile_approx(column, [i / CELLS for i in range(1, CELLS)], 10 * CELLS).alias("edges"), F.count("*").alias("n"))
    edges = edges.where(F.col("n") > LARGE).drop("n")  # at most rows / LARGE groups, however many there are
    kinds = rows.groupBy(*by, column).agg(F.count("*").alias("ties")).join(F.broadcast(edges), by, "left")
    cell = F.when(F.col("edges").isNull(), 0).otherwise(F.size(F.filter("edges", lambda e: e < F.col(column))))
    kinds = kinds.withColumn("cell", cell).drop("edges")
    own = Window.partitionBy(*by)
    before = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = kinds.groupBy(*by, "cell").agg(F.sum("ties").alias("n")).withColumns({"start": F.coalesce(F.sum("n").over(before), F.lit(0)), "of": F.sum("n").over(own)}).drop("n")
    inside = Window.partitionBy(*by, "cell").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    ranked = kinds.join(cells, [*by, "cell"]).withColumn("below", F.col("start") + F.coalesce(F.sum("ties").over(inside), F.lit(0)))
    return rows.join(ranked.select(*by, column, "below", "ties", "of"), [*by, column]).select(*df.columns, "below", "ties", "of")


def group_at_least(df: DataFrame, k: int, by: str = "vin") -> DataFrame:
    """Rows of groups with at least k rows."""
    return df.withColumn("group_size", F.count(F.lit(1)).over(Window.partitionBy(by))).where(F.col("group_size") >= k).drop("group_size")


def fill_both(column: str) -> Column:
    """Last known value, before the first one the next known."""
    last = F.last(column, ignorenulls=True).over(so_far())
    return F.coalesce(last, F.first(column, ignorenulls=True).over(by_month().rowsBetween(0, Window.unboundedFollowing)))


def accumulate_steps(df: DataFrame, column: str, step: str = "h", largest: bool = True) -> DataFrame:
    """Running maximum (or minimum) over forecast steps."""
    w = Window.partitionBy("vin").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, (F.max if largest else F.min)(column).over(w))
