"""Reductions to vehicle-month, vehicle and fleet. All are hash aggregates with partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import selection
from .events import session_rollup


def flag_share(condition: Column) -> Column:
    """Share of rows that meet a condition; rows where it is unknown count as not meeting it."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def electrical_features(with_sessions: DataFrame, high: float = 90.0, low: float = 20.0, min_dod: float = 3.0, nominal: float | None = None) -> DataFrame:
    """Throughput, current, voltage, dwell and depth of discharge of each vehicle-month, from samples with sessions (sid, dq)."""
    amps, soc, volts = F.col("amps"), F.col("soc"), F.col("volts")
    feats = with_sessions.groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(
        F.sum(F.abs("dq")).alias("ah_throughput"),
        F.avg(F.abs(amps)).alias("cur_abs_mean"),
        F.coalesce(F.avg(F.when(amps < 0, amps)), F.lit(0.0)).alias("cur_dis_mean"),
        F.coalesce(F.avg(F.when(amps > 0, amps)), F.lit(0.0)).alias("cur_chg_mean"),
        F.avg(soc).alias("soc_mean"),
        flag_share(soc > high).alias("frac_soc_high"),
        flag_share(soc < low).alias("frac_soc_low"),
        F.avg(volts).alias("volt_mean"),
        F.min(volts).alias("volt_min"),
        F.max(volts).alias("volt_max"),
        F.count("*").alias("n_rows"),
        F.percentile(F.abs(amps), 0.95).alias("cur_abs_p95"),
        F.avg("temp").alias("temp_mean"),
        F.max("temp").alias("temp_max"),
        F.max("odo").alias("odo_max"),
    )
    if nominal:
        feats = feats.withColumn("crate_p95", F.col("cur_abs_p95") / nominal)
    return feats.join(depth_of_discharge(with_sessions, min_dod), ["vin", "month"], "left")


def depth_of_discharge(with_sessions: DataFrame, least: float = 3.0) -> DataFrame:
    """Mean fall of the state of charge over sessions that fall at least so far, by the month a session starts in."""
    rolled = session_rollup(with_sessions).withColumn("dod", F.col("soc0") - F.col("soc1")).where(F.col("dod") >= least)
    return rolled.groupBy("vin", F.date_trunc("month", "t0").alias("month")).agg(F.avg("dod").alias("dod_mean"))


def simple_features(df: DataFrame) -> DataFrame:
    """The plain variant: steps of at most an hour, depth as the month's range of the state of charge."""
    w = Window.partitionBy("vin").orderBy("t", "id")
    hours = F.least(F.greatest((F.unix_micros("t") - F.unix_micros(F.lag("t").over(w))) / 3.6e9, F.lit(0.0)), F.lit(1.0))
    months = df.withColumn("ah", F.coalesce(F.abs("amps") * hours, F.lit(0.0))).groupBy("vin", F.date_trunc("month", "t").alias("month"))
    return months.agg(
        F.sum("ah").alias("ah_throughput"),
        F.avg(F.when(F.col("amps") < 0, -F.col("amps"))).alias("cur_dis_mean"),
        flag_share(F.col("soc") >= 80).alias("frac_soc_high"),
        flag_share(F.col("soc") <= 20).alias("frac_soc_low"),
        (F.max("soc") - F.min("soc")).alias("dod_mean"),
    )


def usage_features(df: DataFrame) -> DataFrame:
    """Distance, drive share, temperatures and mean state of charge of each vehicle-month."""
    return df.groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(
        (F.max("odo") - F.min("odo")).alias("km"),
        flag_share(F.col("amps") < 0).alias("drive_share"),
        F.avg("soc").alias("soc_mean"),
        F.avg("temp").alias("temp_mean"),
        F.max("temp").alias("temp_max"),
        F.percentile("temp", 0.95).alias("temp_p95"),
        F.max("odo").alias("odo_max"),
    )


def energy_per_km(df: DataFrame) -> DataFrame:
    """wh_per_km: charge times voltage by distance; null without distance."""
    return df.withColumn("wh_per_km", F.try_divide(F.col("ah_throughput") * F.col("volt_mean"), F.col("km")))


def coverage(df: DataFrame) -> DataFrame:
    """Rows, distinct months, first and last sample and share of each mode."""
    return df.groupBy("vin").agg(F.count("*").alias("n"), F.count_distinct(F.date_trunc("month", "t")).alias("months"), F.count_distinct(F.date_trunc("day", "t")).alias("days"), F.min("t").alias("first_seen"), F.max("t").alias("last_seen"))


def mode_shares(df: DataFrame, by: str = "vin") -> DataFrame:
    rows = df.groupBy(by, "mode").agg(F.count("*").alias("n"))
    return rows.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def first_last(df: DataFrame, value: str, order: str = "month", by: str = "vin") -> DataFrame:
    """First and last value that is not null, fall between them, span and number."""
    has = F.when(F.col(value).isNotNull(), F.col(order))
    out = df.groupBy(by).agg(F.min_by(value, has).alias("first"), F.max_by(value, has).alias("last"), (F.max(value) - F.min(value)).alias("range"), F.count(value).alias("n"))
    return out.withColumn("drop", F.col("first") - F.col("last"))


def edge_means(df: DataFrame, value: str, k: int = 3, order: str = "month", by: str = "vin") -> DataFrame:
    """Mean of the first k and of the last k rows, and their difference."""
    up, down = F.row_number().over(Window.partitionBy(by).orderBy(order)), F.row_number().over(Window.partitionBy(by).orderBy(F.desc(order)))
    out = df.withColumns({"up": up, "down": down}).groupBy(by).agg(F.avg(F.when(F.col("up") <= k, F.col(value))).alias("start"), F.avg(F.when(F.col("down") <= k, F.col(value))).alias("end"))
    return out.withColumn("drop", F.col("start") - F.col("end"))


def age_band(df: DataFrame, value: str, width: int = 3, least: int = 5) -> DataFrame:
    """Fleet median and 10 % and 90 % quantiles in age bins with enough rows."""
    p = lambda q: F.percentile(value, q)
    out = df.groupBy((F.bround(F.col("age_months") / width) * width).alias("age")).agg(F.count(value).alias("n"), p(0.5).alias("p50"), p(0.1).alias("p10"), p(0.9).alias("p90"))
    return out.where(F.col("n") >= least)


def fleet_stat(df: DataFrame, column: str, least: int = 10) -> DataFrame:
    """One row: number, median and outer deciles of a column; none with too few values."""
    return selection.exact_quantiles(df, column, (0.5, 0.1, 0.9)).where(F.col("n") >= least).select("n", F.col("q")[0].alias("median"), F.col("q")[1].alias("p10"), F.col("q")[2].alias("p90"))


def feed_coverage(a: DataFrame, b: DataFrame, by: str = "month") -> DataFrame:
    """Rows of two feeds side by side; 0 where a feed has none."""
    left, right = a.groupBy(by).agg(F.count("*").alias("n_a")), b.groupBy(by).agg(F.count("*").alias("n_b"))
    return left.join(right, by, "full").fillna(0, ["n_a", "n_b"])


def binned_median(df: DataFrame, value: str, over: str, width: float) -> DataFrame:
    return df.groupBy((F.floor(F.col(over) / width) * width).cast("double").alias("bin")).agg(F.median(value).alias("median"), F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows of each of ``bins`` equal buckets 1 to ``bins``; 0 and ``bins`` + 1 lie outside."""
    return df.where(F.col(column).isNotNull()).groupBy(F.width_bucket(column, F.lit(low), F.lit(high), F.lit(bins)).alias("bucket")).agg(F.count("*").alias("n"))


def survival(df: DataFrame, by: str, value: str = "soh", limit: float = 80.0) -> DataFrame:
    """Number, share at or above a limit, median and number below it of each group."""
    above = F.col(value) >= limit
    return df.groupBy(by).agg(F.count("*").alias("n"), F.avg(above.cast("double")).alias("share_ok"), F.median(value).alias("median"), F.count_if(~above).alias("at_risk"))


def positive_median(column: str) -> Column:
    return F.median(F.when(F.col(column) > 0, F.col(column)))


def quartile_curves(df: DataFrame, value: str, usage: str) -> DataFrame:
    """Mean value by rounded age in each usage quartile of vehicles."""
    use = df.groupBy("vin").agg(F.avg(usage).alias("use"))
    cuts = selection.exact_quantiles(use, "use", (0.25, 0.5, 0.75)).select("q")
    use = use.crossJoin(F.broadcast(cuts)).withColumn("quartile", 1 + F.size(F.filter("q", lambda x: x < F.col("use"))))
    return df.join(use.select("vin", "quartile"), "vin").groupBy("quartile", F.bround("age_months").alias("age")).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def mean_of_daily_minima(df: DataFrame, column: str) -> DataFrame:
    days = df.groupBy("vin", F.date_trunc("day", "t").alias("day")).agg(F.min(column).alias("low"))
    return days.groupBy("vin", F.date_trunc("month", "day").alias("month")).agg(F.avg("low").alias("mean_low"))


def fleet_coverage(modelled: DataFrame, fleet: DataFrame, by: str) -> DataFrame:
    """Vehicles with a model and in the fleet, by group."""
    out = fleet.join(modelled.select("vin").distinct().withColumn("has", F.lit(1)), "vin", "left")
    return out.groupBy(by).agg(F.count_distinct("vin").alias("fleet"), F.count_distinct(F.when(F.col("has") == 1, F.col("vin"))).alias("modelled"))


def change_classes(df: DataFrame, value: str, least: float = 2.0) -> DataFrame:
    """How many vehicles fell, rose or stayed within ``least`` points."""
    drop = first_last(df, value)
    return drop.groupBy(F.when(F.col("drop") >= least, "fall").when(F.col("drop") <= -least, "rise").otherwise("flat").alias("class")).agg(F.count("*").alias("n"), F.median("drop").alias("median"))


def threshold_sweep(events: DataFrame, thresholds: list[float], value: str = "cap") -> DataFrame:
    """For each least end voltage: vehicles, median coefficient of variation and median events a vehicle."""
    limits = F.explode(F.array(*map(F.lit, thresholds))).alias("limit")
    rows = events.select("*", limits).where(F.col("v1") >= F.col("limit")).groupBy("limit", "vin").agg((F.stddev_samp(value) / F.avg(value) * 100).alias("cv"), F.count("*").alias("n"))
    return rows.groupBy("limit").agg(F.count("*").alias("vehicles"), F.median("cv").alias("cv"), F.median("n").alias("n"))


def age_classes(df: DataFrame, value: str, flat: float = 2.0) -> DataFrame:
    """Vehicles by age band, flat ones apart."""
    per = df.groupBy("vin").agg(F.max("age_months").alias("age"), (F.max_by(value, F.col("month")) - F.min_by(value, F.col("month"))).alias("change"))
    band = F.when(F.abs("change") < flat, "flat").when(F.col("age") < 24, "young").when(F.col("age") < 48, "middle").otherwise("old")
    return per.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.avg("change").alias("change"))


def distance_to_empty(feed: DataFrame, value: str = "dte", bounds: tuple[float, float] = (0.0, 1000.0)) -> DataFrame:
    """vin, month, dte_mean: monthly mean of the distance to empty that a second feed reports, within plausible bounds."""
    return feed.where(F.col(value).between(*bounds)).groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(F.avg(value).alias("dte_mean"))


def share_below(df: DataFrame, value: str, limit: float, by: str) -> DataFrame:
    """Per group: vehicles, how many have a latest value below a limit, and their share."""
    now = df.groupBy("vin", by).agg(F.max_by(value, "month").alias("now"))
    return now.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col("now") < limit).alias("n_risk")).withColumn("share", F.col("n_risk") / F.col("n"))
