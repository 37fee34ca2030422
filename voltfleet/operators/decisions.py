"""Remaining life, warranty risk and other decisions from histories and forecasts.

A forecast is a long table: vin, h (months ahead), age_months, p10, p50, p90. A fleet row is vin, age_months, soh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from . import joins
from . import series as sr

DAYS_PER_MONTH = 30.4375


def sqrt_forecast(df: DataFrame, soh: str = "soh", months: int = 60, width: float = 1.5) -> DataFrame:
    """Robust trend on the root of age, anchored at the last value and never rising; the band grows with the root of the horizon."""
    df = df.withColumn("root", F.sqrt(F.greatest("age_months", F.lit(0.0))))
    fit = stats.theil_sen(df, "root", soh).select("vin", F.least("slope", F.lit(0.0)).alias("slope"))
    last = df.groupBy("vin").agg(F.max_by(soh, "month").alias("now"), F.max("age_months").alias("age0"))
    steps = last.join(fit, "vin").withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(months))))
    p50 = F.col("now") + F.col("slope") * (F.sqrt(F.greatest(F.col("age0") + F.col("h"), F.lit(0.0))) - F.sqrt(F.greatest("age0", F.lit(0.0))))
    steps = steps.withColumn("p50", p50).withColumns({"p10": F.col("p50") - width * F.sqrt("h"), "p90": F.least(F.col("p50") + width * F.sqrt("h"), F.col("now"))})
    return steps.select("vin", "h", (F.col("age0") + F.col("h")).alias("age_months"), "p10", "p50", "p90")


def months_to_eol(df: DataFrame, soh: str = "soh", eol: float = 80.0) -> DataFrame:
    """vin, months: closed form of the anchored root-of-age trend; 0 if already there, null if it never gets there."""
    df = df.withColumn("root", F.sqrt(F.greatest("age_months", F.lit(0.0))))
    fit = stats.theil_sen(df, "root", soh).select("vin", "slope")
    last = df.groupBy("vin").agg(F.max_by(soh, "month").alias("now"), F.max("age_months").alias("age0"))
    root = F.sqrt(F.greatest("age0", F.lit(0.0))) + (F.lit(eol) - F.col("now")) / F.col("slope")
    out = F.when(F.col("now") <= eol, 0.0).when(F.col("slope") < 0, root * root - F.col("age0"))
    return last.join(fit, "vin").select("vin", "now", out.alias("months"))


def persistence(df: DataFrame, soh: str = "soh", months: int = 60) -> DataFrame:
    last = df.groupBy("vin").agg(F.max_by(soh, "month").alias("p50"), F.max("age_months").alias("age0"))
    return last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(months)))).select("vin", "h", (F.col("age0") + F.col("h")).alias("age_months"), "p50")


def linear_forecast(df: DataFrame, soh: str = "soh", window: float = 12.0, months: int = 60) -> DataFrame:
    """Slope between the ends of the last ``window`` months carried on."""
    own = sr.own()
    recent = df.withColumn("last_age", F.max("age_months").over(own)).where(F.col("age_months") >= F.col("last_age") - window)
    ends = recent.groupBy("vin").agg(F.min_by(soh, "month").alias("a"), F.max_by(soh, "month").alias("b"), F.min("age_months").alias("ta"), F.max("age_months").alias("tb"))
    slope = F.when(F.col("tb") > F.col("ta"), F.least((F.col("b") - F.col("a")) / (F.col("tb") - F.col("ta")), F.lit(0.0))).otherwise(0.0)
    return ends.withColumn("slope", slope).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(months)))).select("vin", "h", (F.col("tb") + F.col("h")).alias("age_months"), (F.col("b") + F.col("slope") * F.col("h")).alias("p50"))


def calibrate_band(residuals: DataFrame, low: float = 0.1, high: float = 0.9, floor: float = 0.3) -> DataFrame:
    """One row: lo, hi of residual (actual less p50) over the root of the horizon, at least ``floor`` wide each way."""
    q = F.percentile(F.col("residual") / F.sqrt("h"), F.array(F.lit(low), F.lit(high)))
    return residuals.where("h > 0").agg(q.alias("q")).select(F.least(F.col("q")[0], F.lit(-floor)).alias("lo"), F.greatest(F.col("q")[1], F.lit(floor)).alias("hi"))


def compact_rate(df: DataFrame, soh: str = "soh") -> DataFrame:
    """One row: median monthly rate of the fleet's non-increasing fits and quantiles of the residuals."""
    fit = sr.isotonic_envelope(df.select("vin", "month", "age_months", F.col(soh).alias("actual")), "actual", None)
    rates = fit.groupBy("vin").agg(((F.max_by("soh", "month") - F.min_by("soh", "month")) / F.greatest(F.max("age_months") - F.min("age_months"), F.lit(1.0))).alias("rate"))
    off = fit.agg(F.percentile(F.col("actual") - F.col("soh"), F.array(F.lit(0.1), F.lit(0.9))).alias("q"))
    return rates.agg(F.median("rate").alias("rate")).crossJoin(off).select("rate", F.col("q")[0].alias("q10"), F.col("q")[1].alias("q90"))


def remaining_months(forecast: DataFrame, eol: float = 80.0) -> DataFrame:
    """vin, rul_months: first step with p50 at or below ``eol``."""
    return forecast.groupBy("vin").agg(F.min(F.when(F.col("p50") <= eol, F.col("h"))).alias("rul_months"))


def km_per_month(df: DataFrame, odo: str = "odo_max") -> DataFrame:
    """vin, km_per_month between the first and last odometer reading."""
    good = df.where(F.col(odo) > 0)
    ends = good.groupBy("vin").agg(F.min_by(F.struct("age_months", F.col(odo).alias("o")), "age_months").alias("a"), F.max_by(F.struct("age_months", F.col(odo).alias("o")), "age_months").alias("b"))
    span = F.col("b.age_months") - F.col("a.age_months")
    return ends.select("vin", F.when((span > 0) & (F.col("b.o") > F.col("a.o")), (F.col("b.o") - F.col("a.o")) / span).alias("km_per_month"))


def remaining_km(now: DataFrame, forecast: DataFrame, pace: DataFrame, limits: tuple[float, ...] = (80.0, 70.0, 60.0)) -> DataFrame:
    """vin, limit, km: interpolated months until each limit times the pace; 0 if already below, null if never within the forecast.

    ``now``: vin, age_months, soh.
    """
    path = now.select("vin", F.lit(0).alias("h"), F.col("soh").alias("p50")).unionByName(forecast.select("vin", "h", "p50"))
    w = Window.partitionBy("vin").orderBy("h")
    path = path.withColumns({"before": F.lag("p50").over(w), "h0": F.lag("h").over(w)})
    at = path.select("vin", "h", "h0", "p50", "before", F.explode(F.array(*map(F.lit, limits))).alias("limit")).where(F.col("p50") <= F.col("limit"))
    crossing = F.when(F.col("before").isNull(), 0.0).otherwise(F.col("h0") + (F.col("before") - F.col("limit")) / (F.col("before") - F.col("p50")) * (F.col("h") - F.col("h0")))
    first = at.groupBy("vin", "limit").agg(F.min_by(crossing, "h").alias("months"))
    every = now.select("vin", F.explode(F.array(*map(F.lit, limits))).alias("limit"))
    return every.join(first, ["vin", "limit"], "left").join(pace, "vin", "left").withColumn("km", F.col("months") * F.col("km_per_month"))


def at_risk(forecast: DataFrame, deadline: DataFrame, eol: float = 80.0) -> DataFrame:
    """vin, at_risk, at_risk_worst: whether p50, or p10, is at or below ``eol`` by the deadline age (vin, deadline)."""
    due = forecast.join(deadline.select("vin", "deadline"), "vin").where(F.col("age_months") <= F.col("deadline"))
    return deadline.select("vin").join(due.groupBy("vin").agg(F.bool_or(F.col("p50") <= eol).alias("a"), F.bool_or(F.col("p10") <= eol).alias("b")), "vin", "left").select("vin", F.coalesce("a", F.lit(False)).alias("at_risk"), F.coalesce("b", F.lit(False)).alias("at_risk_worst"))


def outcome_groups(forecast: DataFrame, deadline: DataFrame, past: DataFrame, eol: float = 80.0, flat: float = 2.0, proven: float = 24.0) -> DataFrame:
    """vin, outcome at the forecast step nearest the deadline; flat vehicles are genuine with a long history only.

    ``past``: vin, soh_drop, age_months.
    """
    near = joins.nearest(forecast, deadline.select("vin", "deadline"), "age_months", "deadline", ["p50"]).select("vin", "p50")
    rows = near.join(past.select("vin", "soh_drop", F.col("age_months").alias("age")), "vin")
    flat_one = F.col("soh_drop") < flat
    return rows.select("vin", "p50", F.when(F.col("p50") <= eol, "at_risk").when(flat_one & (F.col("age") >= proven), "flat").when(flat_one, "flat_unproven").otherwise("safe").alias("outcome"))


def risk_tier(forecast: DataFrame, deadline: DataFrame, eol: float = 80.0) -> DataFrame:
    """vin, months_early, tier by how long before the deadline ``eol`` is reached."""
    first = forecast.groupBy("vin").agg(F.min(F.when(F.col("p50") <= eol, F.col("age_months"))).alias("eol_age"))
    early = deadline.join(first, "vin", "left").withColumn("months_early", F.col("deadline") - F.col("eol_age"))
    tier = F.when(F.coalesce(F.col("months_early") <= 0, F.lit(True)), "none").when(F.col("months_early") <= 6, "low").when(F.col("months_early") <= 18, "moderate").otherwise("high")
    return early.select("vin", "months_early", tier.alias("tier"))


def effective_deadline(df: DataFrame, years: Column, km_limit: Column, odo: str = "odo_max", pace: str = "km_month") -> DataFrame:
    """vin, deadline: the earlier of the time term and the age at which the distance limit is hit at the recent pace."""
    recent = sr.last_values(df, pace).withColumnRenamed(pace, "pace")
    last = df.groupBy("vin").agg(F.max("age_months").alias("age"), F.max(odo).alias("odo")).join(recent, "vin")
    by_km = F.when(F.col("pace") > 0, F.col("age") + F.greatest(km_limit - F.col("odo"), F.lit(0.0)) / F.col("pace"))
    return last.select("vin", F.least(years * 12.0, by_km).alias("deadline"))


def warranty_table(now: DataFrame, forecast: DataFrame, deadline: DataFrame, pace: DataFrame, eol: float = 80.0) -> DataFrame:
    """vin, deadline, soh and km at expiry (interpolated), age and month of the breach, confidence by length of extrapolation."""
    knots = now.select("vin", "age_months", F.col("soh").alias("p50")).unionByName(forecast.select("vin", "age_months", "p50"))
    expiry = joins.interpolate(knots, deadline.select("vin", F.col("deadline").alias("age_months")), "age_months", "p50").withColumnsRenamed({"age_months": "deadline", "p50": "soh_at_expiry"})
    breach = knots.groupBy("vin").agg(F.min(F.when(F.col("p50") <= eol, F.col("age_months"))).alias("breach_age"))
    rows = expiry.join(breach, "vin", "left").join(now.select("vin", F.col("age_months").alias("age"), "month", "odo"), "vin").join(pace, "vin", "left")
    ahead = F.col("deadline") - F.col("age")
    return rows.select(
        "vin",
        "deadline",
        "soh_at_expiry",
        (F.col("odo") + F.greatest(ahead, F.lit(0.0)) * F.coalesce("km_per_month", F.lit(0.0))).alias("km_at_expiry"),
        "breach_age",
        F.date_add(F.to_date("month"), F.round((F.col("breach_age") - F.col("age")) * DAYS_PER_MONTH).cast("int")).alias("breach_date"),
        F.when(ahead <= 12, "high").when(ahead <= 36, "medium").otherwise("low").alias("confidence"),
    )


def status(soh_at_deadline: Column, eol: float = 80.0, margin: float = 2.0) -> Column:
    return F.when(soh_at_deadline < eol, "AT-RISK").when(soh_at_deadline < eol + margin, "WATCH").otherwise("OK")


def vehicle_index(df: DataFrame, deadline: DataFrame, soh: str = "soh", eol: float = 80.0) -> DataFrame:
    """vin, drop (of edge means), flat, months to ``eol``, whether it comes before the deadline, and a score for demonstrations."""
    from .monthly import edge_means

    edges = edge_means(df, soh).select("vin", "drop")
    life = months_to_eol(df, soh, eol)
    age = df.groupBy("vin").agg(F.max("age_months").alias("age"), F.count("*").alias("months_seen"))
    rows = edges.join(life, "vin").join(age, "vin").join(deadline, "vin")
    rows = rows.withColumn("at_risk", F.coalesce(F.col("age") + F.col("months") < F.col("deadline"), F.lit(False)))
    return rows.withColumns({"flat": F.col("drop") < 2, "score": F.col("months_seen") + 5 * F.greatest("drop", F.lit(0.0))})


def cycles_to_eol(df: DataFrame, cycles: str, soh: str = "soh", eol: float = 80.0) -> DataFrame:
    """vin, cycles_left: missing health over fade per cycle; null without fade."""
    per = df.groupBy("vin").agg(F.max_by(soh, "month").alias("last"), (F.min_by(soh, "month") - F.max_by(soh, "month")).alias("fade"), (F.max(cycles) - F.min(cycles)).alias("cycles"))
    return per.select("vin", F.when(F.col("fade") > 0, F.greatest(F.col("last") - eol, F.lit(0.0)) / F.try_divide("fade", "cycles")).alias("cycles_left"))


def soh_at_date(observed: DataFrame, forecast: DataFrame, dates: DataFrame, anchor: DataFrame) -> DataFrame:
    """vin, date, soh, observed: health at a date, between observations or else on the forecast.

    ``dates``: vin, date; ``anchor``: vin, anchor date of age 0.
    """
    asked = dates.join(anchor, "vin").withColumn("age_months", F.datediff("date", "anchor") / 30.4).drop("anchor")
    knots = observed.select("vin", "age_months", "soh").unionByName(forecast.select("vin", "age_months", F.col("p50").alias("soh")))
    last = observed.groupBy("vin").agg(F.max("age_months").alias("last_age"))
    return joins.interpolate(knots, asked, "age_months", "soh").join(last, "vin").withColumn("observed", F.col("age_months") <= F.col("last_age")).drop("last_age")


def start_cohorts(df: DataFrame, soh: str = "soh") -> DataFrame:
    """Vehicles by first month with ages counted from it: number and mean health by rounded age."""
    first = df.withColumn("start", F.min("month").over(sr.own())).withColumn("age0", F.bround(F.datediff("month", "start") / 30.4))
    return first.groupBy(F.date_format("start", "yyyy").alias("cohort"), "age0").agg(F.count_distinct("vin").alias("vehicles"), F.avg(soh).alias("soh"))


def risk_cause(df: DataFrame, columns: list[str], least: float = 0.5) -> DataFrame:
    """vin, cause: the stress whose recent level is most above the fleet's, if at least ``least`` deviations."""
    recent = None
    for c in columns:
        part = sr.last_values(df, c)
        recent = part if recent is None else recent.join(part, "vin")
    stat = recent.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = recent.crossJoin(F.broadcast(stat)).select("vin", F.array(*[F.coalesce(F.try_divide(F.col(c) - F.col(f"m_{c}"), F.col(f"s_{c}")), F.lit(0.0)) for c in columns]).alias("z"))
    top = F.array_max("z")
    name = F.element_at(F.array(*map(F.lit, columns)), F.array_position("z", top).cast("int"))
    return z.select("vin", top.alias("level"), F.when(top >= least, name).otherwise("none").alias("cause"))


def drop_at_distance(df: DataFrame, km: float, stress: list[str], soh: str = "soh", odo: str = "cum_km") -> DataFrame:
    """vin, drop: health lost at a fixed distance (interpolated) and mean stress before it, of vehicles that got there."""
    reached = df.groupBy("vin").agg(F.max(odo).alias("top"), F.min_by(soh, "month").alias("start")).where(F.col("top") >= km)
    asked = reached.select("vin", F.lit(km).alias(odo))
    at = joins.interpolate(df.select("vin", odo, soh), asked, odo, soh).select("vin", F.col(soh).alias("there"))
    means = df.where(F.col(odo) <= km).groupBy("vin").agg(*[F.avg(c).alias(c) for c in stress])
    return reached.join(at, "vin").join(means, "vin", "left").select("vin", (F.col("start") - F.col("there")).alias("drop"), *stress)


def usage_against_loss(df: DataFrame, usage: str = "km_month", soh: str = "soh") -> DataFrame:
    """vin: correlation, rank correlation and slope of monthly loss on monthly usage."""
    rows = df.withColumn("loss", F.lag(soh).over(sr.by_month()) - F.col(soh)).where("loss is not null")
    a = rows.groupBy("vin").agg(F.corr(usage, "loss").alias("pearson"), F.regr_slope("loss", usage).alias("slope"), F.count("*").alias("n"))
    return a.join(stats.spearman(rows, usage, "loss", "vin").select("vin", F.col("rho").alias("spearman")), "vin", "left")
