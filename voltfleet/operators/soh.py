"""State-of-health estimators, from sessions, events or samples to one value per vehicle-month.

Each returns vin, month and soh with what it is made of. Thresholds are parameters; defaults suit real telemetry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import events
from . import series as sr


def _percent(value: str | Column, base: str | Column, most: float | None = None) -> Column:
    """Value in % of a base, at most ``most``; null where the base is zero or null."""
    value, base = (F.col(x) if isinstance(x, str) else x for x in (value, base))
    share = F.try_divide(100 * value, base)
    return share if most is None else F.when(share.isNotNull(), F.least(share, F.lit(most)))


def pooled_capacity(sessions: DataFrame, min_month_dsoc: float = 30.0, bounds: tuple[float, float] = (40.0, 400.0)) -> DataFrame:
    """Monthly capacity: charge of all good sessions by their pooled swing, so that wide sessions weigh most."""
    months = sessions.groupBy("vin", F.date_trunc("month", "t0").alias("month")).agg(F.sum(F.abs("ah")).alias("ah"), F.sum("dsoc").alias("tot_dsoc"), F.count("*").alias("n_sessions"))
    out = months.withColumn("capacity_ah", F.try_divide(F.col("ah"), F.col("tot_dsoc") / 100))
    return out.where((F.col("tot_dsoc") >= min_month_dsoc) & F.col("capacity_ah").between(*bounds)).drop("ah")


def anchor_dates(months: DataFrame, registration: DataFrame) -> DataFrame:
    """vin, anchor, used_reg: the registration date if known and not later than the first month, else that month."""
    first = months.groupBy("vin").agg(F.min("month").alias("first_month")).join(registration.select("vin", "regd_date"), "vin", "left")
    used = F.coalesce(F.col("regd_date") <= F.col("first_month"), F.lit(False))
    return first.select("vin", F.when(used, F.col("regd_date")).otherwise(F.col("first_month")).alias("anchor"), used.alias("used_reg"))


def capacity_to_soh(months: DataFrame, registration: DataFrame, capacity: str = "capacity_ah", method: str = "isotonic", max_drop: float = 6.0, early: float = 11.0) -> DataFrame:
    """Health from monthly capacity, 100 at the anchor date: smoothed, over an early base grossed up by the fade of the months
    between the anchor and the first reading, then an envelope (``isotonic`` or ``greedy``)."""
    own = sr.own()
    df = months.join(anchor_dates(months, registration), "vin")
    df = df.withColumn("age_months", F.datediff("month", "anchor") / 30.4).withColumn("smooth", sr.rolling_median(capacity, 5))
    df = df.withColumns({"first_age": F.min("age_months").over(own), "span": F.max("age_months").over(own) - F.min("age_months").over(own), "months": F.count(F.lit(1)).over(own), "slope": F.regr_slope("smooth", "age_months").over(own)})
    base = F.median(F.when(F.col("age_months") <= F.col("first_age") + early, F.col("smooth"))).over(own)
    rate = F.when((F.col("months") >= 4) & (F.col("span") > 0), F.least(F.greatest(-F.col("slope") / F.greatest("base", F.lit(1e-9)), F.lit(0.0)), F.lit(0.01))).otherwise(0.0)
    df = df.withColumn("base", base).withColumn("cap0", F.col("base") * (1 + rate * F.greatest("first_age", F.lit(0.0))))
    df = df.withColumn("soh_raw", _percent("smooth", "cap0", 100.0)).drop("smooth", "first_age", "span", "months", "slope", "base", "anchor")
    return sr.robust_isotonic(df, max_drop=max_drop) if method == "isotonic" else sr.greedy_envelope(df, max_drop=max_drop)


def full_capacity_readings(df: DataFrame, low: float = 95.0, most: float = 500.0) -> DataFrame:
    """vin, month, full_cap of samples near full: remaining capacity scaled up by the state of charge. Local to a month."""
    near = df.where(F.col("soc").between(low, 100) & F.col("rem_cap").between(0, most))
    return near.select("vin", F.date_trunc("month", "t").alias("month"), (F.col("rem_cap") / (F.col("soc") / 100)).alias("full_cap"))


def remaining_capacity_soh(readings: DataFrame, min_readings: int = 15, min_months: int = 6, window: tuple[float, float] = (0.6, 1.4), floor: float = 40.0, nominal_months: int = 6, nominal_q: float = 0.9) -> DataFrame:
    """Health from full-capacity readings: those near the vehicle's median, monthly medians with enough readings, over a nominal
    quantile of the first months, as a non-increasing fit capped at 100."""
    mid = F.median("full_cap").over(Window.partitionBy("vin"))
    good = readings.withColumn("mid", mid).where((F.col("mid") >= floor) & F.col("full_cap").between(window[0] * F.col("mid"), window[1] * F.col("mid")))
    months = good.groupBy("vin", "month").agg(F.median("full_cap").alias("full_cap"), F.count("*").alias("n")).where(F.col("n") >= min_readings)
    months = sr.group_at_least(months, min_months).withColumn("rn", F.row_number().over(sr.by_month()))
    months = months.withColumn("nominal", F.percentile(F.when(F.col("rn") <= nominal_months, F.col("full_cap")), nominal_q).over(sr.own()))
    fitted = sr.isotonic_envelope(months.drop("rn"), "full_cap", None)
    return fitted.withColumn("soh", _percent("soh", "nominal", 100.0))


def reported_soh(df: DataFrame, value: str, bounds: tuple[float, float] = (40.0, 110.0), min_readings: int = 15, min_months: int = 4, smooth: int = 3) -> DataFrame:
    """Health as the battery reports it: monthly medians in bounds, smoothed, capped at 100, running minimum; not scaled anew."""
    good = df.where(F.col(value).between(*bounds))
    months = good.groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(F.median(value).alias("reported"), F.count("*").alias("n")).where(F.col("n") >= min_readings)
    months = sr.group_at_least(months, min_months)
    months = months.withColumn("soh_raw", F.least(sr.rolling_median("reported", smooth), F.lit(100.0)))
    return months.withColumn("soh", sr.running_min("soh_raw"))


def distance_proxy(segments: DataFrame, min_segments: int = 3, bounds: tuple[float, float] = (20.0, 400.0), min_months: int = 4, base_months: int = 6, clip: tuple[float, float] = (40.0, 110.0)) -> DataFrame:
    """Distance per full charge by month, relative to the median of the first months; bounded, no envelope."""
    months = segments.groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(_percent(F.sum("dkm"), F.sum("dsoc")).alias("range_km"), F.count("*").alias("n"))
    months = sr.group_at_least(months.where((F.col("n") >= min_segments) & F.col("range_km").between(*bounds)), min_months)
    months = months.withColumn("rn", F.row_number().over(sr.by_month()))
    base = F.median(F.when(F.col("rn") <= base_months, F.col("range_km"))).over(sr.own())
    return months.withColumn("soh", F.greatest(_percent("range_km", base, clip[1]), F.lit(clip[0]))).drop("rn")


def first_month_proxy(months: DataFrame, value: str) -> DataFrame:
    """Value relative to the first month's, running minimum, capped at 100."""
    base = F.first(value).over(sr.so_far())
    raw = months.withColumn("soh_raw", _percent(value, base, 100.0))
    return raw.withColumn("soh", sr.running_min("soh_raw"))


def full_charge_soh(charges: DataFrame, cap: str = "cap", low_age: float = 1.0, high_age: float = 12.0, least: int = 2, first: int = 5) -> DataFrame:
    """Health of each full charge: capacity over the median of those in an early age window, else of the first ones."""
    rn = F.row_number().over(Window.partitionBy("vin").orderBy("t0"))
    early = F.col("age_months").between(low_age, high_age)
    base = charges.withColumn("rn", rn).groupBy("vin").agg(F.count_if(early).alias("k"), F.median(F.when(early, F.col(cap))).alias("a"), F.median(F.when(F.col("rn") <= first, F.col(cap))).alias("b"))
    base = base.select("vin", F.when(F.col("k") >= least, F.col("a")).otherwise(F.col("b")).alias("cap0"))
    return charges.join(base, "vin").withColumn("soh_full", _percent(cap, "cap0", 100.0))


def upper_quartile_soh(sessions: DataFrame, min_sessions: int = 3) -> DataFrame:
    """Monthly upper quartile of session capacity, smoothed, over the median of the first three months; at most 102, never rising."""
    months = sessions.groupBy("vin", F.date_trunc("month", "t0").alias("month")).agg(F.percentile("cap", 0.75).alias("cap"), F.count("*").alias("n")).where(F.col("n") >= min_sessions)
    months = months.withColumn("smooth", sr.rolling_median("cap", 3)).withColumn("rn", F.row_number().over(sr.by_month()))
    base = F.median(F.when(F.col("rn") <= 3, F.col("smooth"))).over(sr.own())
    months = months.withColumn("soh_raw", _percent("smooth", base, 102.0))
    return months.withColumn("soh", sr.running_min("soh_raw")).drop("rn", "smooth")


def align_methods(**methods: DataFrame) -> DataFrame:
    """Full outer join of vin, month, soh tables; a column for each method."""
    out = None
    for name, df in methods.items():
        part = df.select("vin", "month", F.col("soh").alias(name))
        out = part if out is None else out.join(part, ["vin", "month"], "full")
    return out


def charge_rate_proxy(df: DataFrame, low: float = 30.0, high: float = 70.0) -> DataFrame:
    """Monthly median charge rate of a vehicle's consistent charges."""
    rates = events.consistent(events.crossing_rates(df, low, high))
    return rates.groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(F.median("rate").alias("rate"), F.count("*").alias("n"))


def daily_fade(df: DataFrame, value: str, k: int = 7) -> DataFrame:
    """Trend of the smoothed daily median: points per year and per 1000 km."""
    days = df.groupBy("vin", F.date_trunc("day", "t").alias("month")).agg(F.median(value).alias("x"), F.max("odo").alias("odo"))
    days = days.withColumn("smooth", sr.trailing_median("x", k)).withColumn("years", F.datediff("month", F.min("month").over(sr.own())) / 365.25)
    return days.groupBy("vin").agg(F.regr_slope("smooth", "years").alias("per_year"), (F.regr_slope("smooth", "odo") * 1000).alias("per_1000_km"), F.count("*").alias("days"))


def prefer(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of the first source, and the second's vehicles that it lacks."""
    return first.unionByName(second.join(first.select("vin").distinct(), "vin", "left_anti"), allowMissingColumns=True)


def hybrid_target(production: DataFrame, clean: DataFrame, decliners: DataFrame) -> DataFrame:
    """Production health for confirmed decliners, the clean label for others; null without a label."""
    df = production.select("vin", "month", F.col("soh").alias("production")).join(clean.select("vin", "month", F.col("soh").alias("clean")), ["vin", "month"], "left")
    df = df.join(decliners.select("vin").distinct().withColumn("decliner", F.lit(True)), "vin", "left").withColumn("decliner", F.coalesce("decliner", F.lit(False)))
    return df.withColumn("soh_hybrid", F.when(F.col("decliner"), F.col("production")).otherwise(F.col("clean")))


#: The feature store's columns in order, with their types: fixed values.
CONTRACT = (
    "vin string, ymd string, capacity_ah double, n_sessions long, tot_dsoc double, age_months double, used_reg boolean, soh_raw double, soh double, ah_throughput double, "
    "cur_abs_mean double, cur_dis_mean double, cur_chg_mean double, soc_mean double, frac_soc_high double, frac_soc_low double, volt_mean double, volt_min double, volt_max double, "
    "n_rows_ic long, cur_abs_p95 double, dod_mean double, temp_mean double, temp_max double, dte_mean double, odo_max double, km_month double, cum_ah double, cum_km double, "
    "inv_sqrt_age double, soh_deficit double"
)


def assemble(soh: DataFrame, features: DataFrame) -> DataFrame:
    """Feature store rows: health joined with features and usage, cumulative columns, padded to the contract's columns."""
    df = soh.join(features, ["vin", "month"], "left").withColumn("km_month", sr.km_from_odometer("odo_max"))
    df = sr.cumulative(df.fillna(0, ["ah_throughput"]), {"ah_throughput": "cum_ah", "km_month": "cum_km"})
    df = df.withColumns({"inv_sqrt_age": 1 / F.sqrt(F.greatest("age_months", F.lit(0.0)) + 1), "soh_deficit": 100 - F.col("soh"), "ymd": F.date_format("month", "yyyy-MM-dd")})
    df = df.withColumnRenamed("n_rows", "n_rows_ic") if "n_rows" in df.columns else df
    fields = [f.strip().split(" ") for f in CONTRACT.split(",")]
    return df.select([(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])


def simple_soh(df: DataFrame, method: str, **options) -> DataFrame:  # noqa: ANN003
    """Health by a named method from its own input: coulomb (good sessions), bms_capacity (readings) or reported (samples)."""
    if method == "coulomb":
        months = pooled_capacity(df, **options)
        top = F.max("capacity_ah").over(sr.own())
        return sr.isotonic_envelope(months.withColumn("soh_raw", _percent("capacity_ah", top)))
    return {"bms_capacity": remaining_capacity_soh, "reported": reported_soh}[method](df, **options)


