"""Sessions, charge events, segments and resampling of irregular samples (vin, t, id, soc, amps, volts, odo)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_time() -> WindowSpec:
    return Window.partitionBy("vin").orderBy("t", "id")


def _so_far() -> WindowSpec:
    return by_time().rowsBetween(Window.unboundedPreceding, 0)


def seconds(t: Column) -> Column:
    """Seconds since the epoch, with fractions."""
    return F.unix_micros(t) / 1e6


def with_step(df: DataFrame) -> DataFrame:
    """dt: seconds since the vehicle's previous sample, null at its first."""
    return df.withColumn("dt", seconds(F.col("t")) - seconds(F.lag("t").over(by_time())))


def sessions(df: DataFrame, gap_s: float = 300.0, break_at_month: bool = True) -> DataFrame:
    """Adds dt, sid and dq: a session starts at a vehicle's first sample, after a gap, at a step that is not positive and, so that
    months can be computed on their own, at a month's start. dq is the trapezoid charge in Ah since the last sample of the session."""
    df = with_step(df)
    start = F.col("dt").isNull() | (F.col("dt") > gap_s) | (F.col("dt") <= 0)
    if break_at_month:
        start = start | (F.date_trunc("month", "t") != F.lag(F.date_trunc("month", "t")).over(by_time()))
    df = df.withColumn("start", start).withColumn("before", F.lag("amps").over(by_time())).withColumn("sid", F.sum(F.col("start").cast("long")).over(_so_far()))
    dq = F.when(~F.col("start"), F.coalesce((F.col("amps") + F.col("before")) / 2 * F.col("dt") / 3600, F.lit(0.0))).otherwise(0.0)
    return df.withColumn("dq", dq).drop("start", "before")


def session_rollup(df: DataFrame) -> DataFrame:
    """vin, sid, t0, soc0, soc1 (first and last that are not null), ah, n of each session."""
    order = F.struct("t", "id")
    has = F.col("soc").isNotNull()
    return df.groupBy("vin", "sid").agg(
        F.min("t").alias("t0"),
        F.max("t").alias("t1"),
        F.min_by("soc", F.when(has, order)).alias("soc0"),
        F.max_by("soc", F.when(has, order)).alias("soc1"),
        F.sum("dq").alias("ah"),
        F.count("*").alias("n"),
    )


def session_capacity(rolled: DataFrame, min_rows: int = 5, min_dsoc: float = 2.0, bounds: tuple[float, float] = (40.0, 400.0)) -> DataFrame:
    """Sessions long and deep enough, with dsoc and capacity in Ah at full swing within bounds."""
    out = rolled.withColumn("dsoc", F.abs(F.col("soc1") - F.col("soc0"))).where((F.col("n") >= min_rows) & (F.col("dsoc") >= min_dsoc))
    return out.withColumn("cap", F.abs("ah") / (F.col("dsoc") / 100)).where(F.col("cap").between(*bounds))


def slope_capacity(df: DataFrame, min_rows: int = 3) -> DataFrame:
    """Session capacity as the slope of cumulative charge on state of charge, for full swing."""
    run = Window.partitionBy("vin", "sid").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    fit = df.withColumn("q", F.sum("dq").over(run)).groupBy("vin", "sid").agg(F.count("*").alias("n"), F.abs(F.regr_slope("q", "soc") * 100).alias("cap"))
    return fit.where((F.col("n") >= min_rows) & F.col("cap").isNotNull())


def charge_events(df: DataFrame, min_amps: float = 2.0, gap_s: float = 600.0) -> DataFrame:
    """Samples inside charge events, with ev and de: contiguous samples with current above ``min_amps`` of one sign and small gaps.

    Islands are cut over all samples and only then the idle ones dropped, so an idle sample parts two events.
    """
    df = with_step(df)
    kind = F.when(F.col("amps") > min_amps, 1).when(F.col("amps") < -min_amps, -1).otherwise(0)
    df = df.withColumn("kind", kind)
    start = F.col("dt").isNull() | (F.col("dt") > gap_s) | (F.col("kind") != F.lag("kind").over(by_time()))
    df = df.withColumn("start", start).withColumn("before", F.lag("amps").over(by_time())).withColumn("ev", F.sum(F.col("start").cast("long")).over(_so_far())).where("kind <> 0")
    step = (F.abs("amps") + F.abs("before")) / 2 * F.col("dt") / 3600
    return df.withColumn("de", F.when(~F.col("start"), step).otherwise(0.0)).drop("start", "before")


def event_rollup(ev: DataFrame, first: int = 5, least: int = 3) -> DataFrame:
    """Each event's times, states of charge, Ah, and median voltage of its first and last readings (null with too few)."""
    up, down = Window.partitionBy("vin", "ev").orderBy("t", "id"), Window.partitionBy("vin", "ev").orderBy(F.desc("t"), F.desc("id"))
    valid = F.col("volts").isNotNull()
    ev = ev.withColumn("up", F.sum(valid.cast("int")).over(up.rowsBetween(Window.unboundedPreceding, 0))).withColumn("down", F.sum(valid.cast("int")).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    order = F.struct("t", "id")
    out = ev.groupBy("vin", "ev").agg(
        F.min("t").alias("t0"),
        F.max("t").alias("t1"),
        F.min_by("soc", order).alias("soc0"),
        F.max_by("soc", order).alias("soc1"),
        F.sum("de").alias("ah"),
        F.count("*").alias("n"),
        F.median(F.when((F.col("up") <= first) & valid, F.col("volts"))).alias("v0"),
        F.median(F.when((F.col("down") <= first) & valid, F.col("volts"))).alias("v1"),
        F.count("volts").alias("readings"),
        F.first("kind").alias("kind"),
    )
    enough = F.col("readings") >= least
    return out.withColumns({"v0": F.when(enough, F.col("v0")), "v1": F.when(enough, F.col("v1"))}).drop("readings")


def full_by_voltage(low: float, high: float) -> Column:
    """An event from at most ``low`` to at least ``high`` volts."""
    return F.coalesce((F.col("v0") <= low) & (F.col("v1") >= high), F.lit(False))


def full_by_soc(span: float = 60.0, end: float = 95.0) -> Column:
    """An event of a wide swing that ends near full."""
    return F.coalesce((F.col("soc1") - F.col("soc0") >= span) & (F.col("soc1") >= end), F.lit(False))


def adaptive_window(events: DataFrame, lows: tuple[float, ...] = (0.1, 0.25, 0.4), highs: tuple[float, ...] = (0.6, 0.75, 0.9), least: int = 4) -> DataFrame:
    """Per vehicle the voltage window, of quantile pairs of start and end voltages, of greatest width times root of events in it."""
    edges = events.groupBy("vin").agg(F.percentile("v0", F.array(*map(F.lit, highs))).alias("a"), F.percentile("v1", F.array(*map(F.lit, lows))).alias("b"))
    pairs = edges.select("vin", F.explode("a").alias("va"), "b").select("vin", "va", F.explode("b").alias("vb")).where("vb > va")
    scored = pairs.join(events.select("vin", "v0", "v1"), "vin").groupBy("vin", "va", "vb").agg(F.count_if((F.col("v0") <= F.col("va")) & (F.col("v1") >= F.col("vb"))).alias("n"))
    scored = scored.where(F.col("n") >= least).withColumn("score", (F.col("vb") - F.col("va")) * F.sqrt("n"))
    best = Window.partitionBy("vin").orderBy(F.desc("score"), "va", "vb")
    return scored.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def resistance_steps(df: DataFrame, least_di: float = 30.0, most_dt: float = 2.0) -> DataFrame:
    """vin, t, soc, r: milliohms of steps with a large change of current in a short time."""
    df = with_step(df).withColumns({"di": F.col("amps") - F.lag("amps").over(by_time()), "dv": F.col("volts") - F.lag("volts").over(by_time())})
    steps = df.where((F.abs("di") >= least_di) & (F.col("dt") > 0) & (F.col("dt") <= most_dt))
    return steps.select("vin", "t", "soc", "di", F.abs(F.col("dv") / F.col("di") * 1000).alias("r"))


def sample_per_vehicle(df: DataFrame, cap: int = 2000) -> DataFrame:
    """A fixed sample of at most ``cap`` rows per vehicle, in order of a hash of the id: a sampling operator."""
    order = Window.partitionBy("vin").orderBy(F.md5(F.col("id").cast("string")), "id")
    return df.withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= cap).drop("pick")


def drive_segments(df: DataFrame, km: tuple[float, float] = (0.0, 60.0), drop: tuple[float, float] = (0.0, 100.0), most_s: float = 3600.0, digits: int | None = None) -> DataFrame:
    """Steps with the odometer up and the state of charge down, of bounded size and time: vin, t, dkm, dsoc.

    With ``digits`` steps meet their bounds rounded, so that a running sum's rounding decides no step just at a bound.
    """
    df = with_step(df).withColumns({"dkm": F.col("odo") - F.lag("odo").over(by_time()), "dsoc": F.lag("soc").over(by_time()) - F.col("soc")})
    dkm, dsoc = (F.col(c) if digits is None else F.round(c, digits) for c in ("dkm", "dsoc"))
    good = (dkm > km[0]) & (dkm <= km[1]) & (dsoc > drop[0]) & (dsoc <= drop[1]) & (F.col("dt") > 0) & (F.col("dt") <= most_s)
    return df.where(good).select("vin", "t", "dkm", "dsoc")


def crossing_rates(df: DataFrame, low: float = 30.0, high: float = 70.0, slack: float = 3.0) -> DataFrame:
    """Charge rate in % per hour between an upward crossing of ``low`` and the next of ``high``, with no fall over ``slack`` between.

    Several low crossings may end in one high crossing; each counts.
    """
    before = F.lag("soc").over(by_time())
    df = df.withColumns({"up_low": (before < low) & (F.col("soc") >= low), "up_high": (before < high) & (F.col("soc") >= high), "fall": before - F.col("soc") > slack})
    ahead = by_time().rowsBetween(0, Window.unboundedFollowing)
    later = by_time().rowsBetween(1, Window.unboundedFollowing)
    df = df.withColumns({"t_high": F.first(F.when(F.col("up_high"), F.col("t")), ignorenulls=True).over(ahead), "t_fall": F.first(F.when(F.col("fall"), F.col("t")), ignorenulls=True).over(later)})
    hours = (seconds(F.col("t_high")) - seconds(F.col("t"))) / 3600
    good = F.col("up_low") & F.col("t_high").isNotNull() & (F.col("t_fall").isNull() | (F.col("t_fall") > F.col("t_high"))) & (hours > 0)
    return df.where(good).select("vin", F.col("t"), F.col("t_high"), ((high - low) / hours).alias("rate"))


def falling_rates(df: DataFrame, high: float = 90.0, low: float = 20.0, slack: float = 3.0) -> DataFrame:
    """Kilometres per % between a downward crossing of ``high`` and the next of ``low``, with no rise over ``slack`` between."""
    before = F.lag("soc").over(by_time())
    df = df.withColumns({"down_high": (before > high) & (F.col("soc") <= high), "down_low": (before > low) & (F.col("soc") <= low), "rise": F.col("soc") - before > slack})
    ahead, later = by_time().rowsBetween(0, Window.unboundedFollowing), by_time().rowsBetween(1, Window.unboundedFollowing)
    end = F.struct("t", "odo")
    df = df.withColumns({"end": F.first(F.when(F.col("down_low"), end), ignorenulls=True).over(ahead), "t_rise": F.first(F.when(F.col("rise"), F.col("t")), ignorenulls=True).over(later)})
    good = F.col("down_high") & F.col("end").isNotNull() & (F.col("t_rise").isNull() | (F.col("t_rise") > F.col("end.t")))
    return df.where(good).select("vin", "t", F.col("end.t").alias("t_low"), ((F.col("end.odo") - F.col("odo")) / (high - low)).alias("km_per_pct"))


def consistent(df: DataFrame, rate: str = "rate", low: float = 0.75, high: float = 1.33) -> DataFrame:
    """Rows whose rate is near the vehicle's median: the same charger."""
    return df.withColumn("rel", F.col(rate) / F.median(rate).over(Window.partitionBy("vin"))).where(F.col("rel").between(low, high)).drop("rel")


def resample_last(df: DataFrame, every: str, columns: list[str], complete: bool = True) -> DataFrame:
    """Last value of each column in each time bucket; buckets that lack one go if ``complete``."""
    order = F.struct("t", "id")
    out = df.groupBy("vin", F.window("t", every)["start"].alias("bucket")).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])
    return out.na.drop(subset=columns) if complete else out


def resample_trace(df: DataFrame, every: str = "5 minutes") -> DataFrame:
    """Last state of charge, mean voltage and current of each bucket."""
    out = df.groupBy("vin", F.window("t", every)["start"].alias("bucket"))
    return out.agg(F.max_by("soc", F.when(F.col("soc").isNotNull(), F.struct("t", "id"))).alias("soc"), F.avg("volts").alias("volts"), F.avg("amps").alias("amps"))


def daily_median(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy("vin", F.date_trunc("day", "t").alias("day")).agg(F.median(column).alias(column), F.max("odo").alias("odo"))


def direction(df: DataFrame) -> DataFrame:
    """Samples with way: charging or discharging by the sign of the change of state of charge; others go."""
    df = df.withColumn("step", F.col("soc") - F.lag("soc").over(by_time()))
    return df.withColumn("way", F.when(F.col("step") > 0, "charging").when(F.col("step") < 0, "discharging")).where("way is not null").drop("step")


def charge_curves(ev: DataFrame, most: int = 8000) -> DataFrame:
    """Cumulative Ah at each sample of each event, cycles numbered, thinned to about ``most`` samples a vehicle by a fixed stride."""
    run = Window.partitionBy("vin", "ev").orderBy("t", "id")
    out = ev.withColumn("ah", F.sum("de").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumns({"cycle": F.dense_rank().over(Window.partitionBy("vin").orderBy("ev")), "rn": F.row_number().over(by_time()), "rows": F.count("*").over(Window.partitionBy("vin"))})
    return out.where((F.col("rn") - 1) % F.ceil(F.col("rows") / most) == 0).select("vin", "cycle", "t", "volts", "ah")


def day_profile(df: DataFrame) -> DataFrame:
    """Rows, swing of the state of charge, distance and median step of each vehicle-day."""
    days = with_step(df).groupBy("vin", F.date_trunc("day", "t").alias("day"))
    return days.agg(F.count("*").alias("n"), (F.max("soc") - F.min("soc")).alias("swing"), (F.max("odo") - F.min("odo")).alias("km"), F.median("dt").alias("cadence_s"))
