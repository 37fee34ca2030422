"""Projections, filters and cleaning of raw samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Physical bounds of each channel; what lies outside is a sentinel or a fault.
BOUNDS = {"soc": (0.0, 100.0), "amps": (-400.0, 400.0), "volts": (20.0, 120.0), "temp": (-30.0, 90.0)}


def from_epoch_ms(column: Column) -> Column:
    """Timestamp of epoch milliseconds; null if it is no number."""
    return F.timestamp_millis(column.try_cast("bigint"))


def null_outside(df: DataFrame, bounds: dict[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    """Out-of-range values become null, the row stays."""
    return df.withColumns({c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in bounds.items() if c in df.columns})


def keep_inside(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows with a channel out of range, or null, go."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()]))


def clip(column: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bounded value; null stays null."""
    out = column if low is None else F.when(column < low, F.lit(low)).otherwise(column)
    return out if high is None else F.when(out > high, F.lit(high)).otherwise(out)


def rename_variants(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename those columns of a variant map that exist."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def select_known(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the contract's columns, cast to its types; missing ones are null."""
    have = set(df.columns)
    return df.select([(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def first_present(df: DataFrame, names: list[str]) -> Column:
    """The first non-null of those alternatives that exist."""
    have = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None)


def valid_vin(df: DataFrame, prefix: str | None = None) -> DataFrame:
    """Rows whose vin is neither null nor blank, and starts with the prefix if one is given."""
    vin = F.col("vin").cast("string")
    good = vin.isNotNull() & (F.trim(vin) != "")
    return df.where(good & vin.startswith(prefix) if prefix else good)


def month_key(t: Column) -> Column:
    return F.date_trunc("month", t)


def metres_to_km(metres: Column, most: float = 1e6) -> Column:
    """Kilometres; null unless between 0 and ``most``, both excluded."""
    km = metres / 1000
    return F.when((km > 0) & (km < most), km)


def ceiling(column: Column, low: float, high: float) -> Column:
    """Null outside low..high."""
    return F.when(column.between(low, high), column)


def garbage_rates(df: DataFrame, bounds: dict[str, tuple[float, float]] = BOUNDS, by: tuple[str, ...] = ()) -> DataFrame:
    """channel, n (not null), bad, rate: share of non-null values out of bounds, in one pass."""
    aggs = []
    for c, (lo, hi) in bounds.items():
        aggs += [F.count(c).alias(f"n_{c}"), F.count_if(~F.col(c).between(lo, hi)).alias(f"bad_{c}")]
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"n_{c}").alias("n"), F.col(f"bad_{c}").alias("bad")) for c in bounds]))
    return wide.select(*by, rows.alias("x")).select(*by, "x.channel", "x.n", "x.bad").withColumn("rate", F.try_divide("bad", "n"))


def fill_rates(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """signal, fill: share of rows that have each signal."""
    wide = df.groupBy(*by).agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return wide.unpivot(list(by), columns, "signal", "fill")


def winsorise(df: DataFrame, column: str, by: str = "vin", low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Values beyond a group's quantiles are set to them."""
    own = Window.partitionBy(by)
    lo, hi = F.percentile(column, low).over(own), F.percentile(column, high).over(own)
    return df.withColumn(column, F.greatest(F.least(F.col(column), hi), lo))


def charging_sign(df: DataFrame) -> DataFrame:
    """Sign of the current while charging: that of the median current of samples where the state of charge rises."""
    w = Window.partitionBy("vin").orderBy("t", "id")
    rising = df.withColumn("rise", F.col("soc") - F.lag("soc").over(w))
    return df.join(rising.where("rise > 0").groupBy("vin").agg(F.signum(F.median("amps")).alias("charge_sign")), "vin", "left")


def drop_glitch_months(df: DataFrame, value: str = "soh_raw", drop: float = 10.0) -> DataFrame:
    """Months over ``drop`` points below the last month that was kept go; the first month stays."""
    rows = df.groupBy("vin").agg(F.array_sort(F.collect_list(F.struct("month", F.col(value).alias("x")))).alias("s"))
    kept = F.aggregate("s", F.expr("cast(array() as array<struct<month:timestamp,x:double>>)"), lambda done, p: F.when((F.size(done) == 0) | (p["x"] >= F.try_element_at(done, F.lit(-1))["x"] - drop), F.concat(done, F.array(p))).otherwise(done))
    return rows.select("vin", F.explode(kept).alias("p")).select("vin", "p.month", F.col("p.x").alias(value))


def cut_at_replacement(df: DataFrame, soh: str = "soh", odo: str = "odo", soh_jump: float = 4.0, odo_jump: float = 4000.0) -> DataFrame:
    """Rows before the first one where both health and odometer jump: a new battery starts there."""
    w = Window.partitionBy("vin").orderBy("month")
    jump = (F.col(soh) - F.lag(soh).over(w) > soh_jump) & (F.col(odo) - F.lag(odo).over(w) > odo_jump)
    seen = F.max(F.coalesce(jump, F.lit(False)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("replaced", seen).where("replaced = 0").drop("replaced")
