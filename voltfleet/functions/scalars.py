"""Scalar expressions of the fleet views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_date(text: Column, *formats: str) -> Column:
    """First format that fits; null if none does. Years of two digits from 69 on are of the last century."""
    out = []
    for f in formats:
        t = F.try_to_timestamp(text, F.lit(f))
        out.append(t if "yyyy" in f else F.when(F.year(t) > 2068, t - F.expr("interval 100 years")).otherwise(t))
    return F.coalesce(*out)


def day_of_path(path: Column) -> Column:
    return F.regexp_extract(path, r"day=(\d{2})", 1).try_cast("int")


def estimated_range(soh: Column, kwh: Column, wh_per_km: Column, rated_km: Column) -> Column:
    """Battery energy left over measured consumption, else rated distance times health."""
    measured = F.when(wh_per_km > 0, kwh * 1000 * soh / 100 / wh_per_km)
    return F.coalesce(measured, rated_km * soh / 100)


def health_status(soh: Column, eol: float = 80.0) -> Column:
    margin = soh - eol
    return F.when(margin >= 15, "excellent").when(margin >= 8, "good").when(margin >= 3, "fair").when(margin >= 0, "watch").otherwise("below")


def care_grade(score: Column) -> Column:
    return F.when(score >= 72, "Gentle").when(score >= 50, "Moderate").when(score >= 35, "Firm").otherwise("Hard")


def style_word(gentler: Column) -> Column:
    """From the share of vehicles that are treated harsher."""
    return F.when(gentler >= 66, "Gentle").when(gentler >= 33, "Typical").otherwise("Firm")


def age_text(months: Column) -> Column:
    """Like ``2 yr 3 mo``."""
    whole = F.bround(months).cast("int")
    return F.format_string("%d yr %d mo", F.floor(whole / 12).cast("int"), whole % 12)


def soc_density(df: DataFrame) -> DataFrame:
    """vin, soc (0 to 100), density: three bells from mean state of charge and dwell shares, highest point 1."""
    bell = lambda x, mu, sd: F.exp(-0.5 * F.pow((x - mu) / sd, 2.0))
    rows = df.select("vin", "soc_mean", "frac_soc_high", "frac_soc_low", F.explode(F.sequence(F.lit(0), F.lit(100))).alias("soc"))
    rest = F.greatest(1 - F.col("frac_soc_high") - F.col("frac_soc_low"), F.lit(0.0))
    raw = rest * bell(F.col("soc"), F.col("soc_mean"), 18.0) + F.col("frac_soc_high") * bell(F.col("soc"), 95.0, 5.0) + F.col("frac_soc_low") * bell(F.col("soc"), 12.0, 7.0)
    return rows.withColumn("raw", raw).select("vin", "soc", (F.col("raw") / F.max("raw").over(Window.partitionBy("vin"))).alias("density"))


def second_life(df: DataFrame, a: Column, b: Column, c: Column, cycles: int = 9000, step: int = 100) -> DataFrame:
    """key, cycle, soh of a cubic from 100, for every step; ``end`` is the first cycle at 20 or less."""
    rows = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(cycles), F.lit(step))).alias("cycle"))
    rows = rows.withColumn("soh", F.greatest(100 - a * F.col("cycle") - b * F.pow("cycle", F.lit(2.0)) - c * F.pow("cycle", F.lit(3.0)), F.lit(0.0)))
    return rows


def equivalent_cycles(ah: Column, nominal: Column) -> Column:
    return F.try_divide(ah, 2 * nominal)
