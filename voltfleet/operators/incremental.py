"""Daily incremental build: catch-up plan, upsert, touched months, rebuild of touched vehicles, watermark and checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def plan_days(spark: SparkSession, day: str, last: str | None, lookback: int = 1, most: int = 14) -> DataFrame:
    """day, advance_to, clamped: days to process up to ``day``, oldest first.

    A day up to the watermark is reprocessed alone and does not advance it. Else the run starts after the watermark, or a
    look-back before ``day`` if that is earlier or there is no watermark yet, but at most ``most`` days back.
    """
    to = F.to_date(F.lit(day))
    if last is not None and day <= last:
        return spark.range(1).select(to.alias("day"), F.lit(None).cast("date").alias("advance_to"), F.lit(False).alias("clamped"))
    back, floor = F.date_sub(to, lookback - 1), F.date_sub(to, most - 1)
    start = back if last is None else F.least(F.date_add(F.to_date(F.lit(last)), 1), back)
    return spark.range(1).select(F.explode(F.sequence(F.greatest(start, floor), to)).alias("day"), to.alias("advance_to"), (start < floor).alias("clamped"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Old and new rows with one row for each key: the one of greatest ``order``, new before old if equal. New rows are
    de-duplicated by the same rule, so feeds with many rows on one millisecond are safe."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, "_new")]
    best = F.max_by(F.struct(*rest), F.struct(F.col(order), F.col("_new"), F.xxhash64(*rest)))
    return both.groupBy(*keys).agg(best.alias("row")).select(*keys, "row.*")


def touched(new: DataFrame, t: str = "t") -> DataFrame:
    """vin, month of the months that new rows touch."""
    return new.select("vin", F.date_trunc("month", t).alias("month")).distinct()


def rebuild_months(store: DataFrame, samples: DataFrame, marks: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The monthly store with touched months computed anew from all of their samples; other months as they are."""
    need = samples.withColumn("month", F.date_trunc("month", "t")).join(marks, ["vin", "month"], "left_semi").drop("month")
    return store.join(marks, ["vin", "month"], "left_anti").unionByName(build(need), allowMissingColumns=True)


def rebuild_vehicles(features: DataFrame, store: DataFrame, marks: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Feature rows with touched vehicles rebuilt over all their months, since cumulative columns reach forward."""
    vins = marks.select("vin").distinct()
    return features.join(vins, "vin", "left_anti").unionByName(build(store.join(vins, "vin", "left_semi")), allowMissingColumns=True)


def month_samples(df: DataFrame, value: Column, name: str) -> DataFrame:
    """vin, month and the month's values as one array: what a later fit over all months needs, without the samples."""
    return df.groupBy("vin", F.date_trunc("month", "t").alias("month")).agg(F.array_sort(F.collect_list(value)).alias(name), F.count("*").alias("n_rows"))


def spread_samples(store: DataFrame, name: str, value: str) -> DataFrame:
    return store.select("vin", "month", F.explode(name).alias(value))


def read_watermark(spark: SparkSession, path: str) -> str | None:
    """The last processed day; None before the first run."""
    try:
        rows = spark.read.parquet(path).agg(F.max("last_processed_date").alias("d")).collect()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return str(rows[0]["d"]) if rows and rows[0]["d"] else None


def write_watermark(spark: SparkSession, path: str, day: str) -> None:
    """Append the day; the greatest holds, so a rerun never moves it back."""
    spark.range(1).select(F.to_date(F.lit(day)).alias("last_processed_date")).write.mode("append").parquet(path)


def safety_net(marks: DataFrame, built: DataFrame) -> DataFrame:
    """One row: vehicles touched and built, and a state; evaluation fails if vehicles were touched and none was built."""
    a = marks.agg(F.count_distinct("vin").alias("touched"))
    b = built.agg(F.count_distinct("vin").alias("built"))
    state = F.when((F.col("touched") > 0) & (F.col("built") == 0), F.raise_error(F.lit("touched vehicles but built none"))).when(F.col("built") < F.col("touched"), "shortfall").otherwise("ok")
    return a.crossJoin(b).withColumn("state", state)


def equivalence(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """column, max_diff, only_one (rows where one side alone has a value or a row), same: null equals null."""
    pairs = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(1).alias("in_a")).join(b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(1).alias("in_b")), keys, "full")
    one = lambda c: (F.col(f"a_{c}").isNull() != F.col(f"b_{c}").isNull()) | F.col("in_a").isNull() | F.col("in_b").isNull()
    wide = pairs.agg(*[F.max(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}"))).cast("double").alias(f"d_{c}") for c in columns], *[F.count_if(one(c)).alias(f"o_{c}") for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(f"d_{c}", F.lit(0.0)).alias("max_diff"), F.col(f"o_{c}").alias("only_one")) for c in columns])).alias("x")
    return wide.select(rows).select("x.*").withColumn("same", (F.col("max_diff") <= tolerance) & (F.col("only_one") == 0))


def rejects(df: DataFrame, checks: dict[str, Column], stage: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): rejects name vin, stage and the first check that fails; a bad vehicle never stops the rest."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    marked = df.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null").select("vin", F.lit(stage).alias("stage"), "reason")


