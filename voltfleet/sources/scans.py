"""Scans and sinks of feeds: partitioned Parquet, day sampling, dimensions, views and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def feed(spark: SparkSession, root: str, columns: list[str] | None = None, days: list[str] | None = None, merge: bool = False, skip_years: tuple[int, ...] = (0,)) -> DataFrame:
    """A feed laid out by year, month and day. Absent days and junk years are pruned as partitions; ``merge`` unites drifting schemas."""
    df = spark.read.option("basePath", root).option("mergeSchema", str(merge).lower()).parquet(root)
    if "year" in df.columns:
        df = df.where(~F.col("year").cast("int").isin(*skip_years))
    if days is not None:
        date = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
        df = df.where(date.isin(*[F.to_date(F.lit(d)) for d in days]))
    if columns is None:
        return df
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])


def on_days(df: DataFrame, t: str, days: list[str]) -> DataFrame:
    """Samples of a list of days; days without samples add nothing."""
    return df.where(F.to_date(t).isin(*[F.to_date(F.lit(d)) for d in days]))


def of_cohort(df: DataFrame, cohort: DataFrame) -> DataFrame:
    """Rows of a cohort's vehicles."""
    return df.join(cohort.select("vin").distinct(), "vin", "left_semi")


def days_near(days: DataFrame, targets: tuple[int, ...] = (8, 16, 24)) -> DataFrame:
    """day: per month the available day nearest each target day of month; of two as near the earlier. ``days``: column day."""
    rows = days.select("day").distinct().withColumn("target", F.explode(F.array(*map(F.lit, targets))))
    order = Window.partitionBy(F.trunc("day", "month"), "target").orderBy(F.abs(F.dayofmonth("day") - F.col("target")), "day")
    return rows.withColumn("r", F.row_number().over(order)).where("r = 1").select("day").distinct()


def every_kth_day(days: DataFrame, k: int) -> DataFrame:
    """day: every k-th available day of each month, from its first."""
    order = Window.partitionBy(F.trunc("day", "month")).orderBy("day")
    return days.select("day").distinct().withColumn("r", F.row_number().over(order)).where((F.col("r") - 1) % k == 0).select("day")


def sampled(df: DataFrame, t: str, days: DataFrame) -> DataFrame:
    return df.join(days.select(F.col("day")), F.to_date(t) == F.col("day"), "left_semi")


def cap_files(files: DataFrame, cap: int) -> DataFrame:
    """file, day: at most ``cap`` files of each day, in order of name: an input-size option of the reader."""
    order = Window.partitionBy("day").orderBy("file")
    return files.withColumn("r", F.row_number().over(order)).where(F.col("r") <= cap).drop("r")


def within_cohort_span(df: DataFrame, t: str, cohort: DataFrame, first: str, last: str) -> DataFrame:
    """Samples between the cohort's first and last sight: two dates that prune partitions."""
    span = cohort.agg(F.min(first).alias("a"), F.max(last).alias("b")).first()
    return df.where(F.col(t).between(F.lit(span["a"]), F.lit(span["b"])))


def csv_dimension(spark: SparkSession, path: str, schema: str, dates: dict[str, str] | None = None) -> DataFrame:
    """A small CSV with a header; date columns are parsed by a format, bad ones are null."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(f)) for c, f in (dates or {}).items()})


def numbers_or_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds <column>_num where the text is a number; the text itself, such as ``unverified``, stays."""
    return df.withColumns({f"{c}_num": F.col(c).try_cast("double") for c in columns})


def larger_store(a: DataFrame, b: DataFrame) -> DataFrame:
    """The store with more distinct vehicles, the first if equal."""
    n, m = (x.agg(F.count_distinct("vin").alias("n")).first()["n"] for x in (a, b))
    return a if n >= m else b


def as_of(store: DataFrame, cutoff: Column) -> DataFrame:
    """Feature rows up to a day, without the duplicate month column."""
    return store.where(F.col("ymd") <= cutoff).drop("month")


def write_store(df: DataFrame, path: str) -> None:
    """The feature store in two views: keyed by month timestamp, and by day text."""
    df.withColumn("part", F.date_format("month", "yyyyMM")).write.mode("overwrite").partitionBy("part").parquet(f"{path}/by_month")
    df.withColumn("ymd", F.date_format("month", "yyyy-MM-dd")).drop("month").write.mode("overwrite").parquet(f"{path}/by_ymd")


def compact(df: DataFrame, path: str, t: str = "t", files_per_month: int = 8) -> None:
    """Many tiny files to a few per month, vehicles kept together so that later scans by vin prune row groups."""
    rows = df.withColumns({"year": F.year(t), "month": F.month(t)})
    spread = F.pmod(F.xxhash64("vin"), F.lit(files_per_month))
    rows.repartition(F.col("year"), F.col("month"), spread).sortWithinPartitions("vin", t).write.mode("overwrite").partitionBy("year", "month").parquet(path)


def write_by_vehicle(df: DataFrame, path: str, few: int = 1000) -> None:
    """A folder per vehicle if they are few, else vehicles bucketed by hash."""
    if df.select("vin").distinct().limit(few + 1).count() <= few:
        df.repartition("vin").write.mode("overwrite").partitionBy("vin").parquet(path)
    else:
        df.withColumn("bucket", F.pmod(F.xxhash64("vin"), F.lit(few))).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """A small report as JSON lines or CSV, written by Spark."""
    writer = df.coalesce(1).write.mode("overwrite")
    writer.json(path) if kind == "json" else writer.option("header", True).csv(path)
