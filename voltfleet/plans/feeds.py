"""Queries of sources, sinks and grouped maps: what is written to the shared folder is read again by the feed's reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, grouped
from ..operators import incremental as inc
from ..operators import soh as so
from ..sources import fixtures as fx
from ..sources import scans
from ..sources.shared import shared_folder
from .base import REGISTRATION, SERIES, TELEMETRY, Book

book = Book()
add = book.add


def folder(s: SparkSession) -> str:
    return f"{shared_folder(s)}/feed-{uuid.uuid4().hex}"


def laid_out(df: DataFrame) -> DataFrame:
    """Samples with the feed's partition columns."""
    return df.withColumns({"year": F.year("t"), "month": F.month("t"), "day": F.dayofmonth("t")})


def write_feed(df: DataFrame, root: str) -> None:
    df.write.mode("append").partitionBy("year", "month", "day").parquet(root)


def drifting(s: SparkSession, d: str) -> str:
    """A feed of two generations of files: the first lacks volts, the second lacks temp."""
    root, tel = folder(s), laid_out(fx.telemetry(s, d)).select("vin", "t", "id", "soc", "volts", "temp", "year", "month", "day")
    write_feed(tel.where("id % 2 = 0").drop("volts"), root)
    write_feed(tel.where("id % 2 = 1").drop("temp"), root)
    return root


def junk_years(s: SparkSession, d: str) -> DataFrame:
    root = folder(s)
    write_feed(laid_out(fx.telemetry(s, d)).withColumn("year", F.when(F.col("id") % 10 == 0, 0).otherwise(F.col("year"))).select("id", "t", "year", "month", "day"), root)
    return scans.feed(s, root).select("id")


def small_files(s: SparkSession, d: str) -> DataFrame:
    """Very many small files are read in a few tasks, as Spark packs files into partitions."""
    root = folder(s)
    fx.telemetry(s, d).select("vin", "id", "soc").repartition(200, "id").write.parquet(root)
    return scans.feed(s, root, ["vin", "soc"]).groupBy("vin").agg(F.count("*").alias("n"), F.avg("soc").alias("soc"))


def compacted(s: SparkSession, d: str) -> DataFrame:
    root = folder(s)
    scans.compact(fx.telemetry(s, d).select("vin", "t", "id"), root)
    out = scans.feed(s, root).withColumn("file", F.input_file_name())
    return out.groupBy("year", "month").agg(F.count("*").alias("n"), F.count_distinct("vin").alias("vehicles"), (F.count_distinct("file") <= 8).cast("int").alias("few_files"))


def two_views(s: SparkSession, d: str) -> DataFrame:
    root = folder(s)
    scans.write_store(fx.series(s, d).select("vin", "month", "soh_raw"), root)
    by_month, by_ymd = (s.read.parquet(f"{root}/{view}") for view in ("by_month", "by_ymd"))
    return by_month.select("vin", F.date_format("month", "yyyy-MM-dd").alias("ymd"), F.col("soh_raw").alias("a")).join(by_ymd.select("vin", "ymd", F.col("soh_raw").alias("b")), ["vin", "ymd"], "full")


def vehicle_files(s: SparkSession, d: str) -> DataFrame:
    root = folder(s)
    scans.write_by_vehicle(fx.series(s, d).select("vin", "month", "soh_raw"), root)
    return s.read.parquet(root).groupBy("vin").agg(F.count("*").alias("n"), F.sum("soh_raw").alias("total"))


def reports(s: SparkSession, d: str) -> DataFrame:
    """A report of sources, written as JSON and as CSV."""
    root = folder(s)
    report = fx.registration(s, d).groupBy("oem").agg(F.count("*").alias("n"))
    scans.write_report(report, f"{root}/json")
    scans.write_report(report, f"{root}/csv", "csv")
    return s.read.schema("oem string, n long").json(f"{root}/json").join(s.read.schema("oem string, m long").option("header", True).csv(f"{root}/csv"), "oem")


def watermark(s: SparkSession, d: str) -> DataFrame:
    """First run, an advance, a rerun of an older day: the watermark after each."""
    root = folder(s)
    last = fx.table(s, d, "events").agg(F.to_date(F.max("ts")).alias("d"), F.to_date(F.min("ts")).alias("e")).first()
    seen = [inc.read_watermark(s, root)]
    for day in (last["d"], last["e"]):
        inc.write_watermark(s, root, str(day))
        seen.append(inc.read_watermark(s, root))
    return s.createDataFrame(list(enumerate(seen)), "step int, day string")


add("a05_drifting_schemas", lambda s, d: scans.feed(s, drifting(s, d), merge=True).select("id", "volts", "temp"), TELEMETRY, select="SELECT id, CASE WHEN id % 2 = 1 THEN volts END AS volts, CASE WHEN id % 2 = 0 THEN temp END AS temp FROM tel", columns="id:i volts:d temp:d")
add("a06_one_vin_one_year", lambda s, d: scans.feed(s, drifting(s, d), merge=True).where("vin = 17 and year = 2024").select("id", "volts"), TELEMETRY, select="SELECT id, CASE WHEN id % 2 = 1 THEN volts END AS volts FROM tel WHERE vin = 17 AND year(t) = 2024", columns="id:i volts:d")
add("a09_junk_years", junk_years, TELEMETRY, select="SELECT id FROM tel WHERE id % 10 <> 0", columns="id:i")
add("a11_small_files", small_files, TELEMETRY, select="SELECT vin, count(*) AS n, avg(soc) AS soc FROM tel GROUP BY vin", columns="vin:i n:i soc:d")
add("a12_compacted_months", compacted, TELEMETRY, select="SELECT year(t) AS year, month(t) AS month, count(*) AS n, count(DISTINCT vin) AS vehicles, 1 AS few_files FROM tel GROUP BY 1, 2", columns="year:i month:i n:i vehicles:i few_files:i")
add("a14_first_present", lambda s, d: (lambda t: t.select("id", clean.first_present(t, ["temp_c", "batt_temp", "temp"]).alias("temperature")))(fx.telemetry(s, d).withColumn("batt_temp", F.when(F.col("id") % 3 == 0, F.col("temp") + 1))), TELEMETRY, select="SELECT id, CASE WHEN id % 3 = 0 THEN temp + 1 ELSE temp END AS temperature FROM tel", columns="id:i temperature:d")
add("a16_two_views", two_views, SERIES, select="SELECT vin, strftime(month, '%Y-%m-%d') AS ymd, soh_raw AS a, soh_raw AS b FROM ser", columns="vin:i ymd:s a:d b:d")
add("a17_vehicle_files", vehicle_files, SERIES, select="SELECT vin, count(*) AS n, sum(soh_raw) AS total FROM ser GROUP BY vin", columns="vin:i n:i total:e")
add("a19_reports", reports, REGISTRATION, select="SELECT oem, count(*) AS n, count(*) AS m FROM reg GROUP BY oem", columns="oem:s n:i m:i")
add("s06_watermark", watermark, select="SELECT step, CASE WHEN step > 0 THEN (SELECT max(ts)::DATE::VARCHAR FROM events) END AS day FROM generate_series(0, 2) AS g(step)", columns="step:i day:s")
add("h01_global_sort", lambda s, d: fx.telemetry(s, d).orderBy("vin", "t", "id").select("vin", "t", "id"), TELEMETRY, select="SELECT vin, t, id FROM tel", columns="vin:i t:t id:i")
add(
    "b12_contract_columns",
    lambda s, d: so.assemble(
        fx.series(s, d).select("vin", "month", F.col("cap_raw").alias("capacity_ah"), "age_months", "soh_raw", F.col("soh_raw").alias("soh")),
        fx.series(s, d).where("n > 3").select("vin", "month", "ah_throughput", "dod_mean", (F.col("age_months") * 100 + F.col("n")).alias("odo_max")),
    ),
    SERIES,
    "fe AS (SELECT s.vin, s.month, s.cap_raw, s.age_months, s.soh_raw, coalesce(f.ah_throughput, 0) AS ah, f.dod_mean, f.odo FROM ser s LEFT JOIN (SELECT vin, month, ah_throughput, dod_mean, age_months * 100 + n AS odo FROM ser WHERE n > 3) f USING (vin, month))",
    "fk AS (SELECT *, coalesce(greatest(odo - lag(odo) OVER (PARTITION BY vin ORDER BY month), 0), 0) AS km FROM fe)",
    select="""SELECT vin::VARCHAR AS vin, strftime(month, '%Y-%m-%d') AS ymd, cap_raw AS capacity_ah, NULL AS n_sessions, NULL AS temp_max, NULL AS dte_mean, soh_raw AS soh, ah AS ah_throughput, dod_mean, odo AS odo_max, km AS km_month,
      sum(ah) OVER w AS cum_ah, sum(km) OVER w AS cum_km, 1 / sqrt(greatest(age_months, 0) + 1) AS inv_sqrt_age, 100 - soh_raw AS soh_deficit FROM fk WINDOW w AS (PARTITION BY vin ORDER BY month)""",
    columns="vin:s ymd:s capacity_ah:d n_sessions:i temp_max:d dte_mean:d soh:d ah_throughput:d dod_mean:d odo_max:d km_month:d cum_ah:d cum_km:d inv_sqrt_age:d soh_deficit:d",
)

add("t01_t06_per_vehicle", lambda s, d: fx.series(s, d).where("n > 2").groupBy("vin").agg(grouped.net_change("soh_raw", "month").alias("fallen"), grouped.variation("soh_raw").alias("spread")), SERIES, select="SELECT vin, arg_min(soh_raw, month) - arg_max(soh_raw, month) AS fallen, stddev_samp(soh_raw) / avg(soh_raw) * 100 AS spread FROM ser WHERE n > 2 GROUP BY vin", columns="vin:i fallen:d spread:d")
add("t02_per_vehicle_month", lambda s, d: fx.telemetry(s, d).groupBy("vin", F.date_trunc("month", "t").alias("month")).agg((F.max("soc") - F.min("soc")).alias("swing"), F.count("*").alias("n")), TELEMETRY, select="SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, max(soc) - min(soc) AS swing, count(*) AS n FROM tel GROUP BY 1, 2", columns="vin:i month:t swing:d n:i")
add("t04_lookup_in_function", lambda s, d: grouped.looked_up(fx.registration(s, d), "oem", s.createDataFrame([("ASIA", 133.0), ("EUROPE", 100.0)], "oem string, nominal double"), "nominal", 120.0).select("vin", "nominal"), REGISTRATION, select="SELECT vin, CASE oem WHEN 'ASIA' THEN 133.0 WHEN 'EUROPE' THEN 100.0 ELSE 120.0 END AS nominal FROM reg", columns="vin:i nominal:d")
add(
    "t05_builders_by_source",
    lambda s, d: grouped.by_source(
        fx.series(s, d).join(fx.registration(s, d).select("vin", "oem"), "vin"), "oem",
        {"ASIA": lambda x: x.groupBy("oem", "vin").agg(F.max("cap_raw").alias("top")), "EUROPE": lambda x: x.groupBy("oem", "vin").agg(F.min("soh_raw").alias("low"))},
        lambda x: x.groupBy("oem", "vin").agg(F.count("*").alias("n")),
    ),
    SERIES, REGISTRATION,
    select="SELECT oem, vin, CASE WHEN oem = 'ASIA' THEN max(cap_raw) END AS top, CASE WHEN oem = 'EUROPE' THEN min(soh_raw) END AS low, CASE WHEN oem NOT IN ('ASIA', 'EUROPE') THEN count(*) END AS n FROM ser JOIN reg USING (vin) GROUP BY oem, vin",
    columns="oem:s vin:i top:d low:d n:i",
)
add("t07_expanded_months", lambda s, d: grouped.expanded_months(fx.registration(s, d).where("regd_date is not null"), 24).select("vin", "h", F.add_months("regd_date", F.col("h")).cast("timestamp").alias("month")), REGISTRATION, select="SELECT vin, h, (regd_date + to_months(h::INT))::TIMESTAMP AS month FROM reg, generate_series(1, 24) AS g(h) WHERE regd_date IS NOT NULL", columns="vin:i h:i month:t")
