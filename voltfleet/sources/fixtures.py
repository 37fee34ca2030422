"""Projections of the star-schema tables to the shapes of battery telemetry.

``telemetry``: one row per sample (vin, t, id, soc, amps, volts, odo, temp, rem_cap, mode), with out-of-range values on purpose.
``series``: one row per vehicle-month. ``registration``, ``specs``, ``resales``: dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    so_far = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("vin"),
        F.col("ts").cast("timestamp").alias("t"),
        F.col("event_id").alias("id"),
        (k * 1.2).alias("soc"),
        (50 - F.col("value")).alias("amps"),
        (48 + k / 10).alias("volts"),
        F.sum("value").over(so_far).alias("odo"),
        (20 + F.col("value") / 20).alias("temp"),
        (1.3 * k + F.col("value") / 50).alias("rem_cap"),
        F.col("event_type").alias("mode"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vin, month, n, age_months, cap_raw, soh_raw and usage columns of each supplier-month."""
    items = table(spark, sf_dir, "lineitem").withColumn("month", F.date_trunc("month", "l_shipdate"))
    share = lambda flag: F.avg((F.col("l_returnflag") == flag).cast("double"))
    rows = items.groupBy(F.col("l_suppkey").alias("vin"), "month").agg(
        F.count("*").alias("n"),
        F.avg("l_quantity").alias("q"),
        (F.sum("l_quantity") * 10).alias("km_month"),
        (F.sum("l_extendedprice") / 1000).alias("ah_throughput"),
        (25 + 100 * F.max("l_discount")).alias("temp_max"),
        share("A").alias("frac_soc_high"),
        share("R").alias("frac_soc_low"),
        (F.avg("l_tax") * 1000).alias("dod_mean"),
    )
    own = Window.partitionBy("vin")
    rows = rows.withColumn("age_months", F.datediff("month", F.min("month").over(own)) / 30.4)
    rows = rows.withColumn("cap_raw", 130 * (1 - 0.004 * F.col("age_months")) + (F.col("q") - 25.5) * 0.8)
    base = F.median(F.when(F.col("age_months") < 3, F.col("cap_raw"))).over(own)
    return rows.withColumn("soh_raw", F.least(F.lit(100.0), 100 * F.col("cap_raw") / base)).drop("q")


def registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vin, regd_date (null for every fifth vehicle), oem (the supplier's region)."""
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("vin")).agg(F.date_trunc("month", F.min("l_shipdate")).alias("first_month"))
    homes = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    homes = homes.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("vin"), F.col("r_name").alias("oem"))
    regd = F.when(F.col("vin") % 5 != 0, F.add_months("first_month", -(F.col("vin") % 7).cast("int")))
    return first.join(homes, "vin").select("vin", regd.alias("regd_date"), "oem")


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, variant, size and price of the parts, as a spec sheet."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("spec_id"), F.col("p_brand").alias("model"), F.col("p_type").alias("variant"), F.col("p_size").alias("size"))


def resales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vin, resale_date: each vehicle's orders' dates as resale candidates."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_suppkey").alias("vin")).agg(F.max("o_orderdate").alias("resale_date"))
