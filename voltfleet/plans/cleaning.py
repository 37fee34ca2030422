"""Queries of the cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean
from ..sources import fixtures as fx
from .base import SERIES, TELEMETRY, Book

book = Book()
add = book.add

add(
    "b01_epoch_ms",
    lambda s, d: fx.table(s, d, "events").select("event_id", clean.from_epoch_ms(F.when(F.col("event_id") % 7 == 0, F.lit("bad")).otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))).alias("t")),
    select="SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('millisecond', ts) END AS t FROM events",
    columns="event_id:i t:t",
)
add(
    "b02_null_outside_bounds",
    lambda s, d: clean.null_outside(fx.telemetry(s, d)).select("id", "soc", "amps", "volts", "temp"),
    TELEMETRY,
    select="SELECT id, CASE WHEN soc BETWEEN 0 AND 100 THEN soc END AS soc, CASE WHEN amps BETWEEN -400 AND 400 THEN amps END AS amps, volts, CASE WHEN temp <= 90 THEN temp END AS temp FROM tel",
    columns="id:i soc:d amps:d volts:d temp:d",
)
add(
    "b03_rows_inside_bounds",
    lambda s, d: clean.keep_inside(fx.telemetry(s, d), {"soc": (0, 100), "amps": (-400, 400)}).select("id", "soc", "amps"),
    TELEMETRY,
    select="SELECT id, soc, amps FROM ok",
    columns="id:i soc:d amps:d",
)
add(
    "b04_clip",
    lambda s, d: fx.telemetry(s, d).select("id", clean.clip(F.col("amps"), -100.0, 20.0).alias("amps"), clean.clip(F.when(F.col("id") % 3 > 0, F.col("soc")), high=90.0).alias("soc")),
    TELEMETRY,
    select="SELECT id, greatest(least(amps, 20.0), -100.0) AS amps, CASE WHEN id % 3 > 0 THEN least(soc, 90.0) END AS soc FROM tel",
    columns="id:i amps:d soc:d",
)
add(
    "b05_b06_variants_to_contract",
    lambda s, d: clean.select_known(
        clean.rename_variants(fx.table(s, d, "events").select(F.col("user_id").alias("VIN"), F.col("event_id").alias("eventid"), "value"), {"VIN": "vin", "eventid": "id", "batterysoc": "soc"}),
        T.StructType([T.StructField("vin", T.StringType()), T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("soc", T.DoubleType())]),
    ),
    select="SELECT user_id::VARCHAR AS vin, event_id AS id, value, NULL::DOUBLE AS soc FROM events",
    columns="vin:s id:i value:d soc:d",
)
add(
    "b07_valid_vin",
    lambda s, d: clean.valid_vin(fx.table(s, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, " ").when(F.col("event_id") % 5 > 1, F.col("user_id").cast("string")).alias("vin")), "1"),
    select="SELECT event_id, user_id::VARCHAR AS vin FROM events WHERE event_id % 5 > 1 AND user_id::VARCHAR LIKE '1%'",
    columns="event_id:i vin:s",
)
add(
    "b08_required_channels",
    lambda s, d: clean.null_outside(fx.telemetry(s, d)).na.drop(subset=["soc", "amps"]).select("id", "vin"),
    TELEMETRY,
    select="SELECT id, vin FROM ok",
    columns="id:i vin:i",
)
add(
    "b09_month_key",
    lambda s, d: fx.table(s, d, "lineitem").select(clean.month_key(F.col("l_shipdate")).alias("month"), (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym")).groupBy("month", "ym").count().withColumnRenamed("count", "n"),
    select="SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS month, year(l_shipdate) * 100 + month(l_shipdate) AS ym, count(*) AS n FROM lineitem GROUP BY 1, 2",
    columns="month:t ym:i n:i",
)
add(
    "b10_b11_odometer_and_ceilings",
    lambda s, d: fx.series(s, d).select("vin", "month", clean.metres_to_km((F.col("km_month") - 500) * 1000, 3000.0).alias("km"), clean.ceiling(F.col("km_month"), 0, 2000).alias("km_month")),
    SERIES,
    select="SELECT vin, month, CASE WHEN km_month - 500 > 0 AND km_month - 500 < 3000 THEN km_month - 500 END AS km, CASE WHEN km_month BETWEEN 0 AND 2000 THEN km_month END AS km_month FROM ser",
    columns="vin:i month:t km:d km_month:d",
)
add(
    "b13_garbage_rates",
    lambda s, d: clean.garbage_rates(fx.telemetry(s, d), by=("vin",)),
    TELEMETRY,
    select="""SELECT vin, channel, count(x) AS n, count(*) FILTER (WHERE x < lo OR x > hi) AS bad, count(*) FILTER (WHERE x < lo OR x > hi) / count(x) AS rate FROM (
      SELECT vin, 'soc' AS channel, soc AS x, 0.0 AS lo, 100.0 AS hi FROM tel UNION ALL SELECT vin, 'amps', amps, -400, 400 FROM tel
      UNION ALL SELECT vin, 'volts', volts, 20, 120 FROM tel UNION ALL SELECT vin, 'temp', temp, -30, 90 FROM tel) GROUP BY 1, 2""",
    columns="vin:i channel:s n:i bad:i rate:d",
)
add(
    "b14_fill_rates",
    lambda s, d: clean.fill_rates(clean.null_outside(fx.telemetry(s, d)), ["soc", "amps", "temp"], ("vin",)),
    TELEMETRY,
    select="""SELECT vin, signal, avg(CAST(x AS DOUBLE)) AS fill FROM (SELECT vin, 'soc' AS signal, soc BETWEEN 0 AND 100 AS x FROM tel UNION ALL SELECT vin, 'amps', abs(amps) <= 400 FROM tel
      UNION ALL SELECT vin, 'temp', temp BETWEEN -30 AND 90 FROM tel) GROUP BY 1, 2""",
    columns="vin:i signal:s fill:d",
)
add(
    "b15_winsorise",
    lambda s, d: clean.winsorise(fx.series(s, d), "cap_raw").select("vin", "month", "cap_raw"),
    SERIES,
    select="SELECT vin, month, greatest(least(cap_raw, quantile_cont(cap_raw, 0.95) OVER (PARTITION BY vin)), quantile_cont(cap_raw, 0.05) OVER (PARTITION BY vin)) AS cap_raw FROM ser",
    columns="vin:i month:t cap_raw:d",
)
add(
    "b16_charging_sign",
    lambda s, d: clean.charging_sign(fx.telemetry(s, d)).select("vin", "charge_sign").distinct(),
    TELEMETRY,
    select="SELECT v.vin, charge_sign FROM (SELECT DISTINCT vin FROM tel) v LEFT JOIN (SELECT vin, sign(median(amps)) AS charge_sign FROM (SELECT *, soc - lag(soc) OVER (PARTITION BY vin ORDER BY t, id) AS rise FROM tel) WHERE rise > 0 GROUP BY vin) c ON c.vin = v.vin",
    columns="vin:i charge_sign:d",
)
add(
    "b17_glitch_months",
    lambda s, d: clean.drop_glitch_months(fx.series(s, d), drop=10.0),
    SERIES,
    "num AS (SELECT vin, month, soh_raw, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM ser)",
    "walk AS (SELECT vin, month, soh_raw, rn, soh_raw AS last, true AS kept FROM num WHERE rn = 1 UNION ALL SELECT n.vin, n.month, n.soh_raw, n.rn, CASE WHEN n.soh_raw >= w.last - 10 THEN n.soh_raw ELSE w.last END, n.soh_raw >= w.last - 10 FROM walk w JOIN num n ON n.vin = w.vin AND n.rn = w.rn + 1)",
    select="SELECT vin, month, soh_raw FROM walk WHERE kept",
    columns="vin:i month:t soh_raw:d",
)
add(
    "b18_replacement_cut",
    lambda s, d: clean.cut_at_replacement(fx.series(s, d).withColumn("odo", F.col("km_month") * 10), soh="soh_raw", soh_jump=15.0, odo_jump=8000.0).select("vin", "month", "soh_raw"),
    SERIES,
    select="""SELECT vin, month, soh_raw FROM (SELECT *, max(CAST(j AS INT)) OVER (PARTITION BY vin ORDER BY month) AS seen FROM (
      SELECT *, coalesce(soh_raw - lag(soh_raw) OVER w > 15 AND km_month * 10 - lag(km_month * 10) OVER w > 8000, false) AS j FROM ser WINDOW w AS (PARTITION BY vin ORDER BY month))) WHERE seen = 0""",
    columns="vin:i month:t soh_raw:d",
)
