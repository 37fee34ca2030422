"""Queries of the state-of-health estimators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import monthly as mo
from ..operators import series as sr
from ..operators import soh
from ..sources import fixtures as fx
from .base import REGISTRATION, SERIES, TELEMETRY, Book
from .events import CHARGE, CROSS, GAP_S, SESSIONS, capacities, clean_samples, event_table, sessions
from .monthly import DOD, FEATURES
from .series import HAMPEL, pava

book = Book()
add = book.add


def pooled(s: SparkSession, d: str) -> DataFrame:
    return soh.pooled_capacity(capacities(s, d), 30.0, (10.0, 4000.0))


POOLED = "poo AS (SELECT * FROM (SELECT vin, date_trunc('month', t0)::TIMESTAMP AS month, sum(abs(ah)) / (sum(dsoc) / 100) AS capacity_ah, count(*) AS n_sessions, sum(dsoc) AS tot_dsoc FROM cap GROUP BY 1, 2) WHERE tot_dsoc >= 30 AND capacity_ah BETWEEN 10 AND 4000)"

add("e01_coulomb_capacity", pooled, TELEMETRY, SESSIONS, POOLED, select="SELECT * FROM poo", columns="vin:i month:t capacity_ah:d n_sessions:i tot_dsoc:d")


def months(s: SparkSession, d: str) -> DataFrame:
    return fx.series(s, d).select("vin", "month", F.col("cap_raw").alias("capacity_ah"), "n", "km_month")


ANCHOR = "anc AS (SELECT f.vin, CASE WHEN coalesce(regd_date <= first_month, false) THEN regd_date ELSE first_month END AS anchor, coalesce(regd_date <= first_month, false) AS used_reg FROM (SELECT vin, min(month) AS first_month FROM ser GROUP BY vin) f LEFT JOIN reg USING (vin))"
add("e03_anchor_dates", lambda s, d: soh.anchor_dates(months(s, d), fx.registration(s, d)).withColumn("used_reg", F.col("used_reg").cast("int")), SERIES, REGISTRATION, ANCHOR, select="SELECT vin, anchor, CAST(used_reg AS INT) AS used_reg FROM anc", columns="vin:i anchor:t used_reg:i")

TO_SOH = """cts0 AS (SELECT s.vin, s.month, date_diff('day', anchor, s.month) / 30.4 AS age_months, median(cap_raw) OVER (PARTITION BY s.vin ORDER BY s.month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS smooth FROM ser s JOIN anc a ON a.vin = s.vin),
cts1 AS (SELECT vin, min(age_months) AS first_age, max(age_months) - min(age_months) AS span, count(*) AS months, regr_slope(smooth, age_months) AS slope FROM cts0 GROUP BY vin),
cts2 AS (SELECT c.vin, median(smooth) FILTER (WHERE age_months <= first_age + 11) AS base FROM cts0 c JOIN cts1 v ON v.vin = c.vin GROUP BY c.vin),
cts3 AS (SELECT vin, base * (1 + CASE WHEN months >= 4 AND span > 0 THEN least(greatest(-slope / greatest(base, 1e-9), 0), 0.01) ELSE 0 END * greatest(first_age, 0)) AS cap0 FROM cts1 JOIN cts2 USING (vin)),
num AS (SELECT c.vin, month, age_months, least(100 * smooth / cap0, 100.0) AS soh_raw, row_number() OVER w AS rn, coalesce(date_diff('day', lag(month) OVER w, month) / 30.4, 1.0) AS gap FROM cts0 c JOIN cts3 v ON v.vin = c.vin WINDOW w AS (PARTITION BY c.vin ORDER BY month))"""
WALK = "walk AS (SELECT vin, month, rn, least({y}, 100.0) AS soh FROM {t} WHERE rn = 1 UNION ALL SELECT n.vin, n.month, n.rn, greatest(least(n.{y}, w.soh), w.soh - 6.0 * greatest(n.gap, 1e-9)) FROM walk w JOIN {t} n ON n.vin = w.vin AND n.rn = w.rn + 1)"
add(
    "e02_capacity_to_soh",
    lambda s, d: soh.capacity_to_soh(months(s, d), fx.registration(s, d)),
    SERIES, REGISTRATION, ANCHOR, TO_SOH, HAMPEL, pava("ham", "clipped", "iso"),
    "lim AS (SELECT h.*, CASE WHEN months = 1 THEN least(soh_raw, 100.0) ELSE least(fit, 100.0) END AS y FROM ham h JOIN iso USING (vin, rn))",
    WALK.format(y="y", t="lim"),
    select="SELECT w.vin, w.month, age_months, soh_raw, soh FROM walk w JOIN num USING (vin, rn)",
    columns="vin:i month:t age_months:d soh_raw:d soh:d",
)
add(
    "e02_greedy_capacity_to_soh",
    lambda s, d: soh.capacity_to_soh(months(s, d), fx.registration(s, d), method="greedy"),
    SERIES, REGISTRATION, ANCHOR, TO_SOH, WALK.format(y="soh_raw", t="num"),
    select="SELECT w.vin, w.month, soh_raw, soh FROM walk w JOIN num USING (vin, rn)",
    columns="vin:i month:t soh_raw:d soh:d",
)


def readings(s: SparkSession, d: str) -> DataFrame:
    """Part prices over sizes by supplier-month play full-capacity readings: 1 to 19 a month."""
    rows = fx.table(s, d, "lineitem")
    return rows.select(F.col("l_suppkey").alias("vin"), F.date_trunc("month", "l_shipdate").alias("month"), (110 - F.col("l_quantity") / 2).alias("full_cap"))


READINGS = "rea AS (SELECT l_suppkey AS vin, date_trunc('month', l_shipdate)::TIMESTAMP AS month, 110 - l_quantity / 2 AS full_cap FROM lineitem)"


def bms(min_readings: int, min_months: int, first: int, q: float) -> str:
    return f"""bm0 AS (SELECT *, median(full_cap) OVER (PARTITION BY vin) AS mid FROM rea),
bm1 AS (SELECT vin, month, median(full_cap) AS full_cap, count(*) AS n FROM bm0 WHERE mid >= 40 AND full_cap BETWEEN 0.6 * mid AND 1.4 * mid GROUP BY 1, 2 HAVING count(*) >= {min_readings}),
bm2 AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn, count(*) OVER (PARTITION BY vin) AS months FROM bm1),
num AS (SELECT * FROM bm2 WHERE months >= {min_months}), nom AS (SELECT vin, quantile_cont(full_cap, {q}) AS nominal FROM num WHERE rn <= {first} GROUP BY vin)"""


add(
    "e04_remaining_capacity_soh",
    lambda s, d: soh.remaining_capacity_soh(readings(s, d), 8),
    READINGS, bms(8, 6, 6, 0.9), pava("num", "full_cap", "iso"),
    select="SELECT vin, month, n, least(100 * fit / nominal, 100.0) AS soh FROM num JOIN iso USING (vin, rn) JOIN nom USING (vin)",
    columns="vin:i month:t n:i soh:d",
)
add(
    "e05_e06_remaining_capacity_variants",
    lambda s, d: soh.remaining_capacity_soh(readings(s, d), 5, 3, nominal_months=3, nominal_q=0.5),
    READINGS, bms(5, 3, 3, 0.5), pava("num", "full_cap", "iso"),
    select="SELECT vin, month, n, least(100 * fit / nominal, 100.0) AS soh FROM num JOIN iso USING (vin, rn) JOIN nom USING (vin)",
    columns="vin:i month:t n:i soh:d",
)
REPORTED = """rep0 AS (SELECT vin, month, median(full_cap) AS reported, count(*) AS n FROM rea WHERE full_cap BETWEEN 40 AND 110 GROUP BY 1, 2 HAVING count(*) >= 5),
rep1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY vin) AS months FROM rep0) WHERE months >= 4),
rep AS (SELECT *, least(median(reported) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 100.0) AS soh_raw FROM rep1)"""
add(
    "e07_e08_reported_soh",
    lambda s, d: soh.reported_soh(readings(s, d).withColumn("t", F.col("month")), "full_cap", min_readings=5),
    READINGS, REPORTED,
    select="SELECT vin, month, n, soh_raw, min(soh_raw) OVER (PARTITION BY vin ORDER BY month) AS soh FROM rep",
    columns="vin:i month:t n:i soh_raw:d soh:d",
)
add(
    "e09_simple_coulomb",
    lambda s, d: sr.isotonic_envelope(months(s, d).withColumn("soh_raw", 100 * F.col("capacity_ah") / F.max("capacity_ah").over(sr.own()))),
    SERIES,
    "num AS (SELECT vin, month, 100 * cap_raw / max(cap_raw) OVER (PARTITION BY vin) AS soh_raw, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM ser)",
    pava("num", "soh_raw", "iso"),
    select="SELECT vin, month, soh_raw, least(fit, 100.0) AS soh FROM num JOIN iso USING (vin, rn)",
    columns="vin:i month:t soh_raw:d soh:d",
)


def segments(s: SparkSession, d: str) -> DataFrame:
    """Line items play drive segments: dkm from the quantity, dsoc from the tax."""
    return fx.table(s, d, "lineitem").select(F.col("l_suppkey").alias("vin"), F.col("l_shipdate").cast("timestamp").alias("t"), F.col("l_quantity").alias("dkm"), (F.col("l_tax") * 500 + 5).alias("dsoc"))


PROXY = """pro0 AS (SELECT l_suppkey AS vin, date_trunc('month', l_shipdate)::TIMESTAMP AS month, 100 * sum(l_quantity) / sum(l_tax * 500 + 5) AS range_km, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 3),
pro1 AS (SELECT *, count(*) OVER (PARTITION BY vin) AS months, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM pro0 WHERE range_km BETWEEN 20 AND 400),
pro AS (SELECT *, median(range_km) FILTER (WHERE rn <= 6) OVER (PARTITION BY vin) AS base FROM pro1 WHERE months >= 4)"""
add("e10_distance_proxy", lambda s, d: soh.distance_proxy(segments(s, d)), PROXY, select="SELECT vin, month, range_km, n, greatest(least(100 * range_km / base, 110.0), 40.0) AS soh FROM pro", columns="vin:i month:t range_km:d n:i soh:d")
add(
    "e11_first_month_proxy",
    lambda s, d: soh.first_month_proxy(fx.series(s, d), "cap_raw"),
    SERIES,
    select="SELECT vin, month, min(raw) OVER (PARTITION BY vin ORDER BY month) AS soh FROM (SELECT vin, month, least(100 * cap_raw / first_value(cap_raw) OVER (PARTITION BY vin ORDER BY month), 100.0) AS raw FROM ser)",
    columns="vin:i month:t soh:d",
)
add(
    "e12_full_charge_soh",
    lambda s, d: soh.full_charge_soh(fx.series(s, d).where("n >= 8").withColumnsRenamed({"cap_raw": "cap", "month": "t0"})),
    SERIES,
    "ful AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM ser WHERE n >= 8)",
    "bas AS (SELECT vin, CASE WHEN count(*) FILTER (WHERE age_months BETWEEN 1 AND 12) >= 2 THEN median(cap_raw) FILTER (WHERE age_months BETWEEN 1 AND 12) ELSE median(cap_raw) FILTER (WHERE rn <= 5) END AS cap0 FROM ful GROUP BY vin)",
    select="SELECT vin, month AS t0, least(100 * cap_raw / cap0, 100.0) AS soh_full FROM ful JOIN bas USING (vin)",
    columns="vin:i t0:t soh_full:d",
)
add(
    "e13_upper_quartile_soh",
    lambda s, d: soh.upper_quartile_soh(readings(s, d).select("vin", F.col("month").alias("t0"), F.col("full_cap").alias("cap"))),
    READINGS,
    "uq0 AS (SELECT vin, month, quantile_cont(full_cap, 0.75) AS cap, count(*) AS n FROM rea GROUP BY 1, 2 HAVING count(*) >= 3)",
    "uq1 AS (SELECT *, median(cap) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM uq0)",
    "uq2 AS (SELECT *, least(100 * smooth / median(smooth) FILTER (WHERE rn <= 3) OVER (PARTITION BY vin), 102.0) AS raw FROM uq1)",
    select="SELECT vin, month, n, min(raw) OVER (PARTITION BY vin ORDER BY month) AS soh FROM uq2",
    columns="vin:i month:t n:i soh:d",
)
add(
    "e14_align_methods",
    lambda s, d: soh.align_methods(proxy=soh.distance_proxy(segments(s, d)), reported=soh.reported_soh(readings(s, d).withColumn("t", F.col("month")), "full_cap", min_readings=5)),
    READINGS, REPORTED, PROXY,
    select="SELECT vin, month, p.soh AS proxy, r.soh AS reported FROM (SELECT vin, month, greatest(least(100 * range_km / base, 110.0), 40.0) AS soh FROM pro) p FULL JOIN (SELECT vin, month, min(soh_raw) OVER (PARTITION BY vin ORDER BY month) AS soh FROM rep) r USING (vin, month)",
    columns="vin:i month:t proxy:d reported:d",
)
add(
    "e15_charge_rate_proxy",
    lambda s, d: soh.charge_rate_proxy(clean_samples(s, d)),
    TELEMETRY, SESSIONS, CROSS,
    select="""SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, median(rate) AS rate, count(*) AS n FROM (SELECT *, rate / median(rate) OVER (PARTITION BY vin) AS rel FROM (SELECT vin, t, 40 / ((epoch_us(t_high) - epoch_us(t)) / 1e6 / 3600) AS rate
      FROM (SELECT c.*, (SELECT min(h.t) FROM crs h WHERE h.vin = c.vin AND h.up_high AND (h.t, h.id) >= (c.t, c.id)) AS t_high, (SELECT min(h.t) FROM crs h WHERE h.vin = c.vin AND h.fall AND (h.t, h.id) > (c.t, c.id)) AS t_fall FROM crs c WHERE c.up_low)
      WHERE t_high IS NOT NULL AND t_high > t AND (t_fall IS NULL OR t_fall > t_high))) WHERE rel BETWEEN 0.75 AND 1.33 GROUP BY 1, 2""",
    columns="vin:i month:t rate:d n:i",
)
add(
    "e16_e17_daily_fade",
    lambda s, d: soh.daily_fade(clean_samples(s, d), "rem_cap"),
    TELEMETRY,
    "day0 AS (SELECT vin, date_trunc('day', t) AS day, median(rem_cap) AS x, max(odo) AS odo FROM ok GROUP BY 1, 2)",
    "day1 AS (SELECT *, median(x) OVER (PARTITION BY vin ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS smooth, date_diff('day', min(day) OVER (PARTITION BY vin), day) / 365.25 AS years FROM day0)",
    select="SELECT vin, regr_slope(smooth, years) AS per_year, regr_slope(smooth, odo) * 1000 AS per_1000_km, count(*) AS days FROM day1 GROUP BY vin",
    columns="vin:i per_year:d per_1000_km:d days:i",
)
add(
    "e18_prefer_dense_source",
    lambda s, d: soh.prefer(fx.series(s, d).where("vin % 3 = 0").select("vin", "month", "soh_raw"), fx.series(s, d).select("vin", "month", (F.col("soh_raw") - 1).alias("soh_raw"))),
    SERIES,
    select="SELECT vin, month, CASE WHEN vin % 3 = 0 THEN soh_raw ELSE soh_raw - 1 END AS soh_raw FROM ser",
    columns="vin:i month:t soh_raw:d",
)
add(
    "e19_hybrid_target",
    lambda s, d: soh.hybrid_target(fx.series(s, d).withColumn("soh", F.col("soh_raw")), fx.series(s, d).where("n >= 7").withColumn("soh", sr.running_min("soh_raw")), fx.registration(s, d).where("oem = 'ASIA'")),
    SERIES, REGISTRATION,
    "cle AS (SELECT vin, month, min(soh_raw) OVER (PARTITION BY vin ORDER BY month) AS clean FROM ser WHERE n >= 7)",
    select="SELECT vin, month, CASE WHEN oem = 'ASIA' THEN soh_raw ELSE clean END AS soh_hybrid FROM ser LEFT JOIN cle USING (vin, month) JOIN reg USING (vin)",
    columns="vin:i month:t soh_hybrid:d",
)


def feature_store(s: SparkSession, d: str) -> DataFrame:
    samples = clean_samples(s, d)
    features = mo.electrical_features(ev.sessions(samples, GAP_S))
    health = soh.capacity_to_soh(pooled(s, d), fx.registration(s, d), method="greedy")
    return soh.assemble(health, features)


add(
    "e20_feature_store",
    lambda s, d: feature_store(s, d).withColumn("used_reg", F.col("used_reg").cast("int")),
    TELEMETRY, SESSIONS, POOLED, REGISTRATION,
    "ser AS (SELECT vin, month, capacity_ah AS cap_raw FROM poo)",
    ANCHOR, TO_SOH, WALK.format(y="soh_raw", t="num"), DOD, FEATURES,
    "sto AS (SELECT p.*, age_months, used_reg, n.soh_raw, w.soh, fea.* EXCLUDE (vin, month) FROM poo p JOIN num n USING (vin, month) JOIN walk w USING (vin, month) JOIN anc USING (vin) LEFT JOIN fea USING (vin, month))",
    "kms AS (SELECT *, coalesce(greatest(odo_max - lag(odo_max) OVER (PARTITION BY vin ORDER BY month), 0), 0) AS km_month FROM sto)",
    select="""SELECT * REPLACE (vin::VARCHAR AS vin, used_reg::INT AS used_reg, coalesce(ah_throughput, 0) AS ah_throughput), strftime(month, '%Y-%m-%d') AS ymd, n_rows AS n_rows_ic, NULL AS dte_mean, sum(coalesce(ah_throughput, 0)) OVER w AS cum_ah, sum(km_month) OVER w AS cum_km,
      1 / sqrt(greatest(age_months, 0) + 1) AS inv_sqrt_age, 100 - soh AS soh_deficit FROM kms WINDOW w AS (PARTITION BY vin ORDER BY month)""",
    columns="vin:s ymd:s capacity_ah:d n_sessions:i tot_dsoc:d age_months:d used_reg:i soh_raw:d soh:d ah_throughput:d cur_abs_mean:d cur_dis_mean:d cur_chg_mean:d soc_mean:d frac_soc_high:d frac_soc_low:d volt_mean:d volt_min:d volt_max:d "
    "n_rows_ic:i cur_abs_p95:d dod_mean:d temp_mean:d temp_max:d dte_mean:d odo_max:d km_month:d cum_ah:d cum_km:d inv_sqrt_age:d soh_deficit:d",
)
add(
    "e12_charge_events_to_soh",
    lambda s, d: soh.full_charge_soh(event_table(s, d).where("kind = 1").withColumn("cap", F.col("ah")).withColumn("age_months", F.lit(0.0))),
    TELEMETRY, SESSIONS, CHARGE,
    "cha AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY t0) AS rn FROM evt JOIN (SELECT DISTINCT vin, ev, kind FROM che) USING (vin, ev) WHERE kind = 1)",
    "bas AS (SELECT vin, median(ah) FILTER (WHERE rn <= 5) AS cap0 FROM cha GROUP BY vin)",
    select="SELECT vin, ev, CASE WHEN cap0 <> 0 THEN least(100 * ah / cap0, 100.0) END AS soh_full FROM cha JOIN bas USING (vin)",
    columns="vin:i ev:i soh_full:d",
)
