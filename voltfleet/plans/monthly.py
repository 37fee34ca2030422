"""Queries of vehicle-month, vehicle and fleet reductions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import monthly as m
from ..sources import fixtures as fx
from .base import REGISTRATION, SERIES, TELEMETRY, Book
from .events import CHARGE, SESSIONS, clean_samples, event_table, sessions

book = Book()
add = book.add

DOD = "dod AS (SELECT vin, date_trunc('month', t0)::TIMESTAMP AS month, avg(soc0 - soc1) AS dod_mean FROM rol WHERE soc0 - soc1 >= 3 GROUP BY 1, 2)"
FEATURES = """fea AS (SELECT f.*, dod_mean FROM (SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, sum(abs(dq)) AS ah_throughput, avg(abs(amps)) AS cur_abs_mean, coalesce(avg(amps) FILTER (WHERE amps < 0), 0) AS cur_dis_mean,
  coalesce(avg(amps) FILTER (WHERE amps > 0), 0) AS cur_chg_mean, avg(soc) AS soc_mean, avg(CAST(soc > 90 AS DOUBLE)) AS frac_soc_high, avg(CAST(soc < 20 AS DOUBLE)) AS frac_soc_low, avg(volts) AS volt_mean, min(volts) AS volt_min,
  max(volts) AS volt_max, count(*) AS n_rows, quantile_cont(abs(amps), 0.95) AS cur_abs_p95, avg(temp) AS temp_mean, max(temp) AS temp_max, max(odo) AS odo_max, quantile_cont(abs(amps), 0.95) / 133 AS crate_p95 FROM ses GROUP BY 1, 2) f LEFT JOIN dod USING (vin, month))"""

add(
    "d01_d05_electrical_features",
    lambda s, d: m.electrical_features(sessions(s, d), nominal=133.0),
    TELEMETRY, SESSIONS, DOD, FEATURES,
    select="SELECT * FROM fea",
    columns="vin:i month:t ah_throughput:d cur_abs_mean:d cur_dis_mean:d cur_chg_mean:d soc_mean:d frac_soc_high:d frac_soc_low:d volt_mean:d volt_min:d volt_max:d n_rows:i cur_abs_p95:d temp_mean:d temp_max:d odo_max:d crate_p95:d dod_mean:d",
)
add(
    "d06_d07_d10_usage_features",
    lambda s, d: m.energy_per_km(m.usage_features(clean_samples(s, d)).join(m.electrical_features(sessions(s, d)).select("vin", "month", "ah_throughput", "volt_mean"), ["vin", "month"])),
    TELEMETRY, SESSIONS, DOD, FEATURES,
    select="""SELECT u.*, ah_throughput * volt_mean / nullif(km, 0) AS wh_per_km FROM (SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, max(odo) - min(odo) AS km, avg(CAST(amps < 0 AS DOUBLE)) AS drive_share, avg(soc) AS soc_mean, quantile_cont(temp, 0.95) AS temp_p95 FROM ok GROUP BY 1, 2) u JOIN fea USING (vin, month)""",
    columns="vin:i month:t km:d drive_share:d soc_mean:d temp_p95:d wh_per_km:d",
)
add(
    "d09_d11_coverage",
    lambda s, d: m.coverage(fx.telemetry(s, d)),
    TELEMETRY,
    select="SELECT vin, count(*) AS n, count(DISTINCT date_trunc('month', t)) AS months, count(DISTINCT date_trunc('day', t)) AS days, min(t) AS first_seen, max(t) AS last_seen FROM tel GROUP BY vin",
    columns="vin:i n:i months:i days:i first_seen:t last_seen:t",
)
add(
    "d12_simple_features",
    lambda s, d: m.simple_features(clean_samples(s, d)),
    TELEMETRY, SESSIONS,
    select="""SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, sum(coalesce(abs(amps) * least(greatest(dt / 3600, 0), 1), 0)) AS ah_throughput, avg(-amps) FILTER (WHERE amps < 0) AS cur_dis_mean,
      avg(CAST(soc >= 80 AS DOUBLE)) AS frac_soc_high, avg(CAST(soc <= 20 AS DOUBLE)) AS frac_soc_low, max(soc) - min(soc) AS dod_mean FROM stp GROUP BY 1, 2""",
    columns="vin:i month:t ah_throughput:e cur_dis_mean:d frac_soc_high:d frac_soc_low:d dod_mean:d",
)
add(
    "d14_first_last",
    lambda s, d: m.first_last(fx.series(s, d), "soh_raw"),
    SERIES,
    select="SELECT vin, arg_min(soh_raw, month) AS first, arg_max(soh_raw, month) AS last, max(soh_raw) - min(soh_raw) AS range, count(*) AS n, arg_min(soh_raw, month) - arg_max(soh_raw, month) AS drop FROM ser WHERE soh_raw IS NOT NULL GROUP BY vin",
    columns='vin:i "first":d "last":d "range":d n:i "drop":d'.replace('"', ""),
)
add(
    "d15_edge_means",
    lambda s, d: m.edge_means(fx.series(s, d), "soh_raw").withColumnRenamed("end", "finish"),
    SERIES,
    select="""SELECT vin, avg(soh_raw) FILTER (WHERE u <= 3) AS start, avg(soh_raw) FILTER (WHERE v <= 3) AS finish FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month) AS u, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS v FROM ser) GROUP BY vin""",
    columns="vin:i start:d finish:d",
)
add(
    "d16_age_band",
    lambda s, d: m.age_band(fx.series(s, d), "soh_raw"),
    SERIES,
    select="SELECT * FROM (SELECT round_even(age_months / 3, 0) * 3 AS age, count(soh_raw) AS n, quantile_cont(soh_raw, 0.5) AS p50, quantile_cont(soh_raw, 0.1) AS p10, quantile_cont(soh_raw, 0.9) AS p90 FROM ser GROUP BY 1) WHERE n >= 5",
    columns="age:d n:i p50:d p10:d p90:d",
)
add("d17_fleet_stat", lambda s, d: m.fleet_stat(fx.series(s, d), "km_month"), SERIES, select="SELECT count(km_month) AS n, quantile_cont(km_month, 0.5) AS median, quantile_cont(km_month, 0.1) AS p10, quantile_cont(km_month, 0.9) AS p90 FROM ser", columns="n:i median:d p10:d p90:d")
add(
    "d18_feed_coverage",
    lambda s, d: m.feed_coverage(fx.series(s, d).where("vin % 2 = 0"), fx.series(s, d).where("vin % 2 = 1 and age_months > 6")),
    SERIES,
    select="SELECT month, count(*) FILTER (WHERE vin % 2 = 0) AS n_a, count(*) FILTER (WHERE vin % 2 = 1 AND age_months > 6) AS n_b FROM ser GROUP BY month HAVING count(*) FILTER (WHERE vin % 2 = 0 OR age_months > 6) > 0",
    columns="month:t n_a:i n_b:i",
)
add(
    "d19_resistance_by_soc_bin",
    lambda s, d: m.binned_median(ev.resistance_steps(clean_samples(s, d), 30.0, 36000.0), "r", "soc", 5.0),
    TELEMETRY, SESSIONS,
    select="SELECT floor(soc / 5) * 5 AS bin, median(abs(dv / di * 1000)) AS median, count(*) AS n FROM (SELECT soc, dt, amps - prev AS di, volts - lag(volts) OVER (PARTITION BY vin ORDER BY t, id) AS dv FROM stp) WHERE abs(di) >= 30 AND dt > 0 AND dt <= 36000 GROUP BY 1",
    columns="bin:d median:d n:i",
)
add("d20_histogram", lambda s, d: m.histogram(fx.series(s, d), "soh_raw", 50.0, 100.0, 20), SERIES, select="SELECT CASE WHEN soh_raw >= 100 THEN 21 WHEN soh_raw < 50 THEN 0 ELSE floor((soh_raw - 50) / 2.5)::BIGINT + 1 END AS bucket, count(*) AS n FROM ser WHERE soh_raw IS NOT NULL GROUP BY 1", columns="bucket:i n:i")
add("d21_mode_shares", lambda s, d: m.mode_shares(fx.telemetry(s, d)), TELEMETRY, select="SELECT vin, mode, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY vin) AS share FROM tel GROUP BY vin, mode", columns="vin:i mode:s n:i share:d")
add(
    "d22_survival_by_source",
    lambda s, d: m.survival(fx.series(s, d).join(fx.registration(s, d), "vin"), "oem", "soh_raw"),
    SERIES, REGISTRATION,
    select="SELECT oem, count(*) AS n, avg(CAST(soh_raw >= 80 AS DOUBLE)) AS share_ok, median(soh_raw) AS median, count(*) FILTER (WHERE soh_raw < 80) AS at_risk FROM ser JOIN reg USING (vin) GROUP BY oem",
    columns="oem:s n:i share_ok:d median:d at_risk:i",
)
add("d23_positive_median", lambda s, d: clean_samples(s, d).groupBy("vin").agg(m.positive_median("amps").alias("amps")), TELEMETRY, select="SELECT vin, median(amps) FILTER (WHERE amps > 0) AS amps FROM ok GROUP BY vin", columns="vin:i amps:d")
add(
    "d24_quartile_curves",
    lambda s, d: m.quartile_curves(fx.series(s, d), "soh_raw", "km_month"),
    SERIES,
    select="""SELECT quartile, round_even(age_months, 0) AS age, avg(soh_raw) AS mean, count(*) AS n FROM ser JOIN (SELECT vin, 1 + CAST(use > q[1] AS INT) + CAST(use > q[2] AS INT) + CAST(use > q[3] AS INT) AS quartile
      FROM (SELECT vin, avg(km_month) AS use FROM ser GROUP BY vin), (SELECT quantile_cont(use, [0.25, 0.5, 0.75]) AS q FROM (SELECT avg(km_month) AS use FROM ser GROUP BY vin))) USING (vin) GROUP BY 1, 2""",
    columns="quartile:i age:d mean:d n:i",
)
add("d25_mean_of_daily_minima", lambda s, d: m.mean_of_daily_minima(clean_samples(s, d), "soc"), TELEMETRY, select="SELECT vin, date_trunc('month', day)::TIMESTAMP AS month, avg(low) AS mean_low FROM (SELECT vin, date_trunc('day', t) AS day, min(soc) AS low FROM ok GROUP BY 1, 2) GROUP BY 1, 2", columns="vin:i month:t mean_low:d")
add(
    "d26_fleet_coverage",
    lambda s, d: m.fleet_coverage(fx.series(s, d).where("n >= 15"), fx.registration(s, d), "oem"),
    SERIES, REGISTRATION,
    select="SELECT oem, count(DISTINCT vin) AS fleet, count(DISTINCT vin) FILTER (WHERE vin IN (SELECT vin FROM ser WHERE n >= 15)) AS modelled FROM reg GROUP BY oem",
    columns="oem:s fleet:i modelled:i",
)
add(
    "d27_change_classes",
    lambda s, d: m.change_classes(fx.series(s, d), "soh_raw"),
    SERIES,
    select="""SELECT CASE WHEN g >= 2 THEN 'fall' WHEN g <= -2 THEN 'rise' ELSE 'flat' END AS class, count(*) AS n, median(g) AS median FROM (SELECT arg_min(soh_raw, month) - arg_max(soh_raw, month) AS g FROM ser WHERE soh_raw IS NOT NULL GROUP BY vin) GROUP BY 1""",
    columns="class:s n:i median:d",
)
add(
    "d28_threshold_sweep",
    lambda s, d: m.threshold_sweep(event_table(s, d).withColumn("cap", F.col("ah")), [50.0, 52.0, 54.0]),
    TELEMETRY, SESSIONS, CHARGE,
    select="""SELECT lim AS "limit", count(*) AS vehicles, median(cv) AS cv, median(n) AS n FROM (SELECT lim, vin, CASE WHEN count(*) > 1 THEN stddev_samp(ah) / avg(ah) * 100 END AS cv, count(*) AS n FROM evt, (SELECT unnest([50.0, 52.0, 54.0]) AS lim) WHERE v1 >= lim GROUP BY 1, 2) GROUP BY 1""",
    columns="limit:d vehicles:i cv:d n:d",
)
add(
    "d29_age_classes",
    lambda s, d: m.age_classes(fx.series(s, d), "soh_raw"),
    SERIES,
    select="""SELECT CASE WHEN abs(change) < 2 THEN 'flat' WHEN age < 24 THEN 'young' WHEN age < 48 THEN 'middle' ELSE 'old' END AS band, count(*) AS n, avg(change) AS change FROM (SELECT max(age_months) AS age, arg_max(soh_raw, month) - arg_min(soh_raw, month) AS change FROM ser GROUP BY vin) GROUP BY 1""",
    columns="band:s n:i change:d",
)
add("d08_distance_to_empty", lambda s, d: m.distance_to_empty(fx.telemetry(s, d).withColumn("dte", F.col("rem_cap") * 0.8 - 5)), TELEMETRY, select="SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, avg(rem_cap * 0.8 - 5) AS dte_mean FROM tel WHERE rem_cap * 0.8 - 5 BETWEEN 0 AND 1000 GROUP BY 1, 2", columns="vin:i month:t dte_mean:d")
add("d30_share_below", lambda s, d: m.share_below(fx.series(s, d).join(fx.registration(s, d).select("vin", "oem"), "vin"), "soh_raw", 80.0, "oem"), SERIES, REGISTRATION, select="SELECT oem, count(*) AS n, count(*) FILTER (WHERE now < 80) AS n_risk, avg(CAST(now < 80 AS DOUBLE)) AS share FROM (SELECT vin, oem, arg_max(soh_raw, month) AS now FROM ser JOIN reg USING (vin) GROUP BY 1, 2) GROUP BY oem", columns="oem:s n:i n_risk:i share:d")
