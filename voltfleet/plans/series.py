"""Queries of window operators on vehicle-months."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import selection
from ..operators import series as sr
from ..sources import fixtures as fx
from .base import SERIES, Book

book = Book()
add = book.add

W = "WINDOW w AS (PARTITION BY vin ORDER BY month)"
NUM = "num AS (SELECT vin, month, soh_raw, age_months, row_number() OVER w AS rn, coalesce(date_diff('day', lag(month) OVER w, month) / 30.4, 1.0) AS gap FROM ser WINDOW w AS (PARTITION BY vin ORDER BY month))"


def pava(source: str, value: str, name: str) -> str:
    """Non-increasing fit by its min-max form: the least over starts of the greatest mean over ends."""
    return f"""{name}_p AS (SELECT *, sum({value}) OVER (PARTITION BY vin ORDER BY rn) AS run FROM {source}),
{name}_m AS (SELECT a.vin, a.rn AS a, b.rn AS b, (b.run - a.run + a.{value}) / (b.rn - a.rn + 1) AS mean FROM {name}_p a JOIN {name}_p b ON a.vin = b.vin AND b.rn >= a.rn),
{name}_x AS (SELECT vin, a, b, max(mean) OVER (PARTITION BY vin, a ORDER BY b DESC) AS top FROM {name}_m),
{name} AS (SELECT i.vin, i.rn, min(x.top) AS fit FROM {source} i JOIN {name}_x x ON x.vin = i.vin AND x.a <= i.rn AND x.b = i.rn GROUP BY 1, 2)"""


add(
    "f01_f02_lag_lead",
    lambda s, d: fx.series(s, d).select("vin", "month", (F.col("soh_raw") - F.lag("soh_raw").over(sr.by_month())).alias("step"), (F.lead("soh_raw").over(sr.by_month()) - F.col("soh_raw")).alias("next")),
    SERIES,
    select=f"SELECT vin, month, soh_raw - lag(soh_raw) OVER w AS step, lead(soh_raw) OVER w - soh_raw AS next FROM ser {W}",
    columns="vin:i month:t step:d next:d",
)
add(
    "f03_f04_rolling",
    lambda s, d: fx.series(s, d).select("vin", "month", sr.rolling_median("cap_raw", 5).alias("med5"), sr.rolling_mean("cap_raw", 5).alias("mean5"), sr.trailing_median("cap_raw", 7).alias("med7")),
    SERIES,
    select="""SELECT vin, month, median(cap_raw) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS med5, avg(cap_raw) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS mean5,
      median(cap_raw) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS med7 FROM ser""",
    columns="vin:i month:t med5:d mean5:d med7:d",
)
add(
    "f05_f06_f07_cumulative_and_ages",
    lambda s, d: sr.ages(
        sr.cumulative(fx.series(s, d).withColumn("km_step", sr.km_from_odometer("km_month")).withColumn("soh", F.col("soh_raw")), {"ah_throughput": "cum_ah", "km_month": "cum_km"}).withColumn("anchor", F.min("month").over(sr.own())), "anchor"
    ),
    SERIES,
    select=f"""SELECT vin, month, sum(ah_throughput) OVER w AS cum_ah, sum(km_month) OVER w AS cum_km, coalesce(greatest(km_month - lag(km_month) OVER w, 0), 0) AS km_step, age_months, 1 / sqrt(age_months + 1) AS inv_sqrt_age, 100 - soh_raw AS soh_deficit FROM ser {W}""",
    columns="vin:i month:t cum_ah:d cum_km:d km_step:d age_months:d inv_sqrt_age:d soh_deficit:d",
)
add(
    "f06_capped_distance",
    lambda s, d: fx.series(s, d).select("vin", "month", sr.km_from_odometer("km_month", 800.0).alias("km")),
    SERIES,
    select="SELECT vin, month, least(greatest(top - coalesce(lag(top) OVER w, top), 0), 800) AS km FROM (SELECT vin, month, max(km_month) OVER (PARTITION BY vin ORDER BY month) AS top FROM ser) WINDOW w AS (PARTITION BY vin ORDER BY month)",
    columns="vin:i month:t km:d",
)
add(
    "f08_running_extremes",
    lambda s, d: fx.series(s, d).select("vin", "month", sr.running_min("soh_raw").alias("low"), sr.running_max("km_month").alias("high")),
    SERIES,
    select=f"SELECT vin, month, min(soh_raw) OVER w AS low, max(km_month) OVER w AS high FROM ser {W}",
    columns="vin:i month:t low:d high:d",
)
add(
    "f09_greedy_envelope",
    lambda s, d: sr.greedy_envelope(fx.series(s, d)),
    SERIES, NUM,
    "walk AS (SELECT vin, month, rn, least(soh_raw, 100.0) AS soh FROM num WHERE rn = 1 UNION ALL SELECT n.vin, n.month, n.rn, greatest(least(n.soh_raw, w.soh), w.soh - 6.0 * greatest(n.gap, 1e-9)) FROM walk w JOIN num n ON n.vin = w.vin AND n.rn = w.rn + 1)",
    select="SELECT vin, month, soh FROM walk",
    columns="vin:i month:t soh:d",
)
add(
    "f10_isotonic_envelope",
    lambda s, d: sr.isotonic_envelope(fx.series(s, d)),
    SERIES, NUM, pava("num", "soh_raw", "iso"),
    select="SELECT vin, month, least(fit, 100.0) AS soh FROM num JOIN iso USING (vin, rn)",
    columns="vin:i month:t soh:d",
)
HAMPEL = """ham0 AS (SELECT *, median(soh_raw) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS mid FROM num),
ham1 AS (SELECT *, 3.0 * 1.4826 * greatest(median(abs(soh_raw - mid)) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 1e-6) AS band FROM ham0),
ham AS (SELECT *, greatest(least(soh_raw, mid + band), mid - band) AS clipped, count(*) OVER (PARTITION BY vin) AS months FROM ham1)"""
add(
    "f11_robust_isotonic",
    lambda s, d: sr.robust_isotonic(fx.series(s, d)),
    SERIES, NUM, HAMPEL, pava("ham", "clipped", "iso"),
    "lim AS (SELECT h.*, CASE WHEN months = 1 THEN least(soh_raw, 100.0) ELSE least(fit, 100.0) END AS y FROM ham h JOIN iso USING (vin, rn))",
    "walk AS (SELECT vin, month, rn, least(y, 100.0) AS soh FROM lim WHERE rn = 1 UNION ALL SELECT n.vin, n.month, n.rn, greatest(least(n.y, w.soh), w.soh - 6.0 * greatest(n.gap, 1e-9)) FROM walk w JOIN lim n ON n.vin = w.vin AND n.rn = w.rn + 1)",
    select="SELECT vin, month, soh FROM walk",
    columns="vin:i month:t soh:d",
)
add(
    "f14_recent_stress",
    lambda s, d: sr.last_values(fx.series(s, d), "temp_max"),
    SERIES,
    select="SELECT vin, median(temp_max) AS temp_max FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS rn FROM ser) WHERE rn <= 6 GROUP BY vin",
    columns="vin:i temp_max:d",
)
add(
    "f15_f16_recent_windows",
    lambda s, d: fx.series(s, d).withColumn("loss_rate", sr.recent_loss_rate(fx.series(s, d), "soh_raw")).select("vin", "month", "loss_rate", sr.trailing_median("dod_mean", 6).alias("dod6")),
    SERIES,
    select="""SELECT vin, month, CASE WHEN c >= 3 AND age_months > a0 THEN greatest((s0 - soh_raw) / (age_months - a0), 0) ELSE 0 END AS loss_rate, dod6 FROM (SELECT *, count(*) OVER w8 AS c, first_value(soh_raw) OVER w8 AS s0, first_value(age_months) OVER w8 AS a0,
      median(dod_mean) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS dod6 FROM ser WINDOW w8 AS (PARTITION BY vin ORDER BY month ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""",
    columns="vin:i month:t loss_rate:d dod6:d",
)
add(
    "f17_suffix_median",
    lambda s, d: selection.later_medians(fx.series(s, d).select("vin", "month", "soh_raw"), "soh_raw", "later").select("vin", "month", "later"),
    SERIES,
    select="SELECT vin, month, median(soh_raw) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM ser",
    columns="vin:i month:t later:d",
)
add(
    "f13_f18_last_and_trailing_run",
    lambda s, d: sr.trailing_run(fx.series(s, d).withColumn("k", F.floor(F.col("soh_raw") / 25)), "k").join(fx.series(s, d).groupBy("vin").agg(F.max_by("soh_raw", "month").alias("last")), "vin"),
    SERIES,
    select="""SELECT vin, count(*) FILTER (WHERE seen = 0) AS run, arg_max(soh_raw, month) AS last FROM (SELECT *, sum(CAST(coalesce(k <> p, false) AS INT)) OVER (PARTITION BY vin ORDER BY month DESC) AS seen FROM (SELECT *, lag(k) OVER (PARTITION BY vin ORDER BY month DESC) AS p FROM (SELECT *, floor(soh_raw / 25) AS k FROM ser))) GROUP BY vin""",
    columns="vin:i run:i last:d",
)
add(
    "f19_f20_z_score_and_group_median",
    lambda s, d: fx.series(s, d).select("vin", "month", sr.z_score("soh_raw").alias("z"), F.median("soh_raw").over(sr.own()).alias("mid")),
    SERIES,
    select="SELECT vin, month, CASE WHEN stddev_samp(soh_raw) OVER o > 0 THEN (soh_raw - avg(soh_raw) OVER o) / stddev_samp(soh_raw) OVER o ELSE 0 END AS z, median(soh_raw) OVER o AS mid FROM ser WINDOW o AS (PARTITION BY vin)",
    columns="vin:i month:t z:d mid:d",
)
add(
    "f21_group_size",
    lambda s, d: sr.group_at_least(fx.series(s, d).where("n >= 8"), 40).select("vin", "month"),
    SERIES,
    select="SELECT vin, month FROM (SELECT *, count(*) OVER (PARTITION BY vin) AS c FROM ser WHERE n >= 8) WHERE c >= 40",
    columns="vin:i month:t",
)
add(
    "f22_f23_ranks",
    lambda s, d: fx.series(s, d).withColumn("k", F.round("temp_max")).select("vin", "month", sr.average_rank("k", "vin").alias("rank"), sr.percentile_below("k", "vin").alias("below")),
    SERIES,
    select="""SELECT vin, month, rank() OVER (PARTITION BY vin ORDER BY k) + (count(*) OVER (PARTITION BY vin, k) - 1) / 2 AS rank, (rank() OVER (PARTITION BY vin ORDER BY k) - 1) / count(*) OVER (PARTITION BY vin) * 100 AS below FROM (SELECT *, round(temp_max) AS k FROM ser)""",
    columns="vin:i month:t rank:d below:d",
)
add(
    "f24_accumulated_steps",
    lambda s, d: sr.accumulate_steps(fx.series(s, d).select("vin", F.row_number().over(sr.by_month()).alias("h"), (100 - F.col("soh_raw")).alias("loss")), "loss"),
    SERIES,
    select="SELECT vin, h, max(loss) OVER (PARTITION BY vin ORDER BY h) AS loss FROM (SELECT vin, row_number() OVER (PARTITION BY vin ORDER BY month) AS h, 100 - soh_raw AS loss FROM ser)",
    columns="vin:i h:i loss:d",
)
add(
    "f25_fill_both",
    lambda s, d: fx.series(s, d).withColumn("x", F.when(F.col("n") % 3 == 0, F.col("soh_raw"))).select("vin", "month", sr.fill_both("x").alias("x")),
    SERIES,
    select="SELECT vin, month, coalesce(last_value(x IGNORE NULLS) OVER (PARTITION BY vin ORDER BY month), first_value(x IGNORE NULLS) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM (SELECT *, CASE WHEN n % 3 = 0 THEN soh_raw END AS x FROM ser)",
    columns="vin:i month:t x:d",
)
