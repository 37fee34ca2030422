"""Queries of forecasts in closed form, remaining life, warranty and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions as de
from ..operators import joins as j
from ..operators import series as sr
from ..sources import fixtures as fx
from .base import REGISTRATION, SERIES, Book
from .quality import LAB, labelled
from .series import pava

book = Book()
add = book.add

H = 48
EOL = 60.0
#: Age in months that backtests cut histories at; the later months are their truth.
CUT = 40


def recent(s: SparkSession, d: str, before: int | None = None) -> DataFrame:
    """Labelled series with a running odometer; whole, or of the months ``before`` an age."""
    rows = labelled(s, d) if before is None else labelled(s, d).where(F.col("age_months") < before)
    return rows.withColumn("odo_max", F.sum("km_month").over(sr.so_far()))


def now(s: SparkSession, d: str, before: int | None = None) -> DataFrame:
    return j.latest(recent(s, d, before)).select("vin", "month", "age_months", "soh", F.col("odo_max").alias("odo"))


def forecast(s: SparkSession, d: str, before: int | None = None) -> DataFrame:
    return de.sqrt_forecast(recent(s, d, before), months=H)


def deadlines(s: SparkSession, d: str) -> DataFrame:
    return de.effective_deadline(recent(s, d), F.lit(8.0), F.lit(160_000.0))


REC = "rec AS (SELECT *, sum(km_month) OVER (PARTITION BY vin ORDER BY month) AS odo FROM lab)"
NOW = "now AS (SELECT vin, max(month) AS month, max(age_months) AS age, arg_max(soh, month) AS soh, arg_max(odo, month) AS odo FROM rec GROUP BY vin)"
FIT = "fit AS (SELECT a.vin, median((b.soh - a.soh) / (sqrt(b.age_months) - sqrt(a.age_months))) AS b FROM rec a JOIN rec b ON a.vin = b.vin AND b.age_months > a.age_months GROUP BY a.vin)"
FOR = f"fc AS (SELECT n.vin, h, age + h AS age_months, soh + least(b, 0) * (sqrt(age + h) - sqrt(age)) AS p50, soh + least(b, 0) * (sqrt(age + h) - sqrt(age)) - 1.5 * sqrt(h) AS p10 FROM now n JOIN fit f ON f.vin = n.vin, generate_series(1, {H}) AS g(h))"
DEA = "dea AS (SELECT vin, least(96.0, CASE WHEN pace > 0 THEN age + greatest(160000 - odo, 0) / pace END) AS deadline FROM now JOIN (SELECT vin, median(km_month) AS pace FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS rn FROM rec) WHERE rn <= 6 GROUP BY vin) USING (vin))"
BASE = (SERIES, LAB, REC, NOW, FIT, FOR, DEA)
BACKTEST = (SERIES, LAB, REC.replace("FROM lab)", f"FROM lab WHERE age_months < {CUT})"), NOW, FIT, FOR)

add("n12_n14_sqrt_forecast", forecast, *BASE, select="SELECT f.vin, f.h, f.age_months, p10, p50, least(p50 + 1.5 * sqrt(h), n.soh) AS p90 FROM fc f JOIN now n ON n.vin = f.vin", columns="vin:i h:i age_months:d p10:d p50:d p90:d")
add("n12_months_to_eol", lambda s, d: de.months_to_eol(recent(s, d), eol=EOL), *BASE, select="SELECT n.vin, soh AS now, CASE WHEN soh <= 60 THEN 0 WHEN b < 0 THEN (sqrt(age) + (60 - soh) / b) ** 2 - age END AS months FROM now n JOIN fit f ON f.vin = n.vin", columns="vin:i now:d months:e")
add("n11_persistence", lambda s, d: de.persistence(recent(s, d), months=12), *BASE, select="SELECT vin, h, age + h AS age_months, soh AS p50 FROM now, generate_series(1, 12) AS g(h)", columns="vin:i h:i age_months:d p50:d")
add(
    "n15_linear_forecast",
    lambda s, d: de.linear_forecast(recent(s, d), months=12),
    *BASE,
    "lin AS (SELECT r.vin, arg_min(r.soh, r.month) AS a, arg_max(r.soh, r.month) AS b, min(r.age_months) AS ta, max(r.age_months) AS tb FROM rec r JOIN now n ON n.vin = r.vin WHERE r.age_months >= n.age - 12 GROUP BY r.vin)",
    select="SELECT vin, h, tb + h AS age_months, b + CASE WHEN tb > ta THEN least((b - a) / (tb - ta), 0) ELSE 0 END * h AS p50 FROM lin, generate_series(1, 12) AS g(h)",
    columns="vin:i h:i age_months:d p50:d",
)
ACT = "act AS (SELECT s.vin, h, s.soh_raw - p50 AS residual, p10, p50, s.soh_raw FROM lab s JOIN now n ON n.vin = s.vin JOIN fc f ON f.vin = s.vin AND f.h = round_even(s.age_months - n.age, 0) WHERE s.age_months > n.age)"


def residuals(s: SparkSession, d: str) -> DataFrame:
    later = labelled(s, d).select("vin", F.col("age_months").alias("age"), "soh_raw").join(now(s, d, CUT).select("vin", F.col("age_months").alias("start")), "vin").where("age > start")
    return j.rounded_step_join(forecast(s, d, CUT), later, "age", "start").withColumn("residual", F.col("soh_raw") - F.col("p50"))


add("n09_calibrate_band", lambda s, d: de.calibrate_band(residuals(s, d)), *BACKTEST, ACT, select="SELECT least(quantile_cont(residual / sqrt(h), 0.1), -0.3) AS lo, greatest(quantile_cont(residual / sqrt(h), 0.9), 0.3) AS hi FROM act", columns="lo:d hi:d")
add(
    "n10_compact_rate",
    lambda s, d: de.compact_rate(labelled(s, d), "soh_raw"),
    SERIES,
    "num AS (SELECT vin, month, age_months, soh_raw, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM ser)",
    pava("num", "soh_raw", "iso"),
    "fit AS (SELECT * FROM num JOIN iso USING (vin, rn))",
    "rat AS (SELECT (arg_max(fit, rn) - arg_min(fit, rn)) / greatest(max(age_months) - min(age_months), 1) AS rate FROM fit GROUP BY vin)",
    select="SELECT (SELECT median(rate) FROM rat) AS rate, quantile_cont(soh_raw - fit, 0.1) AS q10, quantile_cont(soh_raw - fit, 0.9) AS q90 FROM fit",
    columns="rate:d q10:d q90:d",
)
add(
    "o01_o03_holdout_errors",
    lambda s, d: residuals(s, d).groupBy("vin").agg(F.sqrt(F.avg(F.pow("residual", F.lit(2.0)))).alias("rmse"), F.avg(-F.col("residual")).alias("bias"), F.avg((F.col("soh_raw") >= F.col("p10")).cast("double")).alias("above_p10"), F.count("*").alias("n")),
    *BACKTEST, ACT,
    select="SELECT vin, sqrt(avg(residual ** 2)) AS rmse, avg(-residual) AS bias, avg(CAST(soh_raw >= p10 AS DOUBLE)) AS above_p10, count(*) AS n FROM act GROUP BY vin",
    columns="vin:i rmse:d bias:d above_p10:d n:i",
)
add("p01_remaining_months", lambda s, d: de.remaining_months(forecast(s, d), EOL), *BASE, select="SELECT vin, min(h) FILTER (WHERE p50 <= 60) AS rul_months FROM fc GROUP BY vin", columns="vin:i rul_months:d")
PACE = "pac AS (SELECT vin, CASE WHEN max(age_months) > min(age_months) THEN (arg_max(odo, age_months) - arg_min(odo, age_months)) / (max(age_months) - min(age_months)) END AS km_per_month FROM rec GROUP BY vin)"
add("p02_km_per_month", lambda s, d: de.km_per_month(recent(s, d)), *BASE, PACE, select="SELECT * FROM pac", columns="vin:i km_per_month:d")
add(
    "p03_remaining_km",
    lambda s, d: de.remaining_km(now(s, d), forecast(s, d), de.km_per_month(recent(s, d)), (70.0, 65.0, 60.0)),
    *BASE, PACE,
    "pth AS (SELECT *, lag(p50) OVER (PARTITION BY vin ORDER BY h) AS before FROM (SELECT vin, 0 AS h, soh AS p50 FROM now UNION ALL SELECT vin, h, p50 FROM fc))",
    "crs AS (SELECT vin, lim, arg_min(CASE WHEN before IS NULL THEN 0 ELSE h - 1 + (before - lim) / (before - p50) END, h) AS months FROM pth, (SELECT unnest([70.0, 65.0, 60.0]) AS lim) WHERE p50 <= lim GROUP BY 1, 2)",
    select='SELECT n.vin, l.lim AS "limit", months, months * km_per_month AS km FROM now n CROSS JOIN (SELECT unnest([70.0, 65.0, 60.0]) AS lim) l LEFT JOIN crs c ON c.vin = n.vin AND c.lim = l.lim JOIN pac p ON p.vin = n.vin',
    columns="vin:i limit:d months:d km:e",
)
add("p07_effective_deadline", deadlines, *BASE, select="SELECT * FROM dea", columns="vin:i deadline:d")
add(
    "p04_at_risk",
    lambda s, d: de.at_risk(forecast(s, d), deadlines(s, d), EOL).select("vin", F.col("at_risk").cast("int").alias("at_risk"), F.col("at_risk_worst").cast("int").alias("at_risk_worst")),
    *BASE,
    select="SELECT d.vin, CAST(coalesce(bool_or(p50 <= 60) FILTER (WHERE age_months <= deadline), false) AS INT) AS at_risk, CAST(coalesce(bool_or(p10 <= 60) FILTER (WHERE age_months <= deadline), false) AS INT) AS at_risk_worst FROM dea d LEFT JOIN fc f ON f.vin = d.vin GROUP BY d.vin",
    columns="vin:i at_risk:i at_risk_worst:i",
)
add(
    "p05_outcome_groups",
    lambda s, d: de.outcome_groups(forecast(s, d), deadlines(s, d), recent(s, d).groupBy("vin").agg((F.max("soh") - F.min("soh")).alias("soh_drop"), F.max("age_months").alias("age_months")), EOL),
    *BASE,
    "nea AS (SELECT d.vin, arg_min(p50, (abs(age_months - deadline), age_months)) AS p50 FROM dea d JOIN fc f ON f.vin = d.vin GROUP BY d.vin)",
    select="SELECT vin, p50, CASE WHEN p50 <= 60 THEN 'at_risk' WHEN drop < 2 AND age >= 24 THEN 'flat' WHEN drop < 2 THEN 'flat_unproven' ELSE 'safe' END AS outcome FROM nea JOIN (SELECT vin, max(soh) - min(soh) AS drop, max(age_months) AS age FROM rec GROUP BY vin) USING (vin)",
    columns="vin:i p50:d outcome:s",
)
TIER = "tie AS (SELECT d.vin, deadline - min(age_months) FILTER (WHERE p50 <= 60) AS months_early FROM dea d LEFT JOIN fc f ON f.vin = d.vin GROUP BY d.vin, deadline)"
add("p06_risk_tier", lambda s, d: de.risk_tier(forecast(s, d), deadlines(s, d), EOL), *BASE, TIER, select="SELECT vin, months_early, CASE WHEN coalesce(months_early <= 0, true) THEN 'none' WHEN months_early <= 6 THEN 'low' WHEN months_early <= 18 THEN 'moderate' ELSE 'high' END AS tier FROM tie", columns="vin:i months_early:d tier:s")
add(
    "p06_o14_tier_summary",
    lambda s, d: de.risk_tier(forecast(s, d), deadlines(s, d), EOL).join(fx.registration(s, d), "vin").rollup("oem", "tier").agg(F.count("*").alias("n")),
    *BASE, TIER, REGISTRATION,
    select="SELECT oem, tier, count(*) AS n FROM (SELECT vin, CASE WHEN coalesce(months_early <= 0, true) THEN 'none' WHEN months_early <= 6 THEN 'low' WHEN months_early <= 18 THEN 'moderate' ELSE 'high' END AS tier FROM tie) JOIN reg USING (vin) GROUP BY ROLLUP (oem, tier)",
    columns="oem:s tier:s n:i",
)
add(
    "p08_p09_warranty_table",
    lambda s, d: de.warranty_table(now(s, d), forecast(s, d), deadlines(s, d), de.km_per_month(recent(s, d)), EOL).withColumn("status", de.status(F.col("soh_at_expiry"), EOL)),
    *BASE, PACE,
    "kn AS (SELECT vin, age AS a, soh AS p FROM now UNION ALL SELECT vin, age_months, p50 FROM fc)",
    "br AS (SELECT d.vin, deadline, max(a) FILTER (WHERE a <= deadline) AS xa, min(a) FILTER (WHERE a > deadline) AS xb, min(a) FILTER (WHERE p <= 60) AS breach_age FROM dea d JOIN kn k ON k.vin = d.vin GROUP BY 1, 2)",
    "wt AS (SELECT b.vin, deadline, breach_age, CASE WHEN xa IS NULL THEN q.p WHEN xb IS NULL THEN r.p ELSE r.p + (q.p - r.p) * (deadline - xa) / (xb - xa) END AS soh_at_expiry FROM br b LEFT JOIN kn r ON r.vin = b.vin AND r.a = xa LEFT JOIN kn q ON q.vin = b.vin AND q.a = xb)",
    select="SELECT vin, deadline, soh_at_expiry, odo + greatest(deadline - age, 0) * km_per_month AS km_at_expiry, breach_age, CASE WHEN deadline - age <= 12 THEN 'high' WHEN deadline - age <= 36 THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN soh_at_expiry < 60 THEN 'AT-RISK' WHEN soh_at_expiry < 62 THEN 'WATCH' ELSE 'OK' END AS status FROM wt JOIN now USING (vin) JOIN pac USING (vin)",
    columns="vin:i deadline:d soh_at_expiry:d km_at_expiry:e breach_age:d confidence:s status:s",
)
add(
    "p10_vehicle_index",
    lambda s, d: de.vehicle_index(recent(s, d), deadlines(s, d), eol=EOL).withColumns({"at_risk": F.col("at_risk").cast("int"), "flat": F.col("flat").cast("int")}),
    *BASE,
    "edg AS (SELECT vin, avg(soh) FILTER (WHERE u <= 3) - avg(soh) FILTER (WHERE v <= 3) AS drop, count(*) AS seen FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month) AS u, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS v FROM rec) GROUP BY vin)",
    "lif AS (SELECT n.vin, age, CASE WHEN soh <= 60 THEN 0 WHEN b < 0 THEN (sqrt(age) + (60 - soh) / b) ** 2 - age END AS months FROM now n JOIN fit f ON f.vin = n.vin)",
    select="SELECT vin, drop, months, CAST(coalesce(age + months < deadline, false) AS INT) AS at_risk, CAST(drop < 2 AS INT) AS flat, seen + 5 * greatest(drop, 0) AS score FROM edg JOIN lif USING (vin) JOIN dea USING (vin)",
    columns="vin:i drop:d months:e at_risk:i flat:i score:d",
)
add(
    "p11_cycles_to_eol",
    lambda s, d: de.cycles_to_eol(recent(s, d).withColumn("cycles", F.col("odo_max") / 90), "cycles", eol=EOL),
    *BASE,
    select="SELECT vin, CASE WHEN a - b > 0 THEN greatest(b - 60, 0) / ((a - b) / c) END AS cycles_left FROM (SELECT vin, arg_min(soh, month) AS a, arg_max(soh, month) AS b, (max(odo) - min(odo)) / 90 AS c FROM rec GROUP BY vin)",
    columns="vin:i cycles_left:e",
)
add(
    "p12_soh_at_resale",
    lambda s, d: de.soh_at_date(recent(s, d), forecast(s, d), fx.resales(s, d).select("vin", F.expr("resale_date + make_interval(0, 0, 0, cast(400 * (vin % 3 - 1) as int))").alias("date")), recent(s, d).groupBy("vin").agg(F.min("month").alias("anchor"))).select("vin", "soh", F.col("observed").cast("int").alias("observed")),
    *BASE,
    "rs AS (SELECT l_suppkey AS vin, (max(o_orderdate)::TIMESTAMP + to_days((400 * (l_suppkey % 3 - 1))::INT)) AS date FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)",
    "ask AS MATERIALIZED (SELECT r.vin, date_diff('day', anchor, date) / 30.4 AS x FROM rs r JOIN (SELECT vin, min(month) AS anchor FROM rec GROUP BY vin) a ON a.vin = r.vin)",
    "kn AS MATERIALIZED (SELECT vin, age_months AS a, soh AS p FROM rec UNION ALL SELECT vin, age_months, p50 FROM fc)",
    "br AS MATERIALIZED (SELECT d.vin, x, max(a) FILTER (WHERE a <= x) AS xa, min(a) FILTER (WHERE a > x) AS xb FROM ask d JOIN kn k ON k.vin = d.vin GROUP BY 1, 2)",
    select="SELECT b.vin, CASE WHEN xa IS NULL THEN q.p WHEN xb IS NULL THEN r.p ELSE r.p + (q.p - r.p) * (x - xa) / (xb - xa) END AS soh, CAST(x <= n.age AS INT) AS observed FROM br b JOIN now n ON n.vin = b.vin LEFT JOIN kn r ON r.vin = b.vin AND r.a = xa LEFT JOIN kn q ON q.vin = b.vin AND q.a = xb",
    columns="vin:i soh:d observed:i",
)
add("p13_start_cohorts", lambda s, d: de.start_cohorts(labelled(s, d)), SERIES, LAB, select="SELECT strftime(start, '%Y') AS cohort, round_even(date_diff('day', start, month) / 30.4, 0) AS age0, count(DISTINCT vin) AS vehicles, avg(soh) AS soh FROM (SELECT *, min(month) OVER (PARTITION BY vin) AS start FROM lab) GROUP BY 1, 2", columns="cohort:s age0:d vehicles:i soh:d")
add(
    "p14_risk_cause",
    lambda s, d: de.risk_cause(labelled(s, d), ["temp_max", "km_month", "frac_soc_high"]),
    SERIES, LAB,
    "rc AS (SELECT vin, median(temp_max) AS a, median(km_month) AS b, median(frac_soc_high) AS c FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS rn FROM lab) WHERE rn <= 6 GROUP BY vin)",
    "rz AS (SELECT vin, coalesce((a - avg(a) OVER ()) / nullif(stddev_pop(a) OVER (), 0), 0) AS a, coalesce((b - avg(b) OVER ()) / nullif(stddev_pop(b) OVER (), 0), 0) AS b, coalesce((c - avg(c) OVER ()) / nullif(stddev_pop(c) OVER (), 0), 0) AS c FROM rc)",
    select="SELECT vin, greatest(a, b, c) AS level, CASE WHEN greatest(a, b, c) < 0.5 THEN 'none' WHEN a >= b AND a >= c THEN 'temp_max' WHEN b >= c THEN 'km_month' ELSE 'frac_soc_high' END AS cause FROM rz",
    columns="vin:i level:d cause:s",
)
add(
    "p15_drop_at_distance",
    lambda s, d: de.drop_at_distance(recent(s, d), 30_001.5, ["temp_max"], odo="odo_max"),
    *BASE,
    "top AS (SELECT vin, arg_min(soh, month) AS start FROM rec GROUP BY vin HAVING max(odo) >= 30001.5)",
    "br AS (SELECT t.vin, start, max(odo) FILTER (WHERE odo <= 30001.5) AS xa, min(odo) FILTER (WHERE odo > 30001.5) AS xb, avg(temp_max) FILTER (WHERE odo <= 30001.5) AS temp_max FROM top t JOIN rec r ON r.vin = t.vin GROUP BY 1, 2)",
    select="SELECT b.vin, start - CASE WHEN xa IS NULL THEN q.soh WHEN xb IS NULL THEN p.soh ELSE p.soh + (q.soh - p.soh) * (30001.5 - xa) / (xb - xa) END AS drop, b.temp_max FROM br b LEFT JOIN rec p ON p.vin = b.vin AND p.odo = xa LEFT JOIN rec q ON q.vin = b.vin AND q.odo = xb",
    columns="vin:i drop:d temp_max:d",
)
add(
    "p16_usage_against_loss",
    lambda s, d: de.usage_against_loss(fx.series(s, d), soh="soh_raw"),
    SERIES,
    "ls AS (SELECT * FROM (SELECT vin, km_month, lag(soh_raw) OVER (PARTITION BY vin ORDER BY month) - soh_raw AS loss FROM ser) WHERE loss IS NOT NULL)",
    "lr AS (SELECT *, rank() OVER (PARTITION BY vin ORDER BY km_month) + (count(*) OVER (PARTITION BY vin, km_month) - 1) / 2 AS rx, rank() OVER (PARTITION BY vin ORDER BY loss) + (count(*) OVER (PARTITION BY vin, loss) - 1) / 2 AS ry FROM ls)",
    select="SELECT vin, corr(km_month, loss) AS pearson, regr_slope(loss, km_month) AS slope, count(*) AS n, corr(rx, ry) AS spearman FROM lr GROUP BY vin",
    columns="vin:i pearson:d slope:d n:i spearman:d",
)
