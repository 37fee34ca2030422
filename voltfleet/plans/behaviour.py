"""Queries of fleet behaviour and the pooled model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as st
from ..operators import behaviour as be
from ..operators import pooled as po
from ..operators import samples as sm
from ..operators import series as sr
from ..sources import fixtures as fx
from ..sources.shared import cut
from .base import REGISTRATION, SERIES, Book
from .quality import LAB, labelled

book = Book()
add = book.add

METRICS = {"temp_max": (20.0, 34.9), "km_month": (100.0, 4000.0), "frac_soc_high": (0.0, 1.0), "dod_mean": (0.0, 60.0)}
NAMES = list(METRICS)


def table(s: SparkSession, d: str) -> DataFrame:
    return be.behaviour_table(labelled(s, d), METRICS)


def rounded_table(s: SparkSession, d: str) -> DataFrame:
    """The table with months that meet their ranges at nine decimals, as the SQL ``ROUNDED`` has it."""
    return be.behaviour_table(labelled(s, d), METRICS, digits=be.DIGITS)


LOSS = """lra AS (SELECT vin, avg(loss) AS loss_rate FROM (SELECT vin, age_months - lag(age_months) OVER w AS gap, greatest((lag(soh) OVER w - soh) / (age_months - lag(age_months) OVER w), 0) AS loss FROM lab WINDOW w AS (PARTITION BY vin ORDER BY month)) WHERE gap > 0 AND gap <= 3 GROUP BY vin HAVING count(*) >= 2)"""
TAB = """tab AS (SELECT vin, avg(temp_max) FILTER (WHERE temp_max BETWEEN 20 AND 34.9) AS temp_max, avg(km_month) FILTER (WHERE km_month BETWEEN 100 AND 4000) AS km_month, avg(frac_soc_high) AS frac_soc_high, avg(dod_mean) FILTER (WHERE dod_mean BETWEEN 0 AND 60) AS dod_mean FROM lab GROUP BY vin),
lon AS (SELECT vin, loss_rate, metric, value FROM (SELECT * FROM tab LEFT JOIN lra USING (vin)) UNPIVOT (value FOR metric IN (temp_max, km_month, frac_soc_high, dod_mean)))"""
BASE = (SERIES, LAB, LOSS, TAB)
ROUNDED = (SERIES, LAB, LOSS, TAB.replace("FILTER (WHERE dod_mean BETWEEN", "FILTER (WHERE round(dod_mean, 9) BETWEEN").replace("FILTER (WHERE temp_max BETWEEN", "FILTER (WHERE round(temp_max, 9) BETWEEN").replace("FILTER (WHERE km_month BETWEEN", "FILTER (WHERE round(km_month, 9) BETWEEN"))
add("q01_q02_behaviour_table", rounded_table, *ROUNDED, select="SELECT * FROM tab LEFT JOIN lra USING (vin)", columns="vin:i temp_max:d km_month:d frac_soc_high:d dod_mean:d loss_rate:d")
add("q03_distributions", lambda s, d: be.distributions(table(s, d), NAMES), *BASE, select="SELECT metric, count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90 FROM lon GROUP BY metric", columns="metric:s n:i mean:d p10:d p50:d p90:d")
DRV = "drv AS (SELECT metric, corr(rx, ry) AS rho, count(*) AS n FROM (SELECT metric, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2 AS rx, rank() OVER (PARTITION BY metric ORDER BY l) + (count(*) OVER (PARTITION BY metric, l) - 1) / 2 AS ry FROM (SELECT metric, round(value, 9) AS v, round(loss_rate, 9) AS l FROM lon WHERE loss_rate IS NOT NULL)) GROUP BY metric)"
add("q04_ranked_drivers", lambda s, d: be.ranked_drivers(rounded_table(s, d), NAMES), *ROUNDED, DRV, select="SELECT * FROM drv", columns="metric:s rho:d n:i")
PCT = "pct AS (SELECT vin, metric, value, (rank() OVER (PARTITION BY metric ORDER BY round(value, 9)) - 1) / count(*) OVER (PARTITION BY metric) * 100 AS pct, (value - avg(value) OVER (PARTITION BY metric)) / stddev_samp(value) OVER (PARTITION BY metric) AS z FROM lon)"
add("q07_percentiles", lambda s, d: be.percentiles(rounded_table(s, d), NAMES), *ROUNDED, PCT, select="SELECT *, CASE WHEN pct >= 80 THEN 'harsh' WHEN pct >= 60 THEN 'above average' WHEN pct >= 40 THEN 'typical' ELSE 'gentle' END AS verdict FROM pct", columns="vin:i metric:s value:d pct:d z:d verdict:s")
add("q08_care_scores", lambda s, d: be.care_scores(be.percentiles(rounded_table(s, d), NAMES)), *ROUNDED, PCT, select="SELECT vin, score, CASE WHEN round(score, 9) >= 72 THEN 'Gentle' WHEN round(score, 9) >= 50 THEN 'Moderate' WHEN round(score, 9) >= 35 THEN 'Firm' ELSE 'Hard' END AS grade FROM (SELECT vin, avg(100 - pct) AS score FROM pct GROUP BY vin)", columns="vin:i score:d grade:s")
add(
    "q09_levers",
    lambda s, d: be.levers(be.percentiles(rounded_table(s, d), NAMES), be.ranked_drivers(rounded_table(s, d), NAMES)),
    *ROUNDED, PCT, DRV,
    select="SELECT * FROM (SELECT vin, metric, severity, row_number() OVER (PARTITION BY vin ORDER BY round(severity, 9) DESC, metric) AS place FROM (SELECT vin, metric, (pct - 50) / 50 * (0.3 + abs(rho)) AS severity FROM pct JOIN drv USING (metric) WHERE pct >= 60)) WHERE place <= 3",
    columns="vin:i place:i metric:s severity:d",
)
add("q05_segments", lambda s, d: be.segments(table(s, d), NAMES))
add("q06_segment_profiles", lambda s, d: be.segment_profiles(be.segments(table(s, d), NAMES), NAMES))
add(
    "q11_findings",
    lambda s, d: be.findings(table(s, d), "temp_max", 32.0),
    *BASE,
    select="SELECT avg(loss_rate) FILTER (WHERE temp_max >= c) / avg(loss_rate) FILTER (WHERE temp_max < c) AS ratio, avg(CAST(temp_max > 32 AS DOUBLE)) AS share_above FROM (SELECT * FROM tab LEFT JOIN lra USING (vin)), (SELECT quantile_cont(temp_max, 0.9) AS c FROM tab)",
    columns="ratio:d share_above:d",
)
add(
    "r01_robust_km_month",
    lambda s, d: po.robust_km_month(fx.series(s, d).withColumn("odo_max", F.sum("km_month").over(sr.so_far()))),
    SERIES,
    "od AS (SELECT vin, age_months, sum(km_month) OVER (PARTITION BY vin ORDER BY month) AS odo FROM ser)",
    select="SELECT vin, CASE WHEN (max(odo) - min(odo)) / (max(age_months) - min(age_months)) BETWEEN 10 AND 8000 THEN (max(odo) - min(odo)) / (max(age_months) - min(age_months)) END AS km_month FROM od GROUP BY vin",
    columns="vin:i km_month:d",
)


def statistics(s: SparkSession, d: str) -> DataFrame:
    """R2 and R3: statistics of vehicles seen long enough, with standardised behaviour."""
    seen = sr.group_at_least(labelled(s, d), 5)
    design = sm.standardise(table(s, d).fillna(0.0, NAMES), ["temp_max", "km_month"]).select("vin", F.lit(1.0).alias("one"), "z_temp_max", "z_km_month")
    return po.sufficient_statistics(seen).join(design, "vin")


DESIGN = ["one", "z_temp_max", "z_km_month"]
AGES = [6.0, 12.0, 24.0, 36.0, 60.0]

STATS = """dsg AS (SELECT vin, 1.0::DOUBLE AS x0, CASE WHEN stddev_pop(a) OVER () > 0 THEN (a - avg(a) OVER ()) / stddev_pop(a) OVER () ELSE 0 END AS x1, CASE WHEN stddev_pop(b) OVER () > 0 THEN (b - avg(b) OVER ()) / stddev_pop(b) OVER () ELSE 0 END AS x2
  FROM (SELECT vin, coalesce(temp_max, 0) AS a, coalesce(km_month, 0) AS b FROM tab)),
sta AS MATERIALIZED (SELECT *, ('0x' || substr(md5(vin::VARCHAR || ':0'), 1, 8))::BIGINT % 5 AS fold FROM (SELECT vin, count(*)::DOUBLE AS n, sum(age_months ** 2) AS saa, sum(age_months * (soh - 100)) AS say, sum((soh - 100) ** 2) AS syy FROM lab GROUP BY vin HAVING count(*) >= 5) JOIN dsg USING (vin))"""
MU = "b0 * x0 + b1 * x1 + b2 * x2"
SPREAD = "sv * (i00 * x0 ** 2 + i11 * x1 ** 2 + i22 * x2 ** 2 + 2 * (i01 * x0 * x1 + i02 * x0 * x2 + i12 * x1 * x2))"


def em(rounds: int, folds: int = 1) -> list[str]:
    """Expectation-maximisation of ``pooled.fit`` by recursion: est has a row for each group g, which leaves out fold g if there are several."""
    rows = "sta" if folds == 1 else "sta WHERE fold <> g"
    return [
        f"trn AS MATERIALIZED (SELECT g, sta.* FROM generate_series(0, {folds - 1}) AS s(g), {rows})",
        "grm AS (SELECT g, sum(x0 * x0) + 1e-9 AS a, sum(x0 * x1) AS b, sum(x0 * x2) AS c, sum(x1 * x1) + 1e-9 AS d, sum(x1 * x2) AS e, sum(x2 * x2) + 1e-9 AS f FROM trn GROUP BY g)",
        "inv AS MATERIALIZED (SELECT *, (d * f - e * e) / det AS i00, (c * e - b * f) / det AS i01, (b * e - c * d) / det AS i02, (a * f - c * c) / det AS i11, (b * c - a * e) / det AS i12, (a * d - b * b) / det AS i22 FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM grm))",
        f"""emi AS (SELECT g, 0 AS k, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.1::DOUBLE AS sv, 4.0::DOUBLE AS nv FROM inv UNION ALL
  SELECT g, k + 1, b0, b1, b2, greatest((bb - 2 * (b0 * y0 + b1 * y1 + b2 * y2) + (a - 1e-9) * b0 * b0 + (d - 1e-9) * b1 * b1 + (f - 1e-9) * b2 * b2 + 2 * (b * b0 * b1 + c * b0 * b2 + e * b1 * b2)) / vehicles, 1e-6), greatest(error / n, 1e-6)
  FROM (SELECT *, i00 * y0 + i01 * y1 + i02 * y2 AS b0, i01 * y0 + i11 * y1 + i12 * y2 AS b1, i02 * y0 + i12 * y1 + i22 * y2 AS b2
    FROM (SELECT g, k, sum(x0 * w) AS y0, sum(x1 * w) AS y1, sum(x2 * w) AS y2, sum(syy - 2 * w * say + (w * w + v) * saa) AS error, sum(n) AS n, count(*) AS vehicles, sum(w * w + v) AS bb
      FROM (SELECT t.*, k, (say / nv + ({MU}) / sv) / (saa / nv + 1 / sv) AS w, 1 / (saa / nv + 1 / sv) AS v FROM emi JOIN trn t USING (g) WHERE k < {rounds}) GROUP BY g, k) JOIN inv USING (g)))""",
        f"est AS MATERIALIZED (SELECT * FROM emi JOIN inv USING (g) WHERE k = {rounds})",
    ]


CURVE = f"""crv AS (SELECT vin, age, p50, parameter_sd, vehicle_sd, p50 - 1.2815515655446004 * sd AS p10, p50 + 1.2815515655446004 * sd AS p90 FROM (SELECT vin, age, 100 + ({MU}) * age AS p50, age * sqrt({SPREAD}) AS parameter_sd, age * sqrt(sv) AS vehicle_sd, age * sqrt({SPREAD} + sv) AS sd
  FROM sta, est, (SELECT unnest({AGES}::DOUBLE[]) AS age)))"""
HELD = f"""srm AS (SELECT g, oem, avg(say / saa) AS source_mean FROM trn JOIN reg USING (vin) GROUP BY 1, 2),
hel AS (SELECT vin, r.oem, fold, say / saa AS rate, {MU} AS predicted, source_mean FROM sta JOIN reg r USING (vin) JOIN est ON est.g = fold LEFT JOIN srm ON srm.g = fold AND srm.oem = r.oem)"""
add("r02_r03_sufficient_statistics", lambda s, d: po.sufficient_statistics(sr.group_at_least(labelled(s, d), 5)), SERIES, LAB, select="SELECT vin, count(*)::DOUBLE AS n, sum(age_months ** 2) AS saa, sum(age_months * (soh - 100)) AS say, sum((soh - 100) ** 2) AS syy FROM lab GROUP BY vin HAVING count(*) >= 5", columns="vin:i n:d saa:e say:e syy:e")
add(
    "r04_pooled_slopes",
    lambda s, d: (lambda t: po.slopes(t, po.fit(t, DESIGN, 12)).select("vin", "predicted", "slope"))(statistics(s, d)),
    *BASE, STATS, *em(12),
    select=f"SELECT vin, {MU} AS predicted, (say / nv + ({MU}) / sv) / (saa / nv + 1 / sv) AS slope FROM sta JOIN est ON g = 0",
    columns="vin:i predicted:d slope:d",
)
add(
    "r05_r09_predictive_curves",
    lambda s, d: (lambda t: po.predictive_curve(t, po.fit(t, DESIGN, 12), AGES))(statistics(s, d)),
    *BASE, STATS, *em(12), CURVE,
    select="SELECT * FROM crv",
    columns="vin:i age:d p10:d p50:d p90:d parameter_sd:d vehicle_sd:d",
)
add(
    "r06_effects",
    lambda s, d: po.effects(s, po.fit(statistics(s, d), DESIGN, 12)),
    *BASE, STATS, *em(12),
    "eff AS (SELECT unnest(['one', 'z_temp_max', 'z_km_month']) AS name, unnest([b0, b1, b2]) AS effect, 1.96 * sqrt(sv * unnest([i00, i11, i22])) AS half FROM est)",
    select="SELECT name, effect, effect - half AS low, effect + half AS high FROM eff",
    columns="name:s effect:d low:d high:d",
)


def held_out_errors(s: SparkSession, d: str) -> DataFrame:
    """R8 and R10: five folds by vehicle; error of the rate from behaviour, and of the source's mean rate."""
    rows = statistics(s, d).join(fx.registration(s, d).select("vin", "oem"), "vin").withColumns({"fold": sm.fold_of(F.col("vin"), 5), "rate": F.col("say") / F.col("saa")})
    rows = cut(rows)
    out = None
    for k in range(5):
        train, test = rows.where(F.col("fold") != k), rows.where(F.col("fold") == k)
        model = po.fit(train, DESIGN, 8)
        base = train.groupBy("oem").agg(F.avg("rate").alias("source_mean"))
        part = po.slopes(test, model).join(base, "oem", "left").select("vin", "oem", "fold", "rate", "predicted", "source_mean")
        out = part if out is None else out.unionByName(part)
    return out


add("r08_r10_held_out_rates", held_out_errors, *BASE, STATS, REGISTRATION, *em(8, 5), HELD, select="SELECT * FROM hel", columns="vin:i oem:s fold:i rate:d predicted:d source_mean:d")
add("r07_usage_and_rate_by_source", lambda s, d: statistics(s, d).join(fx.registration(s, d), "vin").groupBy("oem").agg(F.corr("z_km_month", F.col("say") / F.col("saa")).alias("r"), F.count("*").alias("n")).where("n >= 8"), *BASE, REGISTRATION,
    "kz AS (SELECT vin, coalesce(km_month, 0) AS k FROM tab)",
    select="SELECT oem, corr(k, rate) AS r, count(*) AS n FROM kz JOIN (SELECT vin, sum(age_months * (soh - 100)) / sum(age_months ** 2) AS rate FROM lab GROUP BY vin) USING (vin) JOIN reg USING (vin) GROUP BY oem HAVING count(*) >= 8", columns="oem:s r:d n:i")
add(
    "r11_truncated_curves",
    lambda s, d: (lambda t: po.truncate_at_age(po.predictive_curve(t, po.fit(t, DESIGN, 10), AGES), fx.series(s, d).groupBy("vin").agg(F.max("age_months").alias("age_months")), fx.series(s, d).groupBy("vin").agg(F.min("month").alias("anchor"))))(statistics(s, d)),
    *BASE, STATS, *em(10), CURVE,
    "own AS (SELECT vin, max(age_months) AS oldest, min(month) AS anchor FROM ser GROUP BY vin)",
    select="SELECT c.*, anchor + to_months(round_even(age, 0)::INT) AS month FROM crv c JOIN own o ON o.vin = c.vin AND age <= oldest",
    columns="vin:i age:d p10:d p50:d p90:d parameter_sd:d vehicle_sd:d month:t",
)
add(
    "r10_light_and_heavy_usage",
    lambda s, d: st.errors(held_out_errors(s, d), "predicted", "rate", ("oem",)),
    *BASE, STATS, REGISTRATION, *em(8, 5), HELD,
    select="SELECT oem, sqrt(avg((predicted - rate) ** 2)) AS rmse, avg(abs(predicted - rate)) AS mae, avg(predicted - rate) AS bias, count(*) AS n FROM hel GROUP BY oem",
    columns="oem:s rmse:d mae:d bias:d n:i",
)
