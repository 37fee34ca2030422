"""Queries of data quality, curation and training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats as st
from ..operators import quality as q
from ..operators import samples as sm
from ..operators import series as sr
from ..sources import fixtures as fx
from .base import REGISTRATION, SERIES, Book
from .joins import THEIL
from .series import pava

book = Book()
add = book.add


def labelled(s: SparkSession, d: str) -> DataFrame:
    """Series with soh, its running minimum."""
    return fx.series(s, d).withColumn("soh", sr.running_min("soh_raw"))


LAB = "lab AS (SELECT *, min(soh_raw) OVER (PARTITION BY vin ORDER BY month) AS soh FROM ser)"
MAN = """man0 AS (SELECT vin, count(*) AS months, max(age_months) - min(age_months) AS span_months, arg_min(soh, month) - arg_max(soh, month) AS soh_drop, arg_max(soh, month) AS soh_last, median(n) AS obs_per_month FROM lab GROUP BY vin),
man1 AS (SELECT *, concat_ws(';', CASE WHEN months < 83 THEN '<83_valid_months' END, CASE WHEN span_months < 80.5 THEN '<80mo_span' END) AS thin, soh_drop >= 42 OR soh_last <= 55 AS proven FROM man0),
man AS (SELECT *, CASE WHEN thin <> '' AND proven THEN 'proven-degrader(overrides:' || thin || ')' ELSE thin END AS reasons, CASE WHEN soh_drop >= 35 THEN 'degrader' ELSE 'flat' END AS vehicle_class, CASE WHEN thin = '' OR proven THEN 'trainable' ELSE 'thin' END AS quality FROM man1)"""


def verdicts(s: SparkSession, d: str) -> DataFrame:
    return q.manifest(labelled(s, d), min_months=83, min_span=80.5, exempt_drop=42.0, degrader_drop=35.0, eol=55.0)


add("l01_manifest", verdicts, SERIES, LAB, MAN, select="SELECT * FROM man", columns="vin:i months:i span_months:d soh_drop:d obs_per_month:d reasons:s vehicle_class:s quality:s")
add("l02_quality_gate", lambda s, d: q.trainable(labelled(s, d), verdicts(s, d)).select("vin", "month"), SERIES, LAB, MAN, select="SELECT vin, month FROM lab WHERE vin NOT IN (SELECT vin FROM man WHERE quality = 'thin')", columns="vin:i month:t")
add("l02_exclusion_log", lambda s, d: q.excluded(verdicts(s, d)), SERIES, LAB, MAN, select="SELECT vin, reasons FROM man WHERE quality = 'thin'", columns="vin:i reasons:s")
add("l03_thick_months", lambda s, d: q.thick_months(fx.series(s, d).withColumn("n_sessions", F.col("n") - 6), min_months=50).select("vin", "month"), SERIES, select="SELECT vin, month FROM (SELECT *, count(*) OVER (PARTITION BY vin) AS c FROM ser WHERE n > 6) WHERE c >= 50", columns="vin:i month:t")
AUD = """aud0 AS (SELECT *, lag(soh) OVER (PARTITION BY vin ORDER BY month) - soh AS step, lag(soh) OVER (PARTITION BY vin ORDER BY month DESC) AS nxt FROM lab),
aud1 AS (SELECT *, sum(CAST(coalesce(soh <> nxt, false) AS INT)) OVER (PARTITION BY vin ORDER BY month DESC) AS seen FROM aud0),
aud2 AS (SELECT vin, max(step) AS worst, max(soh_raw - soh) AS gap, min(soh) AS low, arg_min(soh, month) AS first, arg_max(soh, month) AS last, count(*) FILTER (WHERE seen = 0) AS run FROM aud1 GROUP BY vin),
aud AS (SELECT *, coalesce(worst >= 6, false) AS is_cliff, run >= 5 AND last = low AND first - last >= 3 AS is_stuck, gap >= 2 AS is_floor, low <= 80 AS aged FROM aud2)"""
add(
    "l04_artifact_audit",
    lambda s, d: q.audit(labelled(s, d)).withColumns({f: F.col(f).cast("int") for f in ("is_cliff", "is_stuck", "is_floor", "tainted")}),
    SERIES, LAB, AUD,
    select="SELECT vin, run, worst, gap, CAST(is_cliff AS INT) AS is_cliff, CAST(is_stuck AS INT) AS is_stuck, CAST(is_floor AS INT) AS is_floor, CAST(is_cliff OR is_stuck OR is_floor AS INT) AS tainted FROM aud",
    columns="vin:i run:i worst:d gap:d is_cliff:i is_stuck:i is_floor:i tainted:i",
)
add("l05_audit_summary", lambda s, d: q.audit_summary(q.audit(labelled(s, d))), SERIES, LAB, AUD, select="SELECT count(*) AS vehicles, count(*) FILTER (WHERE is_cliff) AS is_cliff, count(*) FILTER (WHERE is_stuck) AS is_stuck, count(*) FILTER (WHERE aged) AS aged FROM aud", columns="vehicles:i is_cliff:i is_stuck:i aged:i")
add(
    "l06_curate",
    lambda s, d: q.curate(fx.series(s, d), "soh_raw", eol=79.0, warranty_months=120.0),
    SERIES,
    "cu0 AS (SELECT *, sqrt(greatest(age_months, 0)) AS root FROM ser)",
    "cu1 AS (SELECT a.vin, median((b.soh_raw - a.soh_raw) / (b.root - a.root)) AS slope FROM cu0 a JOIN cu0 b ON a.vin = b.vin AND b.root > a.root GROUP BY a.vin)",
    "cu2 AS (SELECT c.vin, slope, median(soh_raw - slope * root) AS cut, median(soh_raw) AS mid, count(*) AS months, min(age_months) AS age0, max(age_months) AS age, min(soh_raw) AS low FROM cu0 c JOIN cu1 t ON t.vin = c.vin GROUP BY 1, 2)",
    "cu3 AS (SELECT *, CASE WHEN slope > 0 THEN 0 ELSE slope END AS b, CASE WHEN slope > 0 THEN mid ELSE cut END AS c FROM cu2)",
    "cu4 AS (SELECT *, c + b * sqrt(120.0) AS projected, b * (sqrt(age0) - sqrt(age)) AS decline, low <= 79 OR age >= 72 AS near FROM cu3)",
    select="""SELECT vin, projected, decline, CASE WHEN months < 6 OR age - age0 < 6 THEN 'EXCLUDED' WHEN projected >= 79 AND near AND decline >= 3 THEN 'GRACEFUL' WHEN projected >= 79 AND decline < 2 THEN 'FLAT' WHEN projected >= 79 THEN 'PROBABLE_OOR' ELSE 'AT_RISK' END AS bucket FROM cu4""",
    columns="vin:i projected:d decline:d bucket:s",
)
INL = """inl0 AS (SELECT *, median(soh_raw) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS lft FROM ser),
inl AS (SELECT *, NOT coalesce(lft > 2 AND later > soh_raw + 3.5, false) AND NOT (100 - soh_raw) / greatest(age_months / 12, 0.25) > 10 AS inlier FROM inl0)"""
add("l07_recovery_inliers", lambda s, d: q.recovery_inliers(fx.series(s, d)).select("vin", "month", F.col("inlier").cast("int").alias("inlier")), SERIES, INL, select="SELECT vin, month, CAST(inlier AS INT) AS inlier FROM inl", columns="vin:i month:t inlier:i")
add(
    "l08_clean_label",
    lambda s, d: q.clean_label(fx.series(s, d)),
    SERIES, INL,
    "num AS (SELECT vin, month, age_months, soh_raw, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM inl WHERE inlier)",
    pava("num", "soh_raw", "iso"),
    "kno AS (SELECT vin, age_months AS a, fit AS f, count(*) OVER (PARTITION BY vin) AS kept FROM num JOIN iso USING (vin, rn))",
    "brk AS (SELECT i.vin, i.month, i.age_months AS x, i.soh_raw, max(kept) AS kept, max(a) FILTER (WHERE a <= i.age_months) AS xa, min(a) FILTER (WHERE a > i.age_months) AS xb FROM inl i LEFT JOIN kno k ON k.vin = i.vin GROUP BY 1, 2, 3, 4)",
    select="SELECT b.vin, b.month, CASE WHEN coalesce(b.kept, 0) < 3 THEN soh_raw WHEN xa IS NULL THEN q.f WHEN xb IS NULL THEN p.f ELSE p.f + (q.f - p.f) * (x - xa) / (xb - xa) END AS soh FROM brk b LEFT JOIN kno p ON p.vin = b.vin AND p.a = xa LEFT JOIN kno q ON q.vin = b.vin AND q.a = xb",
    columns="vin:i month:t soh:d",
)
add(
    "l09_confirmed_decliners",
    lambda s, d: q.confirmed_decliners(st.decline_per_year(fx.series(s, d), "soh_raw"), st.decline_per_year(fx.series(s, d).where("n >= 6"), "soh_raw"), st.decline_per_year(fx.series(s, d), "cap_raw"), 3.8),
    SERIES, THEIL, THEIL.replace("ts0", "tb0").replace("ts AS", "tb AS").replace("ts t", "tb t").replace("FROM ser a JOIN ser b", "FROM (SELECT * FROM ser WHERE n >= 6) a JOIN (SELECT * FROM ser WHERE n >= 6) b").replace("FROM ser s", "FROM (SELECT * FROM ser WHERE n >= 6) s"),
    THEIL.replace("ts0", "tc0").replace("ts AS", "tc AS").replace("ts t", "tc t").replace("soh_raw", "cap_raw"),
    select="SELECT vin FROM ts JOIN tb USING (vin) JOIN tc USING (vin) WHERE -12 * ts.slope >= 3.8 OR (-12 * tb.slope >= 3.8 AND -12 * tc.slope >= 3.8)",
    columns="vin:i",
)
add("l10_diagnose", lambda s, d: q.diagnose(labelled(s, d), "soh_raw", flat=40.0, pinned=60.0), SERIES, select="SELECT (SELECT avg(CAST(r < 40 AS DOUBLE)) FROM (SELECT max(soh_raw) - min(soh_raw) AS r FROM ser GROUP BY vin)) AS flat_share, (SELECT avg(CAST(l >= 60 AS DOUBLE)) FROM (SELECT min(soh_raw) AS l FROM ser GROUP BY vin)) AS pinned_share, (SELECT avg(CAST(soh_raw >= 100 AS DOUBLE)) FROM ser) AS capped_share", columns="flat_share:d pinned_share:d capped_share:d")
add("l11_flatness", lambda s, d: q.flatness(labelled(s, d)).withColumn("flat", F.col("flat").cast("int")), SERIES, LAB, select="SELECT vin, avg(x) AS flat_share, CAST(avg(x) > 0.8 AS INT) AS flat FROM (SELECT vin, CAST(abs(soh - lag(soh) OVER (PARTITION BY vin ORDER BY month)) < 0.05 AS DOUBLE) AS x FROM lab) GROUP BY vin", columns="vin:i flat_share:d flat:i")
add(
    "l12_o06_method_agreement",
    lambda s, d: labelled(s, d).groupBy("vin").agg(F.corr("soh", "soh_raw").alias("r"), F.sqrt(F.avg(F.pow(F.col("soh") - F.col("soh_raw"), 2.0))).alias("rmse"), F.count("*").alias("n")).where("n >= 3"),
    SERIES, LAB,
    select="SELECT vin, corr(soh, soh_raw) AS r, sqrt(avg((soh - soh_raw) ** 2)) AS rmse, count(*) AS n FROM lab GROUP BY vin HAVING count(*) >= 3",
    columns="vin:i r:d rmse:d n:i",
)
add("l13_quality_tier", lambda s, d: q.quality_tier(fx.series(s, d).withColumn("garbage", (F.col("n") % 9 == 0).cast("double"))), SERIES, select="""SELECT vin, months, noise, CASE WHEN months >= 12 AND support >= 7 AND noise < 8 AND garbage < 0.05 THEN 'HIGH' WHEN months >= 6 AND support >= 4 AND garbage < 0.2 THEN 'MED' ELSE 'LOW' END AS tier
  FROM (SELECT vin, count(*) AS months, avg(n) AS support, stddev_samp(soh_raw) / avg(soh_raw) * 100 AS noise, avg(CAST(n % 9 = 0 AS DOUBLE)) AS garbage FROM ser GROUP BY vin)""", columns="vin:i months:i noise:d tier:s")  # fmt: skip
add(
    "l14_impute_age",
    lambda s, d: q.impute_age(fx.series(s, d), fx.registration(s, d)).select("vin", "month", "age_months", F.col("imputed").cast("int").alias("imputed")),
    SERIES, REGISTRATION,
    "gap AS (SELECT f.vin, first_month, date_diff('day', regd_date, first_month) / 30.4 AS gap FROM (SELECT vin, min(month) AS first_month FROM ser GROUP BY vin) f LEFT JOIN reg USING (vin))",
    select="SELECT vin, month, date_diff('day', first_month, month) / 30.4 + coalesce(gap, (SELECT median(gap) FROM gap)) AS age_months, CAST(gap IS NULL AS INT) AS imputed FROM ser JOIN gap USING (vin)",
    columns="vin:i month:t age_months:d imputed:i",
)
add("l15_registration_from_age", lambda s, d: q.registration_from_age(fx.series(s, d).withColumn("age_months", F.col("age_months") + F.col("vin") % 7 + 0.2)), SERIES, select="SELECT vin, (min(month) - to_months((vin % 7)::INT))::TIMESTAMP AS regd_date FROM ser GROUP BY vin", columns="vin:i regd_date:t")
add("l16_swap_target", lambda s, d: q.swap_target(labelled(s, d), fx.series(s, d).where("n >= 9").select("vin", "month", "cap_raw"), "cap_raw", 20).select("vin", "month", "soh"), SERIES, select="SELECT vin, month, cap_raw AS soh FROM (SELECT *, count(*) OVER (PARTITION BY vin) AS c FROM ser WHERE n >= 9) WHERE c >= 20", columns="vin:i month:t soh:d")
add(
    "l17_stability_index",
    lambda s, d: q.stability_index(fx.series(s, d).where("age_months < 30"), fx.series(s, d).where("age_months >= 30"), "cap_raw", 90.0, 160.0),
    SERIES,
    "hi AS (SELECT CASE WHEN cap_raw < 90 THEN 0 WHEN cap_raw >= 160 THEN 11 ELSE floor((cap_raw - 90) / 7)::INT + 1 END AS b, age_months < 30 AS old FROM ser)",
    "hc AS (SELECT b, count(*) FILTER (WHERE old) AS ka, count(*) FILTER (WHERE NOT old) AS kb, (SELECT count(*) FROM hi WHERE old) AS na, (SELECT count(*) FROM hi WHERE NOT old) AS nb FROM hi GROUP BY b)",
    "hs AS (SELECT CASE WHEN ka = 0 THEN 0.5 ELSE ka END / na AS a, CASE WHEN kb = 0 THEN 0.5 ELSE kb END / nb AS b FROM hc)",
    select="SELECT sum((b - a) * ln(b / a)) AS psi, count(*) AS buckets FROM hs",
    columns="psi:d buckets:i",
)

TRA = "tra AS (SELECT * FROM (SELECT *, lead(soh) OVER w AS next_soh, lead(age_months) OVER w - age_months AS gap FROM lab WINDOW w AS (PARTITION BY vin ORDER BY month)) WHERE gap > 0 AND gap <= 3)"
add(
    "m01_m02_transitions",
    lambda s, d: sm.transitions(labelled(s, d), glitch=6.0),
    SERIES, LAB, TRA,
    select="SELECT vin, month, gap, loss, 1 + least(loss, 5) AS weight FROM (SELECT *, CASE WHEN abs(soh - next_soh) > 6 THEN least(greatest((soh - next_soh) / gap, 0), 4.0) ELSE greatest((soh - next_soh) / gap, 0) END AS loss FROM tra)",
    columns="vin:i month:t gap:d loss:d weight:d",
)
add(
    "m03_trajectory_samples",
    lambda s, d: sm.trajectory_samples(labelled(s, d), ["temp_max"], most=8).groupBy("vin").agg(F.count("*").alias("n"), F.avg("horizon").alias("horizon"), F.avg("cum_loss").alias("cum_loss"), F.avg("recent_temp_max").alias("temp"), F.avg("recent_loss").alias("recent_loss")),
    SERIES, LAB,
    "rw AS (SELECT *, row_number() OVER w AS rn, median(temp_max) OVER (PARTITION BY vin ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS temp, CASE WHEN count(*) OVER w8 >= 3 AND age_months > first_value(age_months) OVER w8 THEN greatest((first_value(soh) OVER w8 - soh) / (age_months - first_value(age_months) OVER w8), 0) ELSE 0 END AS rl FROM lab WINDOW w AS (PARTITION BY vin ORDER BY month), w8 AS (PARTITION BY vin ORDER BY month ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))",
    select="SELECT a.vin, count(*) AS n, avg(b.age_months - a.age_months) AS horizon, avg(greatest(a.soh - b.soh, 0)) AS cum_loss, avg(a.temp) AS temp, avg(a.rl) AS recent_loss FROM rw a JOIN rw b ON a.vin = b.vin AND b.rn > a.rn AND b.rn - a.rn <= 8 WHERE a.rn >= 4 GROUP BY a.vin",
    columns="vin:i n:i horizon:d cum_loss:d temp:d recent_loss:d",
)


def kinds(s: SparkSession, d: str) -> DataFrame:
    return labelled(s, d).groupBy("vin").agg(F.when(F.max("soh") - F.min("soh") >= 33, "degrader").otherwise("flat").alias("kind"))


KINDS = "kin AS (SELECT vin, CASE WHEN max(soh) - min(soh) >= 33 THEN 'degrader' ELSE 'flat' END AS kind FROM lab GROUP BY vin)"
add(
    "m04_m05_split",
    lambda s, d: sm.split(kinds(s, d), seed=3, forced=kinds(s, d).where("vin % 10 = 0")),
    SERIES, LAB, KINDS,
    "rnk AS (SELECT *, (row_number() OVER (PARTITION BY kind ORDER BY md5(vin::VARCHAR || ':3'), vin) - 1) / count(*) OVER (PARTITION BY kind) AS r FROM kin WHERE vin % 10 <> 0)",
    select="SELECT vin, kind, CASE WHEN r < 0.6 THEN 'train' WHEN r < 0.8 THEN 'val' ELSE 'test' END AS part FROM rnk UNION ALL SELECT vin, kind, 'train' FROM kin WHERE vin % 10 = 0",
    columns="vin:i kind:s part:s",
)
add("m06_populations", lambda s, d: sm.populations(labelled(s, d), drop=33.0, eol=65.0).select("vin", F.col("degrader").cast("int").alias("degrader"), F.col("safe").cast("int").alias("safe")), SERIES, LAB, select="SELECT vin, CAST(arg_min(soh, month) - arg_max(soh, month) >= 33 AS INT) AS degrader, CAST(min(soh) > 65 AS INT) AS safe FROM lab GROUP BY vin", columns="vin:i degrader:i safe:i")
add("m07_tail_vehicles", lambda s, d: sm.tail_vehicles(fx.series(s, d)), SERIES, "vv AS (SELECT DISTINCT vin FROM ser)", select="SELECT vin FROM (SELECT vin, row_number() OVER (ORDER BY vin) - 1 AS r, count(*) OVER () AS n FROM vv) WHERE r >= floor(n * 0.8)", columns="vin:i")
HIST = "his AS (SELECT *, rn <= cut AS past FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn, count(*) OVER (PARTITION BY vin) AS months, greatest(floor(count(*) OVER (PARTITION BY vin) * 0.6), 4) AS cut FROM lab) WHERE months > cut)"
add("m08_history", lambda s, d: sm.history(labelled(s, d)).select("vin", "month", F.col("past").cast("int").alias("past")), SERIES, LAB, HIST, select="SELECT vin, month, CAST(past AS INT) AS past FROM his", columns="vin:i month:t past:i")
add("m09_folds", lambda s, d: fx.registration(s, d).select("vin", sm.fold_of(F.col("vin"), 5).alias("fold")), REGISTRATION, select="SELECT vin, ('0x' || substr(md5(vin::VARCHAR || ':0'), 1, 8))::BIGINT % 5 AS fold FROM reg", columns="vin:i fold:i")
add("m10_standardise", lambda s, d: sm.standardise(fx.series(s, d), ["temp_max", "km_month"]), SERIES, select="SELECT vin, month, (temp_max - avg(temp_max) OVER ()) / stddev_pop(temp_max) OVER () AS z_temp_max, (km_month - avg(km_month) OVER ()) / stddev_pop(km_month) OVER () AS z_km_month FROM ser", columns="vin:i month:t z_temp_max:d z_km_month:d")
add("m11_source_dummies", lambda s, d: sm.source_dummies(fx.registration(s, d), "oem", ["ASIA", "MIDDLE EAST"]), REGISTRATION, select="SELECT vin, CAST(oem = 'ASIA' AS DOUBLE) AS is_asia, CAST(oem = 'MIDDLE EAST' AS DOUBLE) AS is_middle_east FROM reg", columns="vin:i is_asia:d is_middle_east:d")
