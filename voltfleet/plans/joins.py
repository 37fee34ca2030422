"""Queries of joins, rankings, sets, scalars and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bounded as bd
from ..functions import scalars as sc
from ..functions import selection as sel
from ..functions import stats as st
from ..operators import joins as j
from ..operators import series as sr
from ..sources import fixtures as fx
from .base import REGISTRATION, SERIES, Book

book = Book()
add = book.add

add("g01_g04_left_and_semi_joins", lambda s, d: fx.series(s, d).join(fx.registration(s, d).where("oem = 'ASIA'").select("vin"), "vin", "left_semi").join(fx.registration(s, d), "vin", "left").select("vin", "month", "regd_date"), SERIES, REGISTRATION, select="SELECT vin, month, regd_date FROM ser JOIN reg USING (vin) WHERE oem = 'ASIA'", columns="vin:i month:t regd_date:t")
add("g07_anti_join", lambda s, d: fx.series(s, d).join(fx.registration(s, d).where("regd_date is null").select("vin"), "vin", "left_anti").select("vin", "month"), SERIES, REGISTRATION, select="SELECT vin, month FROM ser WHERE vin NOT IN (SELECT vin FROM reg WHERE regd_date IS NULL)", columns="vin:i month:t")
add("g03_full_outer_join", lambda s, d: fx.series(s, d).where("n >= 8").select("vin", "month", F.col("soh_raw").alias("a")).join(fx.series(s, d).where("n <= 9").select("vin", "month", F.col("cap_raw").alias("b")), ["vin", "month"], "full"), SERIES, select="SELECT vin, month, CASE WHEN n >= 8 THEN soh_raw END AS a, CASE WHEN n <= 9 THEN cap_raw END AS b FROM ser", columns="vin:i month:t a:d b:d")
add(
    "g09_g10_g11_later_pairs",
    lambda s, d: j.later_pairs(fx.series(s, d).select("vin", "month", "age_months", "soh_raw"), "month", most=6).groupBy("vin").agg(F.count("*").alias("n"), F.avg(F.col("soh_raw") - F.col("later_soh_raw")).alias("loss")),
    SERIES,
    "rows AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month) AS rn FROM ser)",
    select="SELECT a.vin, count(*) AS n, avg(a.soh_raw - b.soh_raw) AS loss FROM rows a JOIN rows b ON a.vin = b.vin AND b.rn > a.rn AND b.rn - a.rn <= 6 GROUP BY a.vin",
    columns="vin:i n:i loss:d",
)
add(
    "g12_interpolate",
    lambda s, d: j.interpolate(fx.series(s, d).select("vin", "age_months", "soh_raw"), fx.registration(s, d).select("vin", F.explode(F.array(F.lit(-1.0), F.lit(6.5), F.lit(30.25), F.lit(500.0))).alias("age_months")), "age_months", "soh_raw"),
    SERIES,
    "pr AS (SELECT vin, unnest([-1.0, 6.5, 30.25, 500.0]) AS x FROM (SELECT DISTINCT vin FROM ser))",
    "br AS (SELECT p.vin, p.x, max(s.age_months) FILTER (WHERE s.age_months <= p.x) AS xa, min(s.age_months) FILTER (WHERE s.age_months > p.x) AS xb FROM pr p JOIN ser s ON s.vin = p.vin GROUP BY 1, 2)",
    select="SELECT b.vin, b.x AS age_months, CASE WHEN xa IS NULL THEN q.soh_raw WHEN xb IS NULL OR xa = x THEN p.soh_raw ELSE p.soh_raw + (q.soh_raw - p.soh_raw) * (x - xa) / (xb - xa) END AS soh_raw FROM br b LEFT JOIN ser p ON p.vin = b.vin AND p.age_months = xa LEFT JOIN ser q ON q.vin = b.vin AND q.age_months = xb",
    columns="vin:i age_months:d soh_raw:d",
)
add(
    "g13_nearest",
    lambda s, d: j.nearest(fx.series(s, d), fx.registration(s, d).select("vin", (F.col("vin") % 36 + 0.3).alias("deadline")), "age_months", "deadline", ["soh_raw"]),
    SERIES,
    select="SELECT vin, vin % 36 + 0.3 AS deadline, arg_min(age_months, (abs(age_months - (vin % 36 + 0.3)), age_months)) AS age_months, arg_min(soh_raw, (abs(age_months - (vin % 36 + 0.3)), age_months)) AS soh_raw FROM ser GROUP BY vin",
    columns="vin:i deadline:d age_months:d soh_raw:d",
)
add(
    "g14_rounded_step_join",
    lambda s, d: j.rounded_step_join(fx.series(s, d).groupBy("vin").agg(F.max("soh_raw").alias("top")).select("vin", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("h"), (F.col("top") - F.col("h")).alias("p50")), fx.series(s, d).select("vin", "age_months", "soh_raw", F.lit(12.0).alias("start")), "age_months", "start"),
    SERIES,
    select="SELECT s.vin, h.h, p50, soh_raw FROM ser s JOIN (SELECT vin, h, max(soh_raw) - h AS p50 FROM ser, generate_series(1, 24) AS g(h) GROUP BY vin, h) h ON h.vin = s.vin AND h.h = round_even(age_months - 12.0, 0)",
    columns="vin:i h:i p50:d soh_raw:d",
)
RULES = [(1, "promo", 5), (2, "brass", 4), (3, "steel", 3)]
add(
    "g15_keyword_rules",
    lambda s, d: j.keyword(fx.specs(s, d), F.col("variant"), s.createDataFrame(RULES, "priority int, keyword string, value int"), F.lit(2)).select("spec_id", "variant", "rule"),
    select="SELECT p_partkey AS spec_id, p_type AS variant, CASE WHEN lower(p_type) LIKE '%promo%' THEN 5 WHEN lower(p_type) LIKE '%brass%' THEN 4 WHEN lower(p_type) LIKE '%steel%' THEN 3 ELSE 2 END AS rule FROM part",
    columns="spec_id:i variant:s rule:i",
)
add(
    "g16_fuzzy_spec",
    lambda s, d: j.fuzzy_spec(
        fx.specs(s, d).select("spec_id", F.col("model").alias("source"), F.concat_ws(" ", "variant", "size").alias("name")).withColumnRenamed("spec_id", "row_id"),
        "name",
        fx.specs(s, d).where("size > 25").select(F.col("model").alias("source"), F.col("variant").alias("model"), "spec_id"),
    ).select("row_id", "spec_id"),
    select="""SELECT a.p_partkey AS row_id, arg_min(b.p_partkey, (CASE WHEN b.p_partkey IS NULL THEN 3 WHEN contains(lower(a.p_type || ' ' || a.p_size), lower(b.p_type)) THEN 0 WHEN split_part(lower(a.p_type), ' ', 1) = split_part(lower(b.p_type), ' ', 1) THEN 1 ELSE 2 END, b.p_partkey)) AS spec_id
      FROM part a LEFT JOIN part b ON a.p_brand = b.p_brand AND b.p_size > 25 GROUP BY 1""",
    columns="row_id:i spec_id:i",
)
add(
    "g17_q10_peer_rank",
    lambda s, d: j.peer_rank(j.latest(fx.series(s, d)).join(fx.registration(s, d).select("vin", "oem"), "vin"), "soh_raw").select("vin", "peers", "rank"),
    SERIES, REGISTRATION,
    "las AS (SELECT s.*, oem FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS rn FROM ser) s JOIN reg USING (vin) WHERE rn = 1)",
    select="""SELECT vin, peers, CASE WHEN peers >= 10 THEN sp ELSE sf END AS rank FROM (SELECT a.vin, count(*) FILTER (WHERE abs(a.age_months - b.age_months) <= 6) AS peers, count(*) FILTER (WHERE abs(a.age_months - b.age_months) <= 6 AND b.soh_raw < a.soh_raw) / count(*) FILTER (WHERE abs(a.age_months - b.age_months) <= 6) * 100 AS sp,
      count(*) FILTER (WHERE b.soh_raw < a.soh_raw) / count(*) * 100 AS sf FROM las a JOIN las b ON a.oem = b.oem GROUP BY a.vin)""",
    columns="vin:i peers:i rank:d",
)
add(
    "g18_contrasting_pair",
    lambda s, d: j.contrasting_pair(fx.series(s, d).groupBy("vin").agg(F.sum("km_month").alias("km"), F.min("soh_raw").alias("low")).join(fx.registration(s, d), "vin"), "km", "low", 5000.0, "oem"),
    SERIES, REGISTRATION,
    "tot AS (SELECT vin, oem, sum(km_month) AS km, min(soh_raw) AS low FROM ser JOIN reg USING (vin) GROUP BY 1, 2)",
    select="SELECT * FROM (SELECT a.oem, a.vin AS vin_a, b.vin AS vin_b, abs(a.low - b.low) AS apart, row_number() OVER (PARTITION BY a.oem ORDER BY abs(a.low - b.low) DESC, a.vin, b.vin) AS r FROM tot a JOIN tot b ON a.oem = b.oem AND a.vin < b.vin AND abs(a.km - b.km) <= 5000) WHERE r = 1",
    columns="oem:s vin_a:i vin_b:i apart:d",
)
add(
    "g19_g20_overlap",
    lambda s, d: j.overlap(fx.series(s, d).where("n >= 8").select("vin", "month", "soh_raw"), fx.series(s, d).where("km_month > 2000").select("vin", "month", "km_month"), 10),
    SERIES,
    select="SELECT * FROM (SELECT vin, month, soh_raw, km_month, count(*) OVER (PARTITION BY vin) AS shared FROM ser WHERE n >= 8 AND km_month > 2000) WHERE shared >= 10",
    columns="vin:i month:t soh_raw:d km_month:d shared:i",
)
add("h02_h04_top_vehicles", lambda s, d: fx.series(s, d).groupBy("vin").agg(F.count("*").alias("months"), F.sum("n").alias("n_rows")).orderBy(F.desc("months"), F.desc("n_rows"), "vin").limit(10), SERIES, select="SELECT vin, count(*) AS months, sum(n) AS n_rows FROM ser GROUP BY vin ORDER BY months DESC, n_rows DESC, vin LIMIT 10", columns="vin:i months:i n_rows:i")
add("h03_h09_largest_losses", lambda s, d: j.top_per_group(fx.series(s, d).withColumn("loss", F.lag("soh_raw").over(sr.by_month()) - F.col("soh_raw")).where("loss is not null"), "vin", [F.desc("loss"), F.col("month")], 3).select("vin", "month", "loss", "place"), SERIES, select="SELECT * FROM (SELECT vin, month, loss, row_number() OVER (PARTITION BY vin ORDER BY loss DESC, month) AS place FROM (SELECT *, lag(soh_raw) OVER (PARTITION BY vin ORDER BY month) - soh_raw AS loss FROM ser) WHERE loss IS NOT NULL) WHERE place <= 3", columns="vin:i month:t loss:d place:i")
add("h05_latest_row", lambda s, d: j.latest(fx.series(s, d)).select("vin", "month", "soh_raw"), SERIES, select="SELECT vin, max(month) AS month, arg_max(soh_raw, month) AS soh_raw FROM ser GROUP BY vin", columns="vin:i month:t soh_raw:d")
add(
    "h06_h07_h08_worst_first",
    lambda s, d: j.top_per_group(j.latest(fx.series(s, d)).join(fx.registration(s, d), "vin"), "oem", [F.desc((F.col("age_months") >= 60).cast("int")), F.col("soh_raw"), F.col("vin")], 2).select("oem", "vin", "soh_raw", "place"),
    SERIES, REGISTRATION,
    select="SELECT * FROM (SELECT oem, vin, soh_raw, row_number() OVER (PARTITION BY oem ORDER BY CAST(age_months >= 60 AS INT) DESC, soh_raw, vin) AS place FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY month DESC) AS rn FROM ser) JOIN reg USING (vin) WHERE rn = 1) WHERE place <= 2",
    columns="oem:s vin:i soh_raw:d place:i",
)
add(
    "h10_examples",
    lambda s, d: j.top_per_group(j.latest(fx.series(s, d)).withColumn("group", F.when(F.col("soh_raw") < 80, "at_risk").otherwise("safe")), "group", [F.desc("age_months"), F.col("vin")], 2).select("group", "vin", "place"),
    SERIES,
    select="""SELECT * FROM (SELECT "group", vin, row_number() OVER (PARTITION BY "group" ORDER BY age_months DESC, vin) AS place FROM (SELECT vin, max(age_months) AS age_months, CASE WHEN arg_max(soh_raw, month) < 80 THEN 'at_risk' ELSE 'safe' END AS "group" FROM ser GROUP BY vin)) WHERE place <= 2""",
    columns="group:s vin:i place:i",
)
add(
    "i01_i05_set_operations",
    lambda s, d: (lambda a, b: a.intersect(b).withColumn("what", F.lit("both")).unionByName(a.exceptAll(b).withColumn("what", F.lit("first"))).unionByName(a.union(b).distinct().withColumn("what", F.lit("any"))))(
        fx.series(s, d).where("n > 15").select("vin").distinct(), fx.series(s, d).where("km_month > 4500").select("vin").distinct()
    ),
    SERIES,
    "a AS (SELECT DISTINCT vin FROM ser WHERE n > 15)", "b AS (SELECT DISTINCT vin FROM ser WHERE km_month > 4500)",
    select="SELECT vin, 'both' AS what FROM (SELECT vin FROM a INTERSECT SELECT vin FROM b) UNION ALL SELECT vin, 'first' FROM (SELECT vin FROM a EXCEPT SELECT vin FROM b) UNION ALL SELECT vin, 'any' FROM (SELECT vin FROM a UNION SELECT vin FROM b)",
    columns="vin:i what:s",
)
add("i06_one_row_per_key", lambda s, d: j.first_of(fx.table(s, d, "lineitem").select(F.col("l_suppkey").alias("vin"), "l_partkey", "l_orderkey"), "vin", [F.col("l_orderkey"), F.col("l_partkey")]), select="SELECT vin, l_partkey, l_orderkey FROM (SELECT l_suppkey AS vin, l_partkey, l_orderkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey) AS r FROM lineitem) WHERE r = 1", columns="vin:i l_partkey:i l_orderkey:i")
add("i01_union_by_name", lambda s, d: fx.series(s, d).select("vin", "month", "soh_raw").unionByName(fx.series(s, d).where("n > 15").select("month", "vin", "temp_max"), allowMissingColumns=True), SERIES, select="SELECT vin, month, soh_raw, NULL AS temp_max FROM ser UNION ALL SELECT vin, month, NULL, temp_max FROM ser WHERE n > 15", columns="vin:i month:t soh_raw:d temp_max:d")

add(
    "j01_j02_dates_and_paths",
    lambda s, d: fx.table(s, d, "orders").select(
        "o_orderkey",
        sc.parse_date(F.date_format("o_orderdate", "dd/MM/yy"), "yyyy-MM-dd", "dd/MM/yy").alias("parsed"),
        F.add_months("o_orderdate", 3).cast("timestamp").alias("later"),
        F.datediff("o_orderdate", F.lit("1995-01-01")).alias("days"),
        sc.day_of_path(F.concat(F.lit("year=2024/day="), F.date_format("o_orderdate", "dd"))).alias("dom"),
    ),
    select="SELECT o_orderkey, o_orderdate::DATE::TIMESTAMP AS parsed, (o_orderdate::DATE + INTERVAL 3 MONTH)::TIMESTAMP AS later, date_diff('day', DATE '1995-01-01', o_orderdate::DATE) AS days, day(o_orderdate) AS dom FROM orders",
    columns="o_orderkey:i parsed:t later:t days:i dom:i",
)
add(
    "j04_j05_j06_numbers_and_strings",
    lambda s, d: fx.specs(s, d).select("spec_id", F.bround(F.col("size") / 2).alias("even"), F.sqrt("size").alias("root"), F.col("variant").try_cast("double").alias("number"), F.lower("variant").alias("low"), F.right("variant", F.lit(5)).alias("tail"), F.concat_ws(";", "model", F.when(F.col("size") > 25, F.lit("large"))).alias("joined")),
    select="SELECT p_partkey AS spec_id, round_even(p_size / 2, 0) AS even, sqrt(p_size) AS root, try_cast(p_type AS DOUBLE) AS number, lower(p_type) AS low, right(p_type, 5) AS tail, concat_ws(';', p_brand, CASE WHEN p_size > 25 THEN 'large' END) AS joined FROM part",
    columns="spec_id:i even:d root:d number:d low:s tail:s joined:s",
)
add(
    "j07_j08_arrays_and_json",
    lambda s, d: fx.table(s, d, "events").withColumn("k", F.from_json("props", "k bigint")["k"]).groupBy("user_id").agg(F.array_sort(F.collect_list("k")).alias("ks")).select("user_id", F.posexplode("ks").alias("at", "k"), F.size("ks").alias("n")),
    select="SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY k) - 1 AS at, k, count(*) OVER (PARTITION BY user_id) AS n FROM (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)",
    columns="user_id:i at:i k:i n:i",
)
add(
    "j09_j10_j11_range_status_age",
    lambda s, d: fx.series(s, d).select("vin", "month", sc.estimated_range(F.col("soh_raw"), F.lit(7.4), F.when(F.col("n") > 8, F.col("temp_max") + 30), F.lit(120.0)).alias("range_km"), sc.health_status(F.col("soh_raw")).alias("status"), sc.care_grade(F.col("soh_raw")).alias("grade"), sc.age_text(F.col("age_months")).alias("age")),
    SERIES,
    select="""SELECT vin, month, CASE WHEN n > 8 THEN 7400 * soh_raw / 100 / (temp_max + 30) ELSE 120 * soh_raw / 100 END AS range_km, CASE WHEN soh_raw - 80 >= 15 THEN 'excellent' WHEN soh_raw - 80 >= 8 THEN 'good' WHEN soh_raw - 80 >= 3 THEN 'fair' WHEN soh_raw - 80 >= 0 THEN 'watch' ELSE 'below' END AS status,
      CASE WHEN soh_raw >= 72 THEN 'Gentle' WHEN soh_raw >= 50 THEN 'Moderate' WHEN soh_raw >= 35 THEN 'Firm' ELSE 'Hard' END AS grade, (floor(round_even(age_months, 0) / 12)::INT)::VARCHAR || ' yr ' || (round_even(age_months, 0)::INT % 12)::VARCHAR || ' mo' AS age FROM ser""",
    columns="vin:i month:t range_km:d status:s grade:s age:s",
)
add(
    "j12_soc_density",
    lambda s, d: sc.soc_density(fx.series(s, d).groupBy("vin").agg(F.avg("soh_raw").alias("soc_mean"), F.avg("frac_soc_high").alias("frac_soc_high"), F.avg("frac_soc_low").alias("frac_soc_low"))),
    SERIES,
    select="""SELECT vin, soc, raw / max(raw) OVER (PARTITION BY vin) AS density FROM (SELECT vin, soc, greatest(1 - h - l, 0) * exp(-0.5 * ((soc - m) / 18.0) ** 2) + h * exp(-0.5 * ((soc - 95.0) / 5.0) ** 2) + l * exp(-0.5 * ((soc - 12.0) / 7.0) ** 2) AS raw
      FROM (SELECT vin, avg(soh_raw) AS m, avg(frac_soc_high) AS h, avg(frac_soc_low) AS l FROM ser GROUP BY vin), generate_series(0, 100) AS g(soc))""",
    columns="vin:i soc:i density:d",
)
add(
    "j13_second_life",
    lambda s, d: sc.second_life(fx.series(s, d).groupBy("vin").agg(F.avg("dod_mean").alias("dod")), F.col("dod") / 1e4, F.lit(1e-7), F.lit(1e-11)).groupBy("vin").agg(F.min(F.when(F.col("soh") <= 20, F.col("cycle"))).alias("end_cycle"), F.avg("soh").alias("mean")),
    SERIES,
    select="SELECT vin, min(c) FILTER (WHERE soh <= 20) AS end_cycle, avg(soh) AS mean FROM (SELECT vin, c, greatest(100 - dod / 1e4 * c - 1e-7 * c ** 2 - 1e-11 * c ** 3, 0) AS soh FROM (SELECT vin, avg(dod_mean) AS dod FROM ser GROUP BY vin), generate_series(0, 9000, 100) AS g(c)) GROUP BY vin",
    columns="vin:i end_cycle:d mean:d",
)
add("j14_equivalent_cycles", lambda s, d: fx.series(s, d).select("vin", "month", sc.equivalent_cycles(F.col("ah_throughput"), F.lit(133.0)).alias("cycles")), SERIES, select="SELECT vin, month, ah_throughput / 266 AS cycles FROM ser", columns="vin:i month:t cycles:d")

add(
    "k01_k02_spread_and_quantiles",
    lambda s, d: fx.series(s, d).groupBy("vin").agg(st.cv("soh_raw").alias("cv"), st.quantile("soh_raw", 0.25).alias("q25")),
    SERIES,
    select="SELECT vin, stddev_samp(soh_raw) / avg(soh_raw) * 100 AS cv, quantile_cont(soh_raw, 0.25) AS q25 FROM ser GROUP BY vin",
    columns="vin:i cv:d q25:d",
)
add("k03_mad", lambda s, d: st.mad(fx.series(s, d), "soh_raw"), SERIES, select="SELECT vin, median(abs(soh_raw - m)) AS mad FROM (SELECT vin, soh_raw, median(soh_raw) OVER (PARTITION BY vin) AS m FROM ser) GROUP BY vin", columns="vin:i mad:d")
THEIL = """ts0 AS (SELECT a.vin, median((b.soh_raw - a.soh_raw) / (b.age_months - a.age_months)) AS slope FROM ser a JOIN ser b ON a.vin = b.vin AND b.age_months > a.age_months GROUP BY a.vin),
ts AS (SELECT s.vin, slope, median(soh_raw - slope * age_months) AS intercept, count(*) AS n, max(age_months) - min(age_months) AS span FROM ser s JOIN ts0 t ON t.vin = s.vin GROUP BY 1, 2)"""
add("k04_theil_sen", lambda s, d: st.theil_sen(fx.series(s, d), "age_months", "soh_raw"), SERIES, THEIL, select="SELECT * FROM ts", columns="vin:i slope:d intercept:d n:i")
add("k05_decline_per_year", lambda s, d: st.decline_per_year(fx.series(s, d), "soh_raw"), SERIES, THEIL, select="SELECT vin, CASE WHEN n >= 4 AND span >= 4 THEN -12 * slope END AS ppy FROM ts", columns="vin:i ppy:d")
add("k06_k07_line", lambda s, d: st.line(fx.series(s, d), "age_months", "soh_raw"), SERIES, select="SELECT vin, regr_slope(soh_raw, age_months) AS slope, regr_intercept(soh_raw, age_months) AS intercept, regr_r2(soh_raw, age_months) AS r2, count(*) AS n FROM ser GROUP BY vin", columns="vin:i slope:d intercept:d r2:d n:i")
SQRT = "sq AS (SELECT vin, CASE WHEN b <= 0 THEN b ELSE 0 END AS slope, CASE WHEN b <= 0 THEN a ELSE m END AS intercept FROM (SELECT vin, regr_slope(soh_raw, sqrt(age_months)) AS b, regr_intercept(soh_raw, sqrt(age_months)) AS a, avg(soh_raw) AS m FROM ser GROUP BY vin))"
add("k08_sqrt_trend", lambda s, d: st.sqrt_trend(fx.series(s, d), "soh_raw"), SERIES, SQRT, select="SELECT * FROM sq", columns="vin:i slope:d intercept:d")
RANKS = "rk AS (SELECT vin, rank() OVER (PARTITION BY vin ORDER BY temp_max) + (count(*) OVER (PARTITION BY vin, temp_max) - 1) / 2 AS rx, rank() OVER (PARTITION BY vin ORDER BY soh_raw) + (count(*) OVER (PARTITION BY vin, soh_raw) - 1) / 2 AS ry FROM ser)"
add("k09_k10_spearman", lambda s, d: st.spearman(fx.series(s, d), "temp_max", "soh_raw", "vin"), SERIES, RANKS, select="SELECT vin, corr(rx, ry) AS rho, count(*) AS n FROM rk GROUP BY vin", columns="vin:i rho:d n:i")
add(
    "k11_partial_correlation",
    lambda s, d: st.partial_correlation(fx.series(s, d).withColumns({"x": sr.z_score("temp_max"), "y": sr.z_score("soh_raw")}), "x", "y", "age_months"),
    SERIES,
    "z AS (SELECT (temp_max - avg(temp_max) OVER o) / stddev_samp(temp_max) OVER o AS x, (soh_raw - avg(soh_raw) OVER o) / stddev_samp(soh_raw) OVER o AS y, age_months AS a FROM ser WINDOW o AS (PARTITION BY vin))",
    "zf AS (SELECT regr_slope(x, a) AS sx, regr_intercept(x, a) AS cx, regr_slope(y, a) AS sy, regr_intercept(y, a) AS cy FROM z)",
    select="SELECT corr(x - sx * a - cx, y - sy * a - cy) AS r, count(*) AS n FROM z, zf",
    columns="r:d n:i",
)
add(
    "k12_detrended_spearman",
    lambda s, d: st.detrended_spearman(fx.series(s, d), "km_month", "soh_raw"),
    SERIES,
    "lin AS (SELECT vin, regr_slope(km_month, age_months) AS a1, regr_intercept(km_month, age_months) AS a0, regr_slope(soh_raw, age_months) AS b1, regr_intercept(soh_raw, age_months) AS b0 FROM ser GROUP BY vin)",
    "dtr AS (SELECT s.vin, km_month - a1 * age_months - a0 AS rx, soh_raw - b1 * age_months - b0 AS ry, km_month - lag(km_month) OVER w AS dx, soh_raw - lag(soh_raw) OVER w AS dy FROM ser s JOIN lin l ON l.vin = s.vin WINDOW w AS (PARTITION BY s.vin ORDER BY month))",
    "bth AS (SELECT vin, 'res' AS what, rx AS x, ry AS y FROM dtr UNION ALL SELECT vin, 'dif', dx, dy FROM dtr)",
    "rnk AS (SELECT vin, what, rank() OVER (PARTITION BY vin, what ORDER BY x) + (count(*) OVER (PARTITION BY vin, what, x) - 1) / 2 AS x, rank() OVER (PARTITION BY vin, what ORDER BY y) + (count(*) OVER (PARTITION BY vin, what, y) - 1) / 2 AS y FROM bth WHERE x IS NOT NULL AND y IS NOT NULL)",
    select="SELECT vin, corr(x, y) FILTER (WHERE what = 'res') AS rho_detrended, corr(x, y) FILTER (WHERE what = 'dif') AS rho_diff FROM rnk GROUP BY vin",
    columns="vin:i rho_detrended:d rho_diff:d",
)
add("k13_sqrt_fade", lambda s, d: st.sqrt_fade(fx.series(s, d), "soh_raw"), SERIES, select="SELECT vin, k, CASE WHEN k > 0 THEN (20 / k) ** 2 END AS eol_age FROM (SELECT vin, sum((100 - soh_raw) * sqrt(age_months)) / sum(age_months) AS k FROM ser WHERE age_months > 0 GROUP BY vin)", columns="vin:i k:d eol_age:d")
add(
    "k14_bootstrap_median",
    lambda s, d: st.bootstrap_median(fx.series(s, d).groupBy("vin").agg(F.min("soh_raw").alias("low_soh")).withColumnRenamed("vin", "id"), "low_soh"),
    SERIES,
    "low AS (SELECT vin AS id, min(soh_raw) AS low_soh FROM ser GROUP BY vin)",
    "uni AS (SELECT low_soh, draw, ('0x' || substr(md5(id::VARCHAR || ':' || draw::VARCHAR), 1, 8))::BIGINT % 1000000 / 1e6 AS u FROM low, generate_series(1, 200) AS g(draw))",
    "wei AS (SELECT *, (u >= 0.36788)::INT + (u >= 0.73576)::INT + (u >= 0.91970)::INT + (u >= 0.98101)::INT + (u >= 0.99634)::INT + (u >= 0.99941)::INT AS w FROM uni)",
    "mid AS (SELECT draw, median(low_soh) AS m FROM (SELECT draw, low_soh, unnest(range(w)) FROM wei) GROUP BY draw)",
    select="SELECT (SELECT median(low_soh) FROM low) AS median, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM mid",
    columns="median:d low:d high:d",
)
add(
    "k14_bootstrap_correlation",
    lambda s, d: sel.bootstrap_correlation(fx.series(s, d).groupBy(F.col("vin").alias("id")).agg(F.avg("temp_max").alias("heat"), F.min("soh_raw").alias("low_soh")), "heat", "low_soh"),
    SERIES,
    "own AS (SELECT vin AS id, avg(temp_max) AS x, min(soh_raw) AS y FROM ser GROUP BY vin)",
    "ctr AS (SELECT id, x - (SELECT avg(x) FROM own) AS x, y - (SELECT avg(y) FROM own) AS y FROM own)",
    f"hs1 AS (SELECT x, y, id % {sel.PRIME} AS i, b, (id % {sel.PRIME} * 16807 + b * 48271 + 12345) % {sel.PRIME} AS h FROM ctr, generate_series(1, 2000) AS g(b))",
    f"hs2 AS (SELECT x, y, b, (h * h + i) % {sel.PRIME} AS h FROM hs1)",
    f"hs3 AS (SELECT x, y, b, (h * h + b) % {sel.PRIME} / {sel.PRIME} AS u FROM hs2)",
    f"wei AS (SELECT x, y, b, {' + '.join(f'(u >= {p})::INT' for p in sel.POISSON)} AS w FROM hs3)",
    "mom AS (SELECT b, sum(w) AS w, sum(w * x) AS x, sum(w * y) AS y, sum(w * x * x) AS xx, sum(w * y * y) AS yy, sum(w * x * y) AS xy FROM wei GROUP BY b)",
    "rho AS (SELECT (xy - x * y / w) / sqrt((xx - x * x / w) * (yy - y * y / w)) AS rho FROM mom WHERE w > 1)",
    select="SELECT (SELECT corr(x, y) FROM own) AS rho, (SELECT count(*) FROM own) AS n, quantile_cont(rho, 0.025) AS low, quantile_cont(rho, 0.975) AS high FROM rho",
    columns="rho:d n:i low:d high:d",
)
add("k15_relative_slopes", lambda s, d: st.relative_slopes(fx.series(s, d), "soh_raw"), SERIES, select="SELECT vin, regr_slope(soh_raw, age_months) / avg(soh_raw) * 100 AS rel_slope, count(*) AS n FROM ser GROUP BY vin HAVING count(*) >= 6", columns="vin:i rel_slope:d n:i")
add("k20_errors", lambda s, d: st.errors(fx.series(s, d).withColumn("p", F.lag("soh_raw").over(sr.by_month())), "p", "soh_raw", ("vin",)), SERIES, select="SELECT vin, sqrt(avg((p - soh_raw) ** 2)) AS rmse, avg(abs(p - soh_raw)) AS mae, avg(p - soh_raw) AS bias, count(*) AS n FROM (SELECT *, lag(soh_raw) OVER (PARTITION BY vin ORDER BY month) AS p FROM ser) WHERE p IS NOT NULL GROUP BY vin", columns="vin:i rmse:d mae:d bias:d n:i")


def cubic(y: str, name: str, anchored: bool = False) -> str:
    """Bounded cubic fits: normal equations for each choice of the coefficients that may be above 0, solved by elimination; the best feasible one stays.

    u is age over its span, so c1 to c3 of ``name`` are falls over the whole span.
    """
    u, least, degree, constant = ("age_months / max(age_months) OVER w", 2, "n", 0) if anchored else ("(age_months - min(age_months) OVER w) / (max(age_months) OVER w - min(age_months) OVER w)", 3, "n // 4", 1)
    right = [f"{constant} * t0", *[(f"m{k} * (100 * s{k} - t{k})" if anchored else f"m{k} * -t{k}") for k in (1, 2, 3)]]
    return f"""{name}_p AS (SELECT vin, age_months, {u} AS u, {y} AS y FROM ser WINDOW w AS (PARTITION BY vin)),
{name}_m AS (SELECT vin, count(*) AS n, min(age_months) AS x0, max(age_months) AS x1, {", ".join(f"sum(u ** {k}) AS s{k}" for k in range(7))}, {", ".join(f"sum(u ** {k} * y) AS t{k}" for k in range(4))} FROM {name}_p GROUP BY vin HAVING count(*) >= {least} AND max(age_months) > {"0" if anchored else "min(age_months)"}),
{name}_a AS (SELECT vin, n, x0, x1, {"1.0" if anchored else "s0"} AS a00, {constant} * -m1 * s1 AS a01, {constant} * -m2 * s2 AS a02, {constant} * -m3 * s3 AS a03, CASE WHEN m1 THEN s2 ELSE 1 END AS a11, m1 * m2 * s3 AS a12, m1 * m3 * s4 AS a13,
  CASE WHEN m2 THEN s4 ELSE 1 END AS a22, m2 * m3 * s5 AS a23, CASE WHEN m3 THEN s6 ELSE 1 END AS a33, {", ".join(f"{r} AS r{k}" for k, r in enumerate(right))}
  FROM {name}_m, (SELECT unnest([0, 1]) AS m1), (SELECT unnest([0, 1]) AS m2), (SELECT unnest([0, 1]) AS m3) WHERE (m2 = 0 OR {degree} >= 2) AND (m3 = 0 OR {degree} >= 3)),
{name}_b AS (SELECT *, a11 - a01 * a01 / a00 AS b11, a12 - a01 * a02 / a00 AS b12, a13 - a01 * a03 / a00 AS b13, a22 - a02 * a02 / a00 AS b22, a23 - a02 * a03 / a00 AS b23, a33 - a03 * a03 / a00 AS b33, r1 - a01 / a00 * r0 AS q1, r2 - a02 / a00 * r0 AS q2, r3 - a03 / a00 * r0 AS q3 FROM {name}_a),
{name}_c AS (SELECT *, b22 - b12 * b12 / b11 AS d22, b23 - b12 * b13 / b11 AS d23, b33 - b13 * b13 / b11 AS d33, q2 - b12 / b11 * q1 AS p2, q3 - b13 / b11 * q1 AS p3 FROM {name}_b),
{name}_d AS (SELECT *, (p3 - d23 / d22 * p2) / (d33 - d23 * d23 / d22) AS c3, (p2 - d23 * c3) / d22 AS c2, (q1 - b12 * c2 - b13 * c3) / b11 AS c1, (r0 - a01 * c1 - a02 * c2 - a03 * c3) / a00 AS c0 FROM {name}_c),
{name} AS (SELECT vin, n, x0, x1, c0, c1, c2, c3 FROM {name}_d WHERE c1 >= -1e-12 AND c2 >= -1e-12 AND c3 >= -1e-12 QUALIFY row_number() OVER (PARTITION BY vin ORDER BY c0 * r0 + c1 * r1 + c2 * r2 + c3 * r3 DESC) = 1)"""


add(
    "k16_decreasing_cubic",
    lambda s, d: bd.decreasing_cubic(fx.series(s, d), "soh_raw"),
    SERIES, cubic("soh_raw", "cub"),
    select="SELECT vin, n, x0, x1, c0, c1 / (x1 - x0) AS c1, c2 / (x1 - x0) ** 2 AS c2, c3 / (x1 - x0) ** 3 AS c3 FROM cub",
    columns="vin:i n:i x0:d x1:d c0:d c1:d c2:d c3:d",
)
add(
    "k17_anchored_cubic",
    lambda s, d: bd.evaluate(bd.decreasing_cubic(fx.series(s, d), "soh_raw", anchored=True), fx.series(s, d).select("vin", "age_months"), anchored=True),
    SERIES, cubic("soh_raw", "cub", anchored=True),
    select="SELECT vin, age_months, 100 - c1 * age_months / x1 - c2 * (age_months / x1) ** 2 - c3 * (age_months / x1) ** 3 AS fitted FROM ser JOIN cub USING (vin)",
    columns="vin:i age_months:d fitted:d",
)
add(
    "k18_greyed",
    lambda s, d: bd.greyed(fx.series(s, d), "soh_raw").select("vin", "month", F.col("inlier").cast("int").alias("inlier")),
    SERIES,
    "gr0 AS (SELECT *, soh_raw >= 99.95 AS top FROM ser)",
    "gr1 AS (SELECT *, (top AND row_number() OVER (PARTITION BY vin, top ORDER BY month) > 1) OR (100 - soh_raw) / greatest(age_months / 12, 0.25) > 10 AS gone FROM gr0)",
    "gr2 AS (SELECT * FROM gr1 WHERE NOT gone)",
    "gr3 AS (SELECT a.vin, median((b.soh_raw - a.soh_raw) / (b.age_months - a.age_months)) AS slope FROM gr2 a JOIN gr2 b ON a.vin = b.vin AND b.age_months > a.age_months GROUP BY a.vin)",
    "gr4 AS (SELECT g.vin, month, soh_raw - coalesce(slope, 0) * age_months AS r, count(*) OVER (PARTITION BY g.vin) AS n FROM gr2 g LEFT JOIN gr3 t ON t.vin = g.vin)",
    "gr5 AS (SELECT *, abs(r - median(r) OVER (PARTITION BY vin)) AS off FROM gr4)",
    "gr6 AS (SELECT vin, month FROM (SELECT *, greatest(3.5 * 1.4826 * median(off) OVER (PARTITION BY vin), 3.0) AS lim FROM gr5) WHERE n >= 4 AND off > lim)",
    select="SELECT g.vin, g.month, CAST(NOT gone AND h.vin IS NULL AS INT) AS inlier FROM gr1 g LEFT JOIN gr6 h ON h.vin = g.vin AND h.month = g.month",
    columns="vin:i month:t inlier:i",
)
add(
    "l12_fitted_drops",
    lambda s, d: (lambda a, b: a.join(b, "vin"))(*[bd.decreasing_cubic(fx.series(s, d), y).select("vin", (F.col("c1") * (F.col("x1") - F.col("x0")) + F.col("c2") * F.pow(F.col("x1") - F.col("x0"), F.lit(2.0)) + F.col("c3") * F.pow(F.col("x1") - F.col("x0"), F.lit(3.0))).alias(f"drop_{y}")) for y in ("soh_raw", "cap_raw")]),
    SERIES, cubic("soh_raw", "cub"), cubic("cap_raw", "cap"),
    select="SELECT vin, a.c1 + a.c2 + a.c3 AS drop_soh_raw, b.c1 + b.c2 + b.c3 AS drop_cap_raw FROM cub a JOIN cap b USING (vin)",
    columns="vin:i drop_soh_raw:d drop_cap_raw:d",
)
