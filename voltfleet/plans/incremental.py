"""Queries of scans, the incremental build and streams (file sources that run to their end)."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import incremental as inc
from ..operators import monthly as mo
from ..operators import series as sr
from ..operators import soh as so
from ..sources import fixtures as fx
from ..sources import scans
from ..sources.shared import shared_folder
from ..sources.store import MonthStore, merge
from ..streaming import ingest, live
from .base import SERIES, TELEMETRY, Book
from .events import GAP_S, SESSIONS, clean_samples
from .series import pava
from .soh import READINGS, bms

book = Book()
add = book.add

DAYS = ["2024-01-03", "2024-01-17", "2030-01-01"]
add("a01_a02_listed_days", lambda s, d: scans.on_days(fx.telemetry(s, d), "t", DAYS).select("id"), TELEMETRY, select="SELECT id FROM tel WHERE t::DATE IN (DATE '2024-01-03', DATE '2024-01-17', DATE '2030-01-01')", columns="id:i")
add("a03_pruned_vin_scan", lambda s, d: fx.table(s, d, "events").where("user_id = 17").select("event_id", "value"), select="SELECT event_id, value FROM events WHERE user_id = 17", columns="event_id:i value:d")
add("a04_cohort_scan", lambda s, d: scans.of_cohort(fx.table(s, d, "events").withColumnRenamed("user_id", "vin"), fx.table(s, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("vin"))).select("event_id"), select="SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')", columns="event_id:i")


def days(s: SparkSession, d: str) -> DataFrame:
    return fx.table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")).where("dayofmonth(day) % 3 <> 0").distinct()


DAYS_SQL = "dys AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders WHERE day(o_orderdate) % 3 <> 0)"
add("a07_days_near_targets", lambda s, d: scans.days_near(days(s, d)), DAYS_SQL, select="SELECT DISTINCT day::TIMESTAMP AS day FROM (SELECT day, row_number() OVER (PARTITION BY date_trunc('month', day), t ORDER BY abs(day(day) - t), day) AS r FROM dys, (SELECT unnest([8, 16, 24]) AS t)) WHERE r = 1", columns="day:t")
add("a08_every_kth_day", lambda s, d: scans.every_kth_day(days(s, d), 4), DAYS_SQL, select="SELECT day::TIMESTAMP AS day FROM (SELECT day, row_number() OVER (PARTITION BY date_trunc('month', day) ORDER BY day) AS r FROM dys) WHERE (r - 1) % 4 = 0", columns="day:t")
add("a07_sampled_orders", lambda s, d: scans.sampled(fx.table(s, d, "orders"), "o_orderdate", scans.days_near(days(s, d), (15,))).select("o_orderkey"), DAYS_SQL, "pck AS (SELECT day FROM (SELECT day, row_number() OVER (PARTITION BY date_trunc('month', day) ORDER BY abs(day(day) - 15), day) AS r FROM dys) WHERE r = 1)", select="SELECT o_orderkey FROM orders WHERE o_orderdate::DATE IN (SELECT day FROM pck)", columns="o_orderkey:i")
add("a10_cap_files", lambda s, d: scans.cap_files(fx.table(s, d, "orders").select(F.col("o_orderkey").alias("file"), F.to_date("o_orderdate").alias("day")), 2), select="SELECT file, day FROM (SELECT o_orderkey AS file, o_orderdate::DATE::TIMESTAMP AS day, row_number() OVER (PARTITION BY o_orderdate::DATE ORDER BY o_orderkey) AS r FROM orders) WHERE r <= 2", columns="file:i day:t")
add("a13_a20_dimension_numbers", lambda s, d: scans.numbers_or_text(fx.specs(s, d).withColumn("size", F.when(F.col("size") % 4 == 0, "unverified").otherwise(F.col("size").cast("string"))), ["size"]).select("spec_id", "size", "size_num"), select="SELECT p_partkey AS spec_id, CASE WHEN p_size % 4 = 0 THEN 'unverified' ELSE p_size::VARCHAR END AS size, CASE WHEN p_size % 4 <> 0 THEN p_size::DOUBLE END AS size_num FROM part", columns="spec_id:i size:s size_num:d")
add("a15_larger_store", lambda s, d: scans.larger_store(fx.series(s, d).where("n >= 17").select("vin", "month"), fx.series(s, d).where("n >= 14").select("vin", "month")), SERIES, select="SELECT vin, month FROM ser WHERE n >= 14", columns="vin:i month:t")
add("a18_as_of", lambda s, d: scans.as_of(fx.series(s, d).withColumn("ymd", F.date_format("month", "yyyy-MM-dd")), F.lit("1997-06-01")).select("vin", "ymd"), SERIES, select="SELECT vin, strftime(month, '%Y-%m-%d') AS ymd FROM ser WHERE month <= TIMESTAMP '1997-06-01'", columns="vin:i ymd:s")
add("a21_cohort_span", lambda s, d: scans.within_cohort_span(fx.telemetry(s, d), "t", fx.telemetry(s, d).where("vin = 5").groupBy("vin").agg(F.min("t").alias("a"), F.max("t").alias("b")), "a", "b").select("id"), TELEMETRY, select="SELECT id FROM tel WHERE t BETWEEN (SELECT min(t) FROM tel WHERE vin = 5) AND (SELECT max(t) FROM tel WHERE vin = 5)", columns="id:i")



def planned(s: SparkSession, d: str) -> DataFrame:
    """S1: the table's last day is today, five days before it was the last run; and how many samples each day has."""
    last = fx.table(s, d, "events").agg(F.to_date(F.max("ts")).alias("d")).first()["d"]
    plan = inc.plan_days(s, str(last), str(last - timedelta(days=5)), 7, 6)
    counts = fx.table(s, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return plan.join(counts, "day", "left").withColumn("clamped", F.col("clamped").cast("int"))


add("s01_plan_days", planned, "mx AS (SELECT max(ts)::DATE AS d FROM events)", "pl AS (SELECT (d - i::INT)::DATE AS day, d AS advance_to, 1 AS clamped FROM mx, generate_series(0, 5) AS g(i))",
    select="SELECT day::TIMESTAMP AS day, advance_to::TIMESTAMP AS advance_to, clamped, n FROM pl LEFT JOIN (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1) USING (day)", columns="day:t advance_to:t clamped:i n:i")
add(
    "s02_upsert",
    lambda s, d: inc.upsert(fx.telemetry(s, d).where("id % 3 > 0").select("vin", "t", F.lit(0).alias("load"), "soc"), fx.telemetry(s, d).where("id % 3 < 2").select("vin", "t", F.lit(1).alias("load"), (F.col("soc") + 1).alias("soc")), ["vin", "t"], "load"),
    TELEMETRY,
    select="SELECT vin, t, CASE WHEN id % 3 < 2 THEN soc + 1 ELSE soc END AS soc FROM tel",
    columns="vin:i t:t soc:d",
)


def stored_upsert(s: SparkSession, d: str) -> DataFrame:
    """All orders, then corrections of a year's, merged into a table of months of which only that year's are rewritten."""
    orders = fx.table(s, d, "orders").select(F.col("o_orderkey").alias("vin"), F.col("o_orderdate").cast("timestamp").alias("t"), F.lit(1).alias("load"), F.col("o_totalprice").alias("price"))
    store = MonthStore(s, f"{shared_folder(s)}/upsert-{uuid.uuid4().hex}", ("vin",), "load", parts=1)
    merge(store, 1, orders)
    merge(store, 2, orders.where("year(t) = 1995 and vin % 3 = 0").withColumns({"load": F.lit(2), "price": F.col("price") + 1}))
    return store.read().select("vin", "t", "month", "price", "load")


add("s02_stored_upsert", stored_upsert, select="SELECT o_orderkey AS vin, o_orderdate AS t, date_trunc('month', o_orderdate)::TIMESTAMP AS month, o_totalprice + CAST(fixed AS INT) AS price, 1 + CAST(fixed AS INT) AS load FROM (SELECT *, year(o_orderdate) = 1995 AND o_orderkey % 3 = 0 AS fixed FROM orders)", columns="vin:i t:t month:t price:d load:i")


def old_and_new(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    samples = clean_samples(s, d).withColumn("t", F.expr("t + make_interval(0, cast(id % 3 as int))"))
    return samples, samples.where("id % 37 = 0")


def features(samples: DataFrame) -> DataFrame:
    return mo.electrical_features(ev.sessions(samples, GAP_S))


def incremental_months(s: SparkSession, d: str) -> DataFrame:
    """Monthly store of all but the new rows, then brought up to date by the new ones."""
    samples, new = old_and_new(s, d)
    store = features(samples.join(new.select("id"), "id", "left_anti"))
    return inc.rebuild_months(store, samples, inc.touched(new), features)


SHIFTED = TELEMETRY.replace("ok AS (SELECT * FROM tel", "ok AS (SELECT * REPLACE ((t + to_months((id % 3)::INT))::TIMESTAMP AS t) FROM tel")
add("s03_touched_months", lambda s, d: inc.touched(old_and_new(s, d)[1]), SHIFTED, select="SELECT DISTINCT vin, date_trunc('month', t)::TIMESTAMP AS month FROM ok WHERE id % 37 = 0", columns="vin:i month:t")
add("s04_incremental_months", incremental_months, SHIFTED, SESSIONS, select="SELECT vin, date_trunc('month', t)::TIMESTAMP AS month, sum(abs(dq)) AS ah_throughput, avg(soc) AS soc_mean, count(*) AS n_rows FROM ses GROUP BY 1, 2", columns="vin:i month:t ah_throughput:d soc_mean:d n_rows:i")
add("s08_o16_incremental_equals_batch", lambda s, d: inc.equivalence(incremental_months(s, d), features(old_and_new(s, d)[0]), ["vin", "month"], ["ah_throughput", "cur_abs_mean", "soc_mean", "dod_mean", "odo_max"]).select("column", "only_one", F.col("same").cast("int").alias("same")), select="SELECT unnest(['ah_throughput', 'cur_abs_mean', 'soc_mean', 'dod_mean', 'odo_max']) AS \"column\", 0 AS only_one, 1 AS same", columns="column:s only_one:i same:i")


def rebuilt(s: SparkSession, d: str) -> DataFrame:
    """S5: touched vehicles' cumulative columns over all months."""
    store = fx.series(s, d).select("vin", "month", "ah_throughput", "soh_raw")
    build = lambda df: sr.cumulative(df, {"ah_throughput": "cum_ah"})
    marks = store.where("vin % 4 = 0").select("vin", "month")
    return inc.rebuild_vehicles(build(store.withColumn("ah_throughput", F.when(F.col("vin") % 4 == 0, 0.0).otherwise(F.col("ah_throughput")))).join(marks.select("vin").distinct(), "vin", "left_anti"), store, store.where("vin % 4 = 0").select("vin", "month"), build)


add("s05_rebuilt_vehicles", rebuilt, SERIES, select="SELECT vin, month, sum(ah_throughput) OVER (PARTITION BY vin ORDER BY month) AS cum_ah FROM ser", columns="vin:i month:t cum_ah:d")
add(
    "s04_s05_two_tier_samples",
    lambda s, d: so.remaining_capacity_soh(inc.spread_samples(inc.month_samples(fx.table(s, d, "lineitem").select(F.col("l_suppkey").alias("vin"), F.col("l_shipdate").cast("timestamp").alias("t"), (110 - F.col("l_quantity") / 2).alias("full_cap")), F.col("full_cap"), "fullcap_hi"), "fullcap_hi", "full_cap"), 8),
    READINGS, bms(8, 6, 6, 0.9), pava("num", "full_cap", "iso"),
    select="SELECT vin, month, n, least(100 * fit / nominal, 100.0) AS soh FROM num JOIN iso USING (vin, rn) JOIN nom USING (vin)",
    columns="vin:i month:t n:i soh:d",
)
add("s07_safety_net", lambda s, d: inc.safety_net(inc.touched(old_and_new(s, d)[1]), fx.telemetry(s, d).where("vin > 10")), SHIFTED, select="SELECT (SELECT count(DISTINCT vin) FROM ok WHERE id % 37 = 0) AS touched, (SELECT count(DISTINCT vin) FROM tel WHERE vin > 10) AS built, CASE WHEN (SELECT count(DISTINCT vin) FROM tel WHERE vin > 10) < (SELECT count(DISTINCT vin) FROM ok WHERE id % 37 = 0) THEN 'shortfall' ELSE 'ok' END AS state", columns="touched:i built:i state:s")
add("t03_rejects", lambda s, d: inc.rejects(fx.telemetry(s, d), {"soc": F.col("soc").between(0, 100), "amps": F.abs("amps") <= 400}, "clean")[1].groupBy("stage", "reason").agg(F.count("*").alias("n")), TELEMETRY, select="SELECT 'clean' AS stage, CASE WHEN soc NOT BETWEEN 0 AND 100 THEN 'soc' ELSE 'amps' END AS reason, count(*) AS n FROM tel WHERE NOT (soc BETWEEN 0 AND 100 AND abs(amps) <= 400) GROUP BY 2", columns="stage:s reason:s n:i")


def _run(s: SparkSession, samples: DataFrame, build, mode: str = "append", flush: bool = False) -> DataFrame:  # noqa: ANN001
    """Deliver samples in four steps in order of time, stream each to its end from one checkpoint, and return what the sink holds.

    A step's files come in no order, but all in one batch. ``flush`` adds a last step of one row that ends what is still open.
    The samples are computed once and stored, since the cuts and each step read them.
    """
    root = f"{shared_folder(s)}/stream-{uuid.uuid4().hex}"
    samples.write.parquet(f"{root}/samples")
    samples = s.read.schema(samples.schema).parquet(f"{root}/samples")
    cuts = samples.select(F.percentile_approx(F.unix_micros("t"), [0.25, 0.5, 0.75], 1000).alias("q")).first()["q"] or []
    step = F.size(F.filter(F.array(*[F.lit(q).cast("long") for q in cuts]), lambda q: q < F.unix_micros("t"))) if cuts else F.lit(0)
    steps = [samples.where(step == k) for k in range(len(cuts) + 1)]
    for part in [*steps, live.heartbeat(samples)] if flush else steps:
        part.write.mode("append").parquet(f"{root}/in")
        stream = s.readStream.schema(samples.schema).parquet(f"{root}/in")
        query = build(stream).writeStream.outputMode(mode).option("checkpointLocation", f"{root}/state").format("parquet").option("path", f"{root}/out").trigger(availableNow=True).start()
        query.awaitTermination()
    return s.read.schema(build(stream).schema).parquet(f"{root}/out")


add("s09_stream_deduplicated", lambda s, d: _run(s, (lambda x: x.unionByName(x.where("id % 2 = 0")))(fx.telemetry(s, d).select("vin", "t", "id", "soc", "amps", "volts", "odo")), lambda x: live.deduplicated(x, "40 days")).select("id"), TELEMETRY, select="SELECT id FROM tel", columns="id:i")
add(
    "s10_stream_buckets",
    lambda s, d: _run(s, clean_samples(s, d), lambda x: live.bucket_aggregates(x, "1 day", "2 days"), flush=True).where("vin is not null"),
    TELEMETRY,
    select="SELECT vin, date_trunc('day', t)::TIMESTAMP AS bucket, count(*) AS n, avg(soc) AS soc, avg(volts) AS volts, avg(amps) AS amps, max(odo) AS odo_max FROM ok GROUP BY 1, 2",
    columns="vin:i bucket:t n:i soc:d volts:d amps:d odo_max:d",
)
add(
    "s11_stream_gap_sessions",
    lambda s, d: _run(s, clean_samples(s, d).select("vin", "t", "soc"), lambda x: live.gap_sessions(x, "12 hours", "2 days"), flush=True).where("vin is not null"),
    TELEMETRY,
    "gp AS (SELECT *, sum(CAST(coalesce(epoch_us(t) - epoch_us(before) >= 43200000000, true) AS BIGINT)) OVER (PARTITION BY vin ORDER BY t, id) AS sid FROM (SELECT *, lag(t) OVER (PARTITION BY vin ORDER BY t, id) AS before FROM ok))",
    select="SELECT vin, min(t) AS t0, count(*) AS n FROM gp GROUP BY vin, sid",
    columns="vin:i t0:t n:i",
)
add(
    "s11_stream_ordered_sessions",
    lambda s, d: _run(s, clean_samples(s, d).select("vin", "t", "id", "amps", "soc"), lambda x: live.ordered_sessions(x, GAP_S, "2 days"), flush=True),
    TELEMETRY,
    "os0 AS (SELECT *, epoch_us(t) / 1e6 - epoch_us(lag(t) OVER w) / 1e6 AS dt, lag(amps) OVER w AS prev FROM ok WINDOW w AS (PARTITION BY vin ORDER BY t, id))",
    f"os1 AS (SELECT *, dt IS NULL OR dt > {GAP_S} OR dt <= 0 AS start FROM os0)",
    "os2 AS (SELECT *, sum(CAST(start AS BIGINT)) OVER (PARTITION BY vin ORDER BY t, id) AS sid, CASE WHEN NOT start THEN (amps + prev) / 2 * dt / 3600 ELSE 0 END AS dq FROM os1)",
    select="SELECT vin, min(t) AS t0, arg_min(soc, (t, id)) AS soc0, arg_max(soc, (t, id)) AS soc1, sum(dq) AS ah, count(*) AS n FROM os2 GROUP BY vin, sid",
    columns="vin:i t0:t soc0:d soc1:d ah:e n:i",
)
add("s12_late_rows", lambda s, d: live.split_late(fx.telemetry(s, d), "2024-01-05")[1].select("id"), TELEMETRY, select="SELECT id FROM tel WHERE t < TIMESTAMP '2024-01-05'", columns="id:i")


def ingested(s: SparkSession, d: str) -> MonthStore:
    """Samples that come in four micro-batches: every seventh two batches late, every fifth once more with another reading."""
    root = f"{shared_folder(s)}/ingest-{uuid.uuid4().hex}"
    fx.telemetry(s, d).select("vin", "t", "id", "soc").write.parquet(f"{root}/samples")  # read by each step
    samples = s.read.parquet(f"{root}/samples")
    last = samples.agg(F.max("id")).first()[0] or 0
    step = F.floor(F.col("id") * 4 / (last + 1))
    first = samples.withColumns({"load": F.lit(0), "step": F.least(step + F.when(F.col("id") % 7 == 0, 2).otherwise(0), F.lit(3))})
    again = samples.where("id % 5 = 0").withColumns({"soc": F.col("soc") + 1, "load": F.lit(1), "step": F.least(step + 1, F.lit(3))})
    store, rows = MonthStore(s, f"{root}/store", ("vin", "t"), "load", parts=1), first.unionByName(again)
    for k in range(4):
        part = rows.where(F.col("step") == k).drop("step")
        part.write.mode("append").parquet(f"{root}/in")
        ingest.start(s.readStream.schema(part.schema).parquet(f"{root}/in"), store, "7 days").awaitTermination()
    return store


DELIVERED = (
    TELEMETRY,
    "stp AS (SELECT vin, t, id, soc, CAST(floor(id * 4 / ((SELECT max(id) FROM tel) + 1)) AS BIGINT) AS step FROM tel)",
    "dl AS (SELECT vin, t, id, soc, 0 AS load, least(step + CASE WHEN id % 7 = 0 THEN 2 ELSE 0 END, 3) AS step FROM stp UNION ALL SELECT vin, t, id, soc + 1, 1, least(step + 1, 3) FROM stp WHERE id % 5 = 0)",
    "hi AS (SELECT k, (SELECT max(t) FROM dl WHERE step < k) AS high FROM generate_series(0, 3) AS g(k))",
    "jd AS (SELECT *, coalesce(t < high - INTERVAL 7 DAY, false) AS late FROM dl JOIN hi ON k = step)",
)
add("s09_streamed_ingest", lambda s, d: ingested(s, d).read().select("vin", "t", "id", "soc", "load"), *DELIVERED, select="SELECT vin, t, arg_max(id, load) AS id, arg_max(soc, load) AS soc, max(load) AS load FROM jd WHERE NOT late GROUP BY vin, t", columns="vin:i t:t id:i soc:d load:i")
add("s12_streamed_late_rows", lambda s, d: ingest.late_rows(ingested(s, d), "vin long, t timestamp, id long, soc double, load int, missed timestamp, batch long"), *DELIVERED, select="SELECT id, load, step AS batch, high AS missed FROM jd WHERE late", columns="id:i load:i batch:i missed:t")
