"""Queries of sessions, events, segments and resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, events
from ..sources import fixtures as fx
from .base import TELEMETRY, Book

book = Book()
add = book.add

#: Samples are hours apart in the given tables, so the gap is wide here.
GAP_S = 43_200


def clean_samples(s: SparkSession, d: str) -> DataFrame:
    return clean.keep_inside(fx.telemetry(s, d), {"soc": (0, 100), "amps": (-400, 400)})


SESSIONS = f"""stp AS (SELECT *, epoch_us(t) / 1e6 - epoch_us(lag(t) OVER w) / 1e6 AS dt, lag(amps) OVER w AS prev, lag(soc) OVER w AS psoc, lag(odo) OVER w AS podo, lag(t) OVER w AS pt FROM ok WINDOW w AS (PARTITION BY vin ORDER BY t, id)),
brk AS (SELECT *, dt IS NULL OR dt > {GAP_S} OR dt <= 0 OR date_trunc('month', t) <> date_trunc('month', pt) AS start FROM stp),
ses AS (SELECT *, sum(CAST(start AS BIGINT)) OVER (PARTITION BY vin ORDER BY t, id) AS sid, CASE WHEN NOT start THEN (amps + prev) / 2 * dt / 3600 ELSE 0 END AS dq FROM brk),
rol AS (SELECT vin, sid, min(t) AS t0, max(t) AS t1, arg_min(soc, (t, id)) AS soc0, arg_max(soc, (t, id)) AS soc1, sum(dq) AS ah, count(*) AS n FROM ses GROUP BY vin, sid),
cap AS (SELECT * FROM (SELECT *, abs(soc1 - soc0) AS dsoc, abs(ah) / (abs(soc1 - soc0) / 100) AS cap FROM rol WHERE n >= 3 AND abs(soc1 - soc0) >= 2) WHERE cap BETWEEN 10 AND 4000)"""


def sessions(s: SparkSession, d: str) -> DataFrame:
    return events.sessions(clean_samples(s, d), GAP_S)


def rolled(s: SparkSession, d: str) -> DataFrame:
    return events.session_rollup(sessions(s, d))


def capacities(s: SparkSession, d: str) -> DataFrame:
    return events.session_capacity(rolled(s, d), 3, 2.0, (10.0, 4000.0))


add("c01_c02_session_steps", lambda s, d: sessions(s, d).select("id", "sid", "dq"), TELEMETRY, SESSIONS, select="SELECT id, sid, dq FROM ses", columns="id:i sid:i dq:d")
add("c03_session_rollup", rolled, TELEMETRY, SESSIONS, select="SELECT * FROM rol", columns="vin:i sid:i t0:t soc0:d soc1:d ah:d n:i")
add("c04_session_capacity", capacities, TELEMETRY, SESSIONS, select="SELECT * FROM cap", columns="vin:i sid:i dsoc:d cap:d n:i")
add(
    "c05_slope_capacity",
    lambda s, d: events.slope_capacity(sessions(s, d)),
    TELEMETRY,
    SESSIONS,
    select="SELECT * FROM (SELECT vin, sid, count(*) AS n, CASE WHEN var_pop(soc) > 0 THEN abs(regr_slope(q, soc) * 100) END AS cap FROM (SELECT *, sum(dq) OVER (PARTITION BY vin, sid ORDER BY t, id) AS q FROM ses) GROUP BY 1, 2) WHERE n >= 3 AND cap IS NOT NULL",
    columns="vin:i sid:i n:i cap:d",
)

CHARGE = f"""chk AS (SELECT *, CASE WHEN amps > 2 THEN 1 WHEN amps < -2 THEN -1 ELSE 0 END AS kind FROM stp),
chs AS (SELECT *, dt IS NULL OR dt > {GAP_S} OR kind <> lag(kind) OVER (PARTITION BY vin ORDER BY t, id) AS go FROM chk),
che AS (SELECT *, CASE WHEN NOT go THEN (abs(amps) + abs(prev)) / 2 * dt / 3600 ELSE 0 END AS de FROM (SELECT *, sum(CAST(go AS BIGINT)) OVER (PARTITION BY vin ORDER BY t, id) AS ev FROM chs) WHERE kind <> 0),
evr AS (SELECT *, row_number() OVER (PARTITION BY vin, ev ORDER BY t, id) AS up, row_number() OVER (PARTITION BY vin, ev ORDER BY t DESC, id DESC) AS down FROM che),
evt AS (SELECT vin, ev, min(t) AS t0, max(t) AS t1, arg_min(soc, (t, id)) AS soc0, arg_max(soc, (t, id)) AS soc1, sum(de) AS ah, count(*) AS n,
  CASE WHEN count(*) >= 3 THEN median(volts) FILTER (WHERE up <= 5) END AS v0, CASE WHEN count(*) >= 3 THEN median(volts) FILTER (WHERE down <= 5) END AS v1 FROM evr GROUP BY vin, ev)"""


def charge_events(s: SparkSession, d: str) -> DataFrame:
    return events.charge_events(clean_samples(s, d), 2.0, GAP_S)


def event_table(s: SparkSession, d: str) -> DataFrame:
    return events.event_rollup(charge_events(s, d))


add("c06_c07_charge_islands", lambda s, d: charge_events(s, d).select("id", "ev", "kind", "de"), TELEMETRY, SESSIONS, CHARGE, select="SELECT id, ev, kind, de FROM che", columns="id:i ev:i kind:i de:d")
add("c08_event_rollup", event_table, TELEMETRY, SESSIONS, CHARGE, select="SELECT * FROM evt", columns="vin:i ev:i t0:t soc0:d soc1:d ah:d n:i v0:d v1:d")
add(
    "c09_c10_full_charges",
    lambda s, d: event_table(s, d).select("vin", "ev", events.full_by_voltage(53.0, 54.0).cast("int").alias("by_volts"), events.full_by_soc(30.0, 80.0).cast("int").alias("by_soc")),
    TELEMETRY,
    SESSIONS,
    CHARGE,
    select="SELECT vin, ev, CAST(coalesce(v0 <= 53 AND v1 >= 54, false) AS INT) AS by_volts, CAST(coalesce(soc1 - soc0 >= 30 AND soc1 >= 80, false) AS INT) AS by_soc FROM evt",
    columns="vin:i ev:i by_volts:i by_soc:i",
)
add(
    "c11_adaptive_voltage_window",
    lambda s, d: events.adaptive_window(event_table(s, d).where("v0 is not null"), (0.25, 0.5, 0.75), (0.25, 0.5, 0.75), 1),
    TELEMETRY,
    SESSIONS,
    CHARGE,
    select="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY score DESC, va, vb) AS r FROM (SELECT p.vin, va, vb, count(*) FILTER (WHERE v0 <= va AND v1 >= vb) AS n, (vb - va) * sqrt(count(*) FILTER (WHERE v0 <= va AND v1 >= vb)) AS score
      FROM (SELECT vin, va, unnest(b) AS vb FROM (SELECT vin, unnest(quantile_cont(v0, [0.25, 0.5, 0.75])) AS va, quantile_cont(v1, [0.25, 0.5, 0.75]) AS b FROM evt WHERE v0 IS NOT NULL GROUP BY vin)) p JOIN evt e ON e.vin = p.vin AND e.v0 IS NOT NULL
      WHERE vb > va GROUP BY p.vin, va, vb) WHERE n >= 1) WHERE r = 1""",
    columns="vin:i va:d vb:d n:i score:d",
)
add(
    "c12_resistance_steps",
    lambda s, d: events.resistance_steps(clean_samples(s, d), 30.0, 3600.0),
    TELEMETRY,
    SESSIONS,
    select="SELECT vin, t, soc, di, abs(dv / di * 1000) AS r FROM (SELECT vin, t, soc, dt, amps - prev AS di, volts - lag(volts) OVER (PARTITION BY vin ORDER BY t, id) AS dv FROM stp) WHERE abs(di) >= 30 AND dt > 0 AND dt <= 3600",
    columns="vin:i t:t soc:d di:d r:d",
)
add(
    "c13_sample_per_vehicle",
    lambda s, d: events.sample_per_vehicle(clean_samples(s, d), 20).select("vin", "id"),
    TELEMETRY,
    select="SELECT vin, id FROM (SELECT vin, id, row_number() OVER (PARTITION BY vin ORDER BY md5(id::VARCHAR), id) AS r FROM ok) WHERE r <= 20",
    columns="vin:i id:i",
)
add(
    "c14_c15_drive_segments",
    lambda s, d: events.drive_segments(clean_samples(s, d), (0, 200), (1, 100), GAP_S, 6),
    TELEMETRY,
    SESSIONS,
    select=f"SELECT vin, t, dkm, dsoc FROM (SELECT *, odo - podo AS dkm, psoc - soc AS dsoc FROM stp) WHERE round(dkm, 6) > 0 AND round(dkm, 6) <= 200 AND round(dsoc, 6) > 1 AND round(dsoc, 6) <= 100 AND dt > 0 AND dt <= {GAP_S}",
    columns="vin:i t:t dkm:d dsoc:d",
)
CROSS = """crs AS (SELECT *, psoc < 30 AND soc >= 30 AS up_low, psoc < 70 AND soc >= 70 AS up_high, psoc - soc > 3 AS fall, psoc > 90 AND soc <= 90 AS down_high, psoc > 20 AND soc <= 20 AS down_low, soc - psoc > 3 AS rise FROM stp)"""
add(
    "c16_c18_crossing_rates",
    lambda s, d: events.consistent(events.crossing_rates(clean_samples(s, d))),
    TELEMETRY,
    SESSIONS,
    CROSS,
    select="""SELECT vin, t, t_high, rate FROM (SELECT *, rate / median(rate) OVER (PARTITION BY vin) AS rel FROM (SELECT vin, t, t_high, 40 / ((epoch_us(t_high) - epoch_us(t)) / 1e6 / 3600) AS rate
      FROM (SELECT c.*, (SELECT min(h.t) FROM crs h WHERE h.vin = c.vin AND h.up_high AND (h.t, h.id) >= (c.t, c.id)) AS t_high, (SELECT min(h.t) FROM crs h WHERE h.vin = c.vin AND h.fall AND (h.t, h.id) > (c.t, c.id)) AS t_fall FROM crs c WHERE c.up_low)
      WHERE t_high IS NOT NULL AND t_high > t AND (t_fall IS NULL OR t_fall > t_high))) WHERE rel BETWEEN 0.75 AND 1.33""",
    columns="vin:i t:t t_high:t rate:d",
)
add(
    "c17_falling_rates",
    lambda s, d: events.falling_rates(clean_samples(s, d), slack=60.0),
    TELEMETRY,
    SESSIONS,
    CROSS.replace("soc - psoc > 3 AS rise", "soc - psoc > 60 AS rise"),
    select="""SELECT c.vin, c.t, e.t AS t_low, (e.odo - c.odo) / 70 AS km_per_pct FROM (SELECT c.*, (SELECT min(h.t) FROM crs h WHERE h.vin = c.vin AND h.down_low AND (h.t, h.id) >= (c.t, c.id)) AS tl, (SELECT min(h.t) FROM crs h WHERE h.vin = c.vin AND h.rise AND (h.t, h.id) > (c.t, c.id)) AS tr FROM crs c WHERE down_high) c
      JOIN crs e ON e.vin = c.vin AND e.t = c.tl AND e.down_low WHERE c.tr IS NULL OR c.tr > c.tl""",
    columns="vin:i t:t t_low:t km_per_pct:d",
)
add(
    "c19_resample_last",
    lambda s, d: events.resample_last(clean.null_outside(fx.telemetry(s, d)), "1 day", ["soc", "amps"]),
    TELEMETRY,
    select="""SELECT * FROM (SELECT vin, date_trunc('day', t)::TIMESTAMP AS bucket, arg_max(soc, (t, id)) FILTER (WHERE soc BETWEEN 0 AND 100) AS soc, arg_max(amps, (t, id)) FILTER (WHERE abs(amps) <= 400) AS amps FROM tel GROUP BY 1, 2) WHERE soc IS NOT NULL AND amps IS NOT NULL""",
    columns="vin:i bucket:t soc:d amps:d",
)
add(
    "c20_resample_trace",
    lambda s, d: events.resample_trace(clean_samples(s, d), "5 minutes"),
    TELEMETRY,
    select="SELECT vin, time_bucket(INTERVAL 5 MINUTE, t)::TIMESTAMP AS bucket, arg_max(soc, (t, id)) AS soc, avg(volts) AS volts, avg(amps) AS amps FROM ok GROUP BY 1, 2",
    columns="vin:i bucket:t soc:d volts:d amps:d",
)
add(
    "c21_daily_median",
    lambda s, d: events.daily_median(clean_samples(s, d), "soc"),
    TELEMETRY,
    select="SELECT vin, date_trunc('day', t)::TIMESTAMP AS day, median(soc) AS soc, max(odo) AS odo FROM ok GROUP BY 1, 2",
    columns="vin:i day:t soc:d odo:d",
)
add(
    "c22_direction",
    lambda s, d: events.direction(clean_samples(s, d)).select("id", "way"),
    TELEMETRY,
    SESSIONS,
    select="SELECT id, CASE WHEN soc > psoc THEN 'charging' ELSE 'discharging' END AS way FROM stp WHERE soc <> psoc",
    columns="id:i way:s",
)
add(
    "c23_charge_curves",
    lambda s, d: events.charge_curves(charge_events(s, d), 20),
    TELEMETRY,
    SESSIONS,
    CHARGE,
    select="""SELECT vin, cycle, t, volts, ah FROM (SELECT *, sum(de) OVER (PARTITION BY vin, ev ORDER BY t, id) AS ah, dense_rank() OVER (PARTITION BY vin ORDER BY ev) AS cycle, row_number() OVER (PARTITION BY vin ORDER BY t, id) AS rn, count(*) OVER (PARTITION BY vin) AS rows FROM che) WHERE (rn - 1) % ceil(rows / 20)::BIGINT = 0""",
    columns="vin:i cycle:i t:t volts:d ah:d",
)
add(
    "c24_day_profile",
    lambda s, d: events.day_profile(clean_samples(s, d)),
    TELEMETRY,
    SESSIONS,
    select="SELECT vin, date_trunc('day', t)::TIMESTAMP AS day, count(*) AS n, max(soc) - min(soc) AS swing, max(odo) - min(odo) AS km, median(dt) AS cadence_s FROM stp GROUP BY 1, 2",
    columns="vin:i day:t n:i swing:d km:d cadence_s:d",
)
