"""SQL of the projections in ``sources.fixtures``, and helpers that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

TELEMETRY = """tel AS (SELECT user_id AS vin, ts AS t, event_id AS id, k * 1.2 AS soc, 50 - value AS amps, 48 + k / 10 AS volts,
  sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS odo, 20 + value / 20 AS temp, 1.3 * k + value / 50 AS rem_cap, event_type AS mode
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)),
ok AS (SELECT * FROM tel WHERE soc BETWEEN 0 AND 100 AND abs(amps) <= 400)"""

SERIES = """ser0 AS (SELECT l_suppkey AS vin, date_trunc('month', l_shipdate)::TIMESTAMP AS month, count(*) AS n, avg(l_quantity) AS q, sum(l_quantity) * 10 AS km_month,
  sum(l_extendedprice) / 1000 AS ah_throughput, 25 + 100 * max(l_discount) AS temp_max, avg(CAST(l_returnflag = 'A' AS DOUBLE)) AS frac_soc_high,
  avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS frac_soc_low, avg(l_tax) * 1000 AS dod_mean FROM lineitem GROUP BY 1, 2),
ser1 AS (SELECT *, date_diff('day', min(month) OVER (PARTITION BY vin), month) / 30.4 AS age_months FROM ser0),
ser2 AS (SELECT *, 130 * (1 - 0.004 * age_months) + (q - 25.5) * 0.8 AS cap_raw FROM ser1),
ser AS (SELECT *, least(100.0, 100 * cap_raw / median(cap_raw) FILTER (WHERE age_months < 3) OVER (PARTITION BY vin)) AS soh_raw FROM ser2)"""

REGISTRATION = """reg AS (SELECT f.vin, CASE WHEN f.vin % 5 <> 0 THEN first_month - to_months((f.vin % 7)::INT) END AS regd_date, r_name AS oem
  FROM (SELECT l_suppkey AS vin, date_trunc('month', min(l_shipdate))::TIMESTAMP AS first_month FROM lineitem GROUP BY 1) f
  JOIN supplier ON s_suppkey = f.vin JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def sql(*parts: str, select: str) -> str:
    """A query with the named projections in front."""
    return f"WITH RECURSIVE {', '.join(parts)}\n{select}" if parts else select


def rounded(df: DataFrame, coarse: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded (``coarse`` ones to four decimals), timestamps and dates as text: what two engines agree on."""
    new = {}
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            new[name] = F.round(F.col(name).cast("double"), 4 if name in coarse else 6) + F.lit(0.0)
        elif kind in ("timestamp", "date", "timestamp_ntz"):
            new[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("int", "smallint", "tinyint"):
            new[name] = F.col(name).cast("long")
    return df.withColumns(new)


def same(select: str, columns: dict[str, str]) -> str:
    """SQL around ``select`` that gives columns as :func:`rounded` does; kinds: d double, e coarse double, t timestamp, i integer, s as it is."""
    form = {"d": "round({0}::DOUBLE, 6) + 0.0", "e": "round({0}::DOUBLE, 4) + 0.0", "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')", "i": "{0}::BIGINT", "s": "{0}"}
    return "SELECT " + ", ".join(form[kind].format(f'"{name}"') + f' AS "{name}"' for name, kind in columns.items()) + f" FROM ({select}) AS final"


class Book:
    """Collects queries with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, query: Query, *parts: str, select: str | None = None, columns: str | None = None) -> None:
        """``columns``: names with their kind, like ``vin:i month:t soh:d``. Without SQL the query has no oracle."""
        if columns is None:
            self.queries[name] = lambda spark, d: rounded(query(spark, d))
            return
        kinds = dict(x.split(":") for x in columns.split())
        coarse = tuple(n for n, kind in kinds.items() if kind == "e")
        self.queries[name] = lambda spark, d: rounded(query(spark, d).select(*kinds), coarse)
        if select is not None:
            self.oracle[name] = sql(*parts, select=same(select, kinds))
