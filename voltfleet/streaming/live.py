"""Streaming ingest, windowed aggregates, sessions and late data, with the semantics of the batch operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, delay: str = "3 days", keys: tuple[str, ...] = ("vin", "t")) -> DataFrame:
    """First row of each key within the watermark; the delay is the look-back of the batch job."""
    return stream.withWatermark("t", delay).dropDuplicatesWithinWatermark(list(keys))


def bucket_aggregates(stream: DataFrame, every: str, delay: str = "3 days") -> DataFrame:
    """Rows, means and extremes of each vehicle and tumbling bucket, given out once the watermark has passed it."""
    groups = stream.withWatermark("t", delay).groupBy("vin", F.window("t", every).alias("w"))
    return groups.agg(F.count("*").alias("n"), F.avg("soc").alias("soc"), F.avg("volts").alias("volts"), F.avg("amps").alias("amps"), F.max("odo").alias("odo_max")).select("vin", F.col("w.start").alias("bucket"), "n", "soc", "volts", "amps", "odo_max")


def gap_sessions(stream: DataFrame, gap: str = "5 minutes", delay: str = "1 day") -> DataFrame:
    """Sessions by gap alone, as Spark's session windows; steps that are not positive do not break these."""
    groups = stream.withWatermark("t", delay).groupBy("vin", F.session_window("t", gap).alias("w"))
    return groups.agg(F.count("*").alias("n"), F.min_by("soc", "t").alias("soc0"), F.max_by("soc", "t").alias("soc1")).select("vin", F.col("w.start").alias("t0"), "n", "soc0", "soc1")


#: Rows wait in buckets of this length.
BUCKET_S = 3600


def _joined(runs: Column, gap_s: float) -> Column:
    """Runs of rows in order of time, joined where the step between them is positive and at most the gap; charge by trapezoid."""
    step = lambda a, b: b["t0"] - a["t1"]
    starts = lambda i: (i == 1) | (step(runs[i - 2], runs[i - 1]) <= 0) | (step(runs[i - 2], runs[i - 1]) > gap_s)
    first = F.filter(F.sequence(F.lit(1), F.size(runs)), starts)
    parts = F.transform(first, lambda at, k: F.slice(runs, at, F.coalesce(F.get(first, k + 1), F.size(runs) + 1) - at))
    between = lambda a, b: F.coalesce((a["amps1"] + b["amps0"]) / 2 * step(a, b) / 3600, F.lit(0.0))

    def one(p: Column) -> Column:
        head, last = p[0], F.element_at(p, -1)
        rest = F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: between(a, b) + b["ah"])
        ah = F.aggregate(rest, head["ah"], lambda total, x: total + x)
        n = F.aggregate(p, F.lit(0).cast("long"), lambda total, x: total + x["n"])
        return F.struct(head["t0"].alias("t0"), head["id"].alias("id"), last["t1"].alias("t1"), head["amps0"].alias("amps0"), last["amps1"].alias("amps1"), head["soc0"].alias("soc0"), last["soc1"].alias("soc1"), ah.alias("ah"), n.alias("n"))

    return F.transform(parts, one)


def ordered_sessions(stream: DataFrame, gap_s: float = 300.0, delay: str = "1 day") -> DataFrame:
    """Sessions with trapezoid charge, as the batch operator cuts them: at gaps and at steps that are not positive.

    Rows may come in any order within the delay. They wait in buckets of time until the watermark has passed a bucket's end, and
    are joined to runs there. A vehicle's runs wait while its buckets follow each other within the gap and a bucket's length; a
    batch writes the buckets that its rows are of, whatever else waits. Rows without a vin only move the watermark, see
    :func:`heartbeat`.
    """
    seconds = F.unix_micros("t") / 1e6
    row = F.struct(seconds.alias("t0"), F.col("id"), seconds.alias("t1"), F.col("amps").alias("amps0"), F.col("amps").alias("amps1"), F.col("soc").alias("soc0"), F.col("soc").alias("soc1"), F.lit(0.0).alias("ah"), F.lit(1).cast("long").alias("n"))
    # a filter on the vin would be pushed below the watermark, where the heartbeat must pass; a bucket without rows gives no run
    rows = F.collect_list(F.when(F.col("vin").isNotNull(), row))
    buckets = stream.withWatermark("t", delay).groupBy("vin", F.window("t", f"{BUCKET_S} seconds").alias("w")).agg(F.array_sort(rows).alias("rows"))
    runs = buckets.where(F.size("rows") > 0).select("vin", F.window_time("w").alias("at"), _joined(F.col("rows"), gap_s).alias("runs"))
    chains = runs.groupBy("vin", F.session_window("at", f"{math.ceil(gap_s) + BUCKET_S} seconds")).agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"))
    done = chains.select("vin", F.explode(_joined(F.col("runs"), gap_s)).alias("s"))
    return done.select("vin", F.timestamp_micros((F.col("s.t0") * 1e6).cast("long")).alias("t0"), "s.soc0", "s.soc1", "s.ah", "s.n")


def heartbeat(samples: DataFrame, ahead: str = "3650 days") -> DataFrame:
    """One row without a vin, far after all samples: last of a stream, it moves the watermark past everything that is still open."""
    last = samples.agg((F.max("t") + F.expr(f"interval {ahead}")).alias("t"))
    return last.select(*[F.col("t") if n == "t" else F.lit(None).cast(kind).alias(n) for n, kind in samples.dtypes])


def split_late(batch: DataFrame, oldest: str) -> tuple[DataFrame, DataFrame]:
    """(rows to process, late rows): late ones are older than the look-back and go to a report."""
    late = F.col("t") < F.to_timestamp(F.lit(oldest))
    return batch.where(~late), batch.where(late)
