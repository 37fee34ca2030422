"""Streaming ingest into a month-partitioned table: each micro-batch is merged once, late rows go to a table of their own.

The high water of a batch is the latest event time of all batches committed before it. A row that is older than that by more
than the look-back is late: it is not merged but reported. All that a batch writes is found again by its number, and its row in
the table of commits comes last. So a batch that is replayed after a failure, at whatever point, ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import MonthStore, found, merge

_COMMITS = "batch long, high timestamp, merged long, late long"


def commits(spark: SparkSession, folder: str) -> DataFrame | None:
    """batch, high (latest event time up to and with it), merged and late (rows) of each committed batch."""
    return found(spark, f"{folder}/commits", _COMMITS)


def late_rows(store: MonthStore, schema: str | None = None) -> DataFrame | None:
    """Late rows with the batch that brought them and the high water that they missed."""
    return found(store.spark, f"{store.folder}/late", schema)


def high_water(spark: SparkSession, folder: str, batch: int):  # noqa: ANN201
    """The latest event time of batches before ``batch``; None before the first."""
    known = commits(spark, folder)
    return None if known is None else known.where(F.col("batch") < batch).agg(F.max("high").alias("high")).first()["high"]


def into(store: MonthStore, lookback: str) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that takes a batch into ``store`` and commits it. ``lookback``: an interval like ``3 days``."""

    def take(rows: DataFrame, batch: int) -> None:
        spark, t = store.spark, F.col(store.t)
        known = commits(spark, store.folder)
        if known is not None and known.where(F.col("batch") == batch).limit(1).count():
            return
        high = high_water(spark, store.folder, batch)
        missed = F.coalesce(t < F.lit(high) - F.expr(f"interval {lookback}"), F.lit(False)) if high else F.lit(False)
        rows = rows.persist()
        late = rows.where(missed).withColumn("missed", F.lit(high).cast("timestamp"))
        late.write.mode("overwrite").parquet(f"{store.folder}/late/batch={batch}")
        merge(store, batch, rows.where(~missed))
        counts = rows.agg(F.greatest(F.max(t), F.lit(high).cast("timestamp")).alias("high"), F.count_if(~missed).alias("merged"), F.count_if(missed).alias("late"))
        counts.select(F.lit(batch).cast("long").alias("batch"), "high", "merged", "late").write.mode("overwrite").parquet(f"{store.folder}/commits/at={batch}")
        rows.unpersist()

    return take


def start(stream: DataFrame, store: MonthStore, lookback: str = "3 days", **trigger) -> StreamingQuery:  # noqa: ANN003
    """Run ``stream`` into ``store``; the stream's own state lies beside the table."""
    return stream.writeStream.foreachBatch(into(store, lookback)).option("checkpointLocation", f"{store.folder}/stream").trigger(**trigger or {"availableNow": True}).start()
