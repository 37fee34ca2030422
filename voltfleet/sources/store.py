"""A Parquet table partitioned by month that rows are merged into, one batch at a time.

A merge reads and rewrites only the months that its batch has rows in, by dynamic partition overwrite; files of other months
are not touched. Before any of them is replaced, the new contents of the affected months are written beside the table. If a run
dies in between, the batch's next run puts those in place again instead of merging into a table that is half replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental


class MonthStore(NamedTuple):
    """``keys`` tell rows apart within a month of ``t``; of rows with equal keys the one of greatest ``order`` stays, the newer batch's if equal.

    A merge writes a month as ``parts`` files at most, or a file for each ``file_rows`` rows if those are more.
    """

    spark: SparkSession
    folder: str
    keys: tuple[str, ...]
    order: str
    t: str = "t"
    parts: int = 8
    file_rows: int = 500_000

    @property
    def table(self) -> str:
        return f"{self.folder}/rows"

    def read(self, schema: str | None = None) -> DataFrame:
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(self.table)


def found(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table at ``path``, or None where there is none."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def merge(store: MonthStore, batch: int | str, rows: DataFrame) -> None:
    """Merge ``rows`` as ``batch``. Merging a batch again changes nothing: it finds what it staged, or its rows in place.

    Rows without a time or without a key take no part. The months that a batch touches come to the driver, with their numbers of rows.
    """
    spark, staged, done = store.spark, f"{store.folder}/staged/{batch}", f"{store.folder}/merged/{batch}"
    if found(spark, done, "batch string") is not None:
        return
    if found(spark, f"{staged}-ready", "batch string") is None:
        new = rows.dropna(subset=[store.t, *store.keys]).withColumn("month", F.date_format(F.date_trunc("month", store.t), "yyyy-MM-dd"))
        sizes = _sizes(new)
        if not sizes:
            _mark(spark, done, batch)
            return
        old = found(spark, store.table)
        kept = new.limit(0) if old is None else old.withColumn("month", F.date_format("month", "yyyy-MM-dd")).where(F.col("month").isin(list(sizes)))
        before = {} if old is None else _sizes(kept)
        parts = {m: max(store.parts, -(-(n + before.get(m, 0)) // store.file_rows)) for m, n in sizes.items()}
        merged = incremental.upsert(kept, new, [*store.keys, "month"], store.order)
        part = F.pmod(F.xxhash64(*store.keys), F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col("month")])
        # as many tasks as files, where Spark's own number is smaller
        many = [sum(parts.values())] if sum(parts.values()) > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
        merged.repartition(*many, "month", part).write.mode("overwrite").partitionBy("month").parquet(staged)
        _mark(spark, f"{staged}-ready", batch)
    spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(store.table)
    _mark(spark, done, batch)


def _sizes(rows: DataFrame) -> dict[str, int]:
    return {r["month"]: r["count"] for r in rows.groupBy("month").count().collect()}


def _mark(spark: SparkSession, path: str, batch: int | str) -> None:
    spark.range(1).select(F.lit(str(batch)).alias("batch")).write.mode("overwrite").parquet(path)
