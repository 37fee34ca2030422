"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset, a session of one machine gets a folder of its own, any other an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def cut_once(df: DataFrame) -> DataFrame:
    """:func:`cut` for rows that are dear to make: a checkpoint makes its rows twice, to count and to write them, unless they are cached meanwhile."""
    kept = df.persist()
    try:
        return cut(kept)
    finally:
        kept.unpersist()
