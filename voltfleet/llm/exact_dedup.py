"""Exact de-duplication against a persistent index of digests.

The index is a table of one row for each text ever seen, bucketed and sorted by the text's SHA-256, with a partition for each
batch that added to it. A new batch is folded to its distinct digests, dealt into the index's buckets, freed by a sort-merge
anti-join of those that earlier batches have, and the rest is appended. The index is never shuffled for that. Beside it lies,
for each batch, a table of its rows with their digests; a report joins the two.

The newest batch can be ingested again, say after a failure, and replaces what it wrote before. Rows of earlier batches stay before those
of later ones, and within a batch the row with the smallest doc_id stays.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Digests of a bucket, about, that a new index is laid out for, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 2_000_000, 8


class Index(NamedTuple):
    """An index in ``folder``, as the catalog's table ``name``."""

    spark: SparkSession
    folder: str
    name: str
    buckets: int

    @property
    def rows(self) -> DataFrame:
        """digest, doc_id and row of the one that stays, batch."""
        return self.spark.table(self.name)

    @property
    def members(self) -> str:
        return f"{self.folder}/members"


def digest_of(text: Column) -> Column:
    """SHA-256 of a text in which each run of ASCII white space is one space; a null text is empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256))


def open_index(spark: SparkSession, folder: str, buckets: int = LEAST_BUCKETS) -> Index:
    """The index in ``folder``, new or as other sessions left it; ``buckets`` must be what it was made with."""
    name = f"digests_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, doc_id BIGINT, row BIGINT, batch INT) USING parquet PARTITIONED BY (batch) "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}/digests'"
    )
    spark.createDataFrame([], "digest binary, doc_id long, row long, batch int").write.insertInto(name)  # makes a new index's folder
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return Index(spark, folder, name, buckets)


def ingest(index: Index, batch: int, docs: DataFrame) -> None:
    """Add ``docs`` (doc_id, text) as batch number ``batch``, which comes after all with smaller numbers.

    Rows are numbered as they are written, so that one of equal rows with equal ids can stay. Copies are folded before they
    are dealt. The members' table comes first: if a run fails between the two, the batch's next run replaces it. What is new
    is checkpointed, since Spark overwrites no table that it reads.
    """
    spark, at = index.spark, f"{index.members}/batch={batch}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), digest_of(F.col("text")).alias("digest"))
    rows.write.mode("overwrite").parquet(at)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    heads = spark.read.parquet(at).groupBy("digest").agg(first).select("digest", "first.doc_id", "first.row").repartition(index.buckets, "digest")
    seen = index.rows.where(F.col("batch") < batch).select("digest")
    _replace(index, batch, heads.join(seen.hint("merge"), "digest", "left_anti"))


def _replace(index: Index, batch: int, rows: DataFrame) -> None:
    index.spark.sql(f"INSERT OVERWRITE {index.name} PARTITION (batch = {int(batch)}) SELECT digest, doc_id, row FROM {{rows}}", rows=c.cut(rows))


def groups(index: Index) -> DataFrame:
    """digest, keep_id, keep_batch, keep_row and group_size (rows of all batches) of each text ever seen."""
    sizes = index.spark.read.parquet(index.members).groupBy("digest").agg(F.count("*").alias("group_size")).repartition(index.buckets, "digest")
    stays = index.rows.select("digest", F.col("doc_id").alias("keep_id"), F.col("batch").alias("keep_batch"), F.col("row").alias("keep_row"))
    return stays.hint("merge").join(sizes, "digest")


def report(index: Index) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and batch for each row of all batches.

    Exactly one row of each group is kept, also where rows repeat whole. Null ids come after others; if all of a group are
    null, keep_id is null and one row is kept. An empty index has no rows. Groups that hold over a thousandth of all rows
    (fewer than a thousand) are joined from a broadcast, so no task gets all rows of one.
    """
    of_all = c.cut(groups(index))
    rows = index.spark.read.schema("doc_id long, row long, digest binary, batch int").parquet(index.members)
    total = of_all.agg(F.sum("group_size")).first()[0] or 0
    hot = of_all.where(F.col("group_size") > max(c.FEW, total / 1000))
    joined = _joined(rows, of_all, hot, [r["digest"] for r in hot.select("digest").collect()])
    kept = (F.col("batch") == F.col("keep_batch")) & (F.col("row") == F.col("keep_row"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "batch")


def _joined(rows: DataFrame, of_all: DataFrame, hot: DataFrame, digests: list[bytes]) -> DataFrame:
    if not digests:
        return rows.join(of_all, "digest")
    many = F.col("digest").isin(digests)
    return rows.where(~many).join(of_all.where(~many), "digest").unionByName(rows.where(many).join(F.broadcast(hot), "digest"))


def compact(index: Index) -> None:
    """Rewrite each batch's partition as it is, each bucket as one sorted file."""
    for found in index.rows.select("batch").distinct().collect():
        _replace(index, found["batch"], index.rows.where(F.col("batch") == found["batch"]).repartition(index.buckets, "digest"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two batches, the lower half of the range of ids first, so that the smallest id of all stays."""
    docs = c.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    index = open_index(spark, f"{c.shared_folder(spark)}/exact-{uuid.uuid4().hex}", max(LEAST_BUCKETS, -(-n // BUCKET_ROWS)))
    early = F.coalesce(F.col("doc_id") < F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    ingest(index, 1, docs.where(early))
    ingest(index, 2, docs.where(~early))
    return report(index).drop("batch")


QUERIES = {"op11_exact_dedup": op11_exact_dedup}

ORACLE = {
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
}
