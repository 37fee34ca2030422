"""Toxicity by logistic regression with FTRL-proximal learning over hashed word n-grams and skip-grams.

Features are the words, adjacent word pairs, and word pairs with one word between, of the lower-cased text, each present or
not. Per-coordinate rates learn from one document at a time, and the L1 term leaves a few hundred weights, which are broadcast.
Learning is sequential, so it is one task's work on a sample of bounded size; scoring reads every document where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Features are hashed to so many bits, so the weights never exceed 2**20 numbers.
FEATURE_BITS = 20
#: Expected number of labelled documents in the training sample, the most that is learned from.
MAX_TRAIN = 16_384
#: Most text bytes that are learned from; cells of ids by a hash, in order, as many as stay within it (but one at least).
MAX_BYTES, CELLS = 128 << 20, 4096
PASSES = 3
ALPHA, BETA, L1 = 2.0, 1.0, 8.0


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word, pair and skip-pair, with repeats."""
    w = c.words_of([t.translate(c.LOWER) for t in texts], c.ALPHANUMERIC)
    hashes = c.word_hashes(w)[0]
    docs, keys = [w.doc], [c.mix(hashes ^ np.uint64(1))]
    for gap in (1, 2):
        n = max(0, len(hashes) - gap)
        same = w.doc[:n] == w.doc[gap:]
        docs.append(w.doc[:n][same])
        keys.append(c.mix(hashes[:n] * np.uint64(2 * gap + 1) + c.mix(hashes[gap:] ^ np.uint64(gap + 1)))[same])
    return np.concatenate(docs), (np.concatenate(keys) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _weights(z: np.ndarray, n: np.ndarray, least: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= least, 0.0, (np.sign(z) * least - z) * ALPHA / (BETA + np.sqrt(n)))


def _learn(table: pa.Table) -> pa.Table:
    """Weights that are not zero after all passes, in order of a hash of the ids. Feature -1 is the intercept, without L1."""
    z, n = np.zeros((1 << FEATURE_BITS) + 1), np.zeros((1 << FEATURE_BITS) + 1)
    least = np.append(np.full(1 << FEATURE_BITS, L1), 0.0)
    order = np.argsort(c.mix(c.ids_of(table.column("doc_id").combine_chunks()).view(np.uint64)), kind="stable")
    labels = table.column("label").to_numpy()
    present = [np.append(np.unique(_features([t])[1]), -1) for t in c.raw_texts(table.column("text"))]
    for _ in range(PASSES):
        for i in order.tolist():
            at = present[i]
            w = _weights(z[at], n[at], least[at])
            g = float(_sigmoid(w.sum()) - labels[i])
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = _weights(z, n, least)
    at = np.flatnonzero(w)
    return pa.table([pa.array(np.where(at == len(w) - 1, -1, at)), pa.array(w[at])], names=["feature", "weight"])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> dict[int, float]:
    """Weights by feature from labelled documents: ``labels`` has doc_id and label (0 or 1).

    Labels that are null or of unknown documents teach nothing; of several labels of one id the larger holds, of several texts
    the one that sorts first. With more than ``max_train`` labels, or more than ``MAX_BYTES`` of their texts, a sample by a hash
    of the id is taken.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    n = known.count()
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(max(n, 1))) < max_train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = c.cut(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    cell = F.pmod(F.xxhash64("doc_id", F.lit(19)), F.lit(CELLS))
    sizes = np.zeros(CELLS)
    for row in rows.groupBy(cell.alias("cell")).agg(F.sum(F.octet_length("text")).alias("size")).collect():  # a number for each cell
        sizes[row["cell"]] = row["size"] or 0
    within = max(1, int(np.searchsorted(np.cumsum(sizes), MAX_BYTES, "right")))
    while not sizes[:within].any() and within < CELLS:
        within += 1
    learned = rows.where(cell < within).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_learn, "feature long, weight double").toArrow()
    return dict(zip(learned.column("feature").to_pylist(), learned.column("weight").to_pylist(), strict=True))


def _scorer(shared):  # noqa: ANN001, ANN202
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << FEATURE_BITS)
        for i, w in shared.value.items():
            if i >= 0:
                weights[i] = w
        bias = shared.value.get(-1, 0.0)
        for batch in c.slices(batches):
            doc, key = _features(c.raw_texts(batch.column("text")))
            used = weights[key] != 0
            pairs = np.unique(doc[used] << FEATURE_BITS | key[used])
            sums = np.bincount(pairs >> FEATURE_BITS, weights=weights[pairs & ((1 << FEATURE_BITS) - 1)], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_sigmoid(sums + bias))], names=["doc_id", "score"])

    return score


def score_documents(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 if score >= 0.5) for each row; null texts have no words and score by the intercept."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scorer(shared), "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out():  # noqa: ANN201
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "labels")
    weights = train(docs, labels.where(~held_out()).select("doc_id", F.col("toxic").alias("label")))
    return score_documents(docs, weights).select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op9_toxicity": op9_toxicity}

ORACLE: dict[str, str] = {}
