"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised by a codebook each, so K + K centroids make K * K cells. A query visits cells in order
of the sum of its halves' squared distances to their centroids, which a heap gives one by one, until the visited cells hold the
wanted number of rows; what they hold is ranked by exact distance. That number is learned: some sample queries are compared with
all rows, and it is how many rows each must visit to meet its true neighbours. How small a share of the table that is depends on
the vectors: a few in a hundred where they form clusters, up to a third where 64 dimensions are filled evenly.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

K = 10
#: Expected number of vectors in the sample that codebooks are fitted on, and the numbers it may hold.
SAMPLE, SAMPLE_NUMBERS = 16_384, 1 << 23
#: Sample queries that are compared with all rows, and the share of their neighbours that the visited rows must hold.
TRIALS, RECALL = 256, 0.95
#: Bounds for the centroids of a half; K * K cell counts are at most 65,536 numbers.
CENTROIDS = (4, 256)
#: Rows that are compared in one task, and the numbers that they may hold.
PART_ROWS, PART_NUMBERS = (2048, 65_536), 1 << 23
#: Queries that meet a part's rows in one task, about, and the sums that are held at once.
QUERY_ROWS, HELD = 32_768, 1 << 21
ROUNDS, SEED = 12, 5


class Index(NamedTuple):
    """first, second: centroids of the halves; counts: rows of each cell; visits: rows to visit.

    bins: the bin of each first centroid, some of which share one; splits: the parts that each bin's rows are dealt to.
    """

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    visits: int
    bins: np.ndarray
    splits: np.ndarray


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)


def _codebook(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's k-means on the sample."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        own = _squares(x, centres).argmin(1)
        sums, n = np.zeros_like(centres), np.bincount(own, minlength=len(centres))
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]


def _assign(x: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = _halves(x)
    return _squares(a, first).argmin(1), _squares(b, second).argmin(1)


def traverse(near: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cells (i, j) by rising near[i] + far[j]: a heap holds the border of those visited."""
    rows, cols = np.argsort(near, kind="stable").tolist(), np.argsort(far, kind="stable").tolist()
    heap = [(near[rows[0]] + far[cols[0]], 0, 0)]
    while heap:
        _, r, s = heappop(heap)
        yield rows[r], cols[s]
        if s + 1 < len(cols):
            heappush(heap, (near[rows[r]] + far[cols[s + 1]], r, s + 1))
        if s == 0 and r + 1 < len(rows):
            heappush(heap, (near[rows[r + 1]] + far[cols[0]], r + 1, 0))


def _needed(counts: np.ndarray, near: np.ndarray, far: np.ndarray, cells: list[tuple[int, int]]) -> list[int]:
    """Rows that a query visits before it is through with each of the given cells."""
    sums, own = (near[:, None] + far[None]).reshape(-1), np.array([near[i] + far[j] for i, j in cells])
    edges = np.sort(own)
    reached = np.cumsum(np.bincount(np.searchsorted(edges, sums), weights=counts.reshape(-1), minlength=len(edges) + 1))
    return reached[np.searchsorted(edges, own)].astype(np.int64).tolist()


def _bins(sizes: np.ndarray, part_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring first centroids share a bin of up to ``part_rows`` rows; one with more is dealt to several parts."""
    bins, splits, held = np.zeros(len(sizes), dtype=np.int64), [], 0
    for i, n in enumerate(sizes.tolist()):
        if not splits or held + n > part_rows:
            splits.append(1)
            held = 0
        held += n
        bins[i] = len(splits) - 1
        splits[-1] = max(1, -(-held // part_rows))
    return bins, np.array(splits)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vector.isNotNull() & F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _cells(shared):  # noqa: ANN001, ANN202
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value
        for batch in batches:
            if batch.num_rows:
                i, j = _assign(_matrix(batch.column("vector")), first, second)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], names=["vec_id", "vector", "first", "second"])

    return rows


def _trial(k: int, ids: np.ndarray, points: np.ndarray):  # noqa: ANN202
    """The k nearest of a task's rows for each trial query, with their cells."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[np.empty(0, dtype=t) for t in (np.float64, np.int64, np.int32, np.int32)] for _ in ids]
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, HELD // len(ids))):
                part = batch.slice(at, max(1, HELD // len(ids)))
                apart, own = _squares(points, _matrix(part.column("vector"))), part.column("vec_id").to_numpy()
                apart[ids[:, None] == own[None]] = np.inf
                few = min(k, apart.shape[1])
                nearest = np.argpartition(apart, few - 1, axis=1)[:, :few]
                for q, found in enumerate(nearest):
                    new = (apart[q, found], own[found], part.column("first").to_numpy()[found], part.column("second").to_numpy()[found])
                    both = [np.concatenate(x) for x in zip(best[q], new, strict=True)]
                    order = np.lexsort((both[1], both[0]))[:k]
                    best[q] = [x[order] for x in both]
        columns = [np.concatenate(x) for x in zip(*best, strict=True)]
        trial = np.repeat(np.arange(len(ids)), [len(x[0]) for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(trial.astype(np.int32)), *map(pa.array, columns)], names=["trial", "apart", "vec_id", "first", "second"])

    return rows


def _probes(shared):  # noqa: ANN001, ANN202
    """A row for each part that a query visits, with the sum at which its traversal ends."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            which, bins, splits, ends = [], [], [], []
            for at in range(0, batch.num_rows, 1024):
                x = _matrix(batch.column("vector").slice(at, 1024))
                a, b = (_squares(h, centres) for h, centres in zip(_halves(x), (index.first, index.second), strict=True))
                for q in range(len(x)):
                    seen, touched, end = 0, set(), 0.0
                    for i, j in traverse(a[q], b[q]):
                        if index.counts[i, j]:
                            touched.add(int(index.bins[i]))
                            seen += index.counts[i, j]
                            end = a[q, i] + b[q, j]
                            if seen >= index.visits:
                                break
                    for bin_ in sorted(touched):
                        parts = range(int(index.splits[bin_]))
                        which.extend([at + q] * len(parts))
                        bins.extend([bin_] * len(parts))
                        splits.extend(parts)
                        ends.extend([float(end)] * len(parts))
            taken = pa.array(which, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(taken), batch.column("vector").take(taken), pa.array(bins, type=pa.int32()), pa.array(splits, type=pa.int32()), pa.array(ends, type=pa.float64())],
                names=["query_id", "vector", "bin", "split", "end"],
            )

    return rows


def _rank(k: int, first: np.ndarray, second: np.ndarray):  # noqa: ANN202
    """The k nearest, by exact distance, of those of a part's rows whose cell each query visits."""

    def rank(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if rows.num_rows and queries.num_rows:
            x, ids = _matrix(rows.column("vector").combine_chunks()), rows.column("vec_id").to_numpy()
            i, j, norms = rows.column("first").to_numpy(), rows.column("second").to_numpy(), (x * x).sum(1)
            points, ends = _matrix(queries.column("vector").combine_chunks()), queries.column("end").to_numpy()
            block = max(1, HELD // max(len(x), len(first), len(second)))
            for q, query in enumerate(queries.column("query_id").to_pylist()):
                if q % block == 0:
                    a, b = _halves(points[q : q + block])
                    sums = _squares(a, first)[:, i] + _squares(b, second)[:, j]
                at = np.flatnonzero((sums[q % block] <= ends[q] + 1e-9 * (1 + ends[q])) & (ids != query))
                visited = len(at)
                if len(at) > k:  # all that rounding might put among the nearest
                    size = (points[q] ** 2).sum()
                    own = norms[at] - 2 * (x[at] @ points[q]) + size
                    edge = np.partition(own, k - 1)[k - 1]
                    at = at[own <= edge + 1e-9 * (1 + abs(edge) + size)]
                exact = np.sqrt(((x[at] - points[q]) ** 2).sum(1))
                best = np.lexsort((ids[at], exact))[:k]
                out[0].extend([query] * len(best))
                out[1].extend(ids[at][best].tolist())
                out[2].extend(exact[best].tolist())
                out[3].extend([visited] * len(best))
        return pa.table([pa.array(v, type=t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)], names=["query_id", "vec_id", "score", "visited"])

    return rank


def _good(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows that take part, their number and dimensions."""
    good = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    sizes = good.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    d, n = (sizes["d"], sizes["count"]) if sizes else (2, 0)
    return good.where(F.size("vector") == d), n, d


def build(good: DataFrame, n: int, d: int, k: int = K) -> tuple[Index, DataFrame]:
    """The index of n vectors, and the vectors with the cell of each; codebooks come from a bounded sample, counts from all rows."""
    most = max(1, min(SAMPLE, SAMPLE_NUMBERS // d))
    sample = good.where(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(max(n, 1))) < most).select("vec_id", "vector").toArrow()
    order = np.argsort(c.mix(sample.column("vec_id").to_numpy().view(np.uint64)), kind="stable")
    x, ids = (_matrix(sample.column("vector").combine_chunks())[order], sample.column("vec_id").to_numpy()[order]) if sample.num_rows else (np.zeros((1, d)), np.zeros(1, dtype=np.int64))
    centroids = int(np.clip(round(n**0.5), *CENTROIDS))
    first, second = (_codebook(h, min(centroids, len(h))) for h in _halves(x))
    indexed = good.mapInArrow(_cells(good.sparkSession.sparkContext.broadcast((first, second))), "vec_id long, vector array<double>, first int, second int")
    counts = np.zeros((len(first), len(second)), dtype=np.int64)
    for row in indexed.groupBy("first", "second").count().collect():  # a number for each cell
        counts[row["first"], row["second"]] = row["count"]
    nearest_first = Window.partitionBy("trial").orderBy("apart", "vec_id")
    true = indexed.mapInArrow(_trial(k, ids[:TRIALS], x[:TRIALS]), "trial int, apart double, vec_id long, first int, second int").withColumn("rank", F.row_number().over(nearest_first))
    cells: dict[int, list[tuple[int, int]]] = {}
    for row in true.where((F.col("rank") <= k) & (F.col("apart") < float("inf"))).select("trial", "first", "second").collect():  # k rows for each trial
        cells.setdefault(row["trial"], []).append((row["first"], row["second"]))
    a, b = (_squares(h, centres) for h, centres in zip(_halves(x[:TRIALS]), (first, second), strict=True))
    needed = [v for q, own in cells.items() for v in _needed(counts, a[q], b[q], own)]
    visits = int(np.ceil(np.quantile(needed, RECALL))) if needed else n
    part_rows = min(int(np.clip(n // 64, *PART_ROWS)), max(1, PART_NUMBERS // d))
    return Index(first, second, counts, max(1, visits), *_bins(counts.sum(1), part_rows)), indexed


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for each row of ``vectors`` (vec_id, vector) that is_query holds for.

    visited is how many rows the query was compared with in the part where the neighbour lay. Vectors that are null, zero, not
    finite, or not of the most common length take no part, nor do rows with a null id. A query is not its own neighbour; of
    repeated ids each row counts. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    good, n, d = _good(vectors)
    index, indexed = build(good, n, d, k)
    each = lambda numbers, at: F.element_at(F.array(*[F.lit(int(p)) for p in numbers]), F.col(at) + 1)
    queries = good.where(is_query).mapInArrow(_probes(spark.sparkContext.broadcast(index)), "query_id long, vector array<double>, bin int, split int, end double")
    queries = c.cut(queries)
    blocks = np.ones(len(index.splits), dtype=np.int64)
    for row in queries.groupBy("bin").agg(F.count_if(F.col("split") == 0).alias("n")).collect():  # a number for each bin
        blocks[row["bin"]] = max(1, -(-row["n"] // QUERY_ROWS))
    dealt = indexed.withColumn("bin", each(index.bins, "first")).withColumn("split", F.pmod(F.xxhash64("vec_id"), each(index.splits, "bin")).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), each(blocks, "bin") - 1)))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(SEED)), each(blocks, "bin")).cast("int"))
    task = ("bin", "split", "block")
    found = dealt.groupBy(*task).cogroup(queries.groupBy(*task)).applyInArrow(_rank(k, index.first, index.second), "query_id long, vec_id long, score double, visited long")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "visited")


def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = c.read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {"op1_inverted_multi_index": op1_inverted_multi_index}

ORACLE: dict[str, str] = {}
