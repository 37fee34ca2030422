"""Benchmark decontamination by winnowing.

Of every run of ``WINDOW`` words the smallest k-gram hash is a fingerprint (the rightmost of equal ones), so a document and
a benchmark item that share a whole window always share that fingerprint at the same place of the window. The benchmark's
fingerprints are joined to the documents', and each hit is extended to all windows around it, which are then compared as a
whole by a 128-bit hash of BLAKE2 digests of their words. Items of fewer words are compared as one window of their length.

A benchmark of up to ``PART_WINDOWS`` windows is broadcast and documents are judged where they lie. A larger one stays a table:
distinct texts send their fingerprints, and of those that the benchmark has the windows around them, to two shuffled joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from . import common as c

WINDOW = 10
#: Words of a k-gram; a window holds WINDOW - K + 1 of them.
K = 5
#: Most benchmark windows that are broadcast (about 40 bytes each).
PART_WINDOWS = 1_000_000

_WINDOWS = "item_id long, size int, low long, high long, print long"


class Index(NamedTuple):
    """Distinct windows of a benchmark, sorted by ``low``, the items of each, on end, and the fingerprints of each size."""

    size: np.ndarray
    low: np.ndarray
    high: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    prints: dict[int, np.ndarray]


def _prints(low: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each window and its place: the smallest K-gram hash, the rightmost of equal ones; of fewer words their hash."""
    n = max(0, len(low) - size + 1)
    grams = c.gram_hashes(low, min(K, size))
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, size - K + 1):
        better = grams[j : j + n] <= best
        best = np.where(better, grams[j : j + n], best)
        at = np.where(better, np.arange(j, j + n), at)
    return best, at


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        ids = c.ids_of(batch.column("item_id"))
        w = c.words_of([t.translate(c.LOWER) for t in c.raw_texts(batch.column("text"))], c.ALPHANUMERIC)
        hashes, counts = c.word_hashes(w), np.diff(w.first)
        for size in np.unique(np.minimum(counts, WINDOW)).tolist():
            if not size:
                continue
            low, high = (c.gram_hashes(h, size) for h in hashes)
            fit = c.whole(w, size) & ((counts[w.doc[: len(low)]] == size) | (size == WINDOW) & (counts[w.doc[: len(low)]] >= size))
            marks = _prints(hashes[0], size)[0]
            yield pa.RecordBatch.from_arrays(
                [c.ids_back(ids[w.doc[: len(low)][fit]]), pa.array(np.full(int(fit.sum()), size, dtype=np.int32)), *(pa.array(x[fit].view(np.int64)) for x in (low, high, marks))],
                names=["item_id", "size", "low", "high", "print"],
            )


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of every item with their fingerprint. Items with a null id or no words have none."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.where("item_id is not null").mapInArrow(_window_rows, _WINDOWS).distinct()


def _index(windows: pa.Table) -> Index:
    col = {n: windows.column(n).to_numpy() for n in windows.column_names}
    low, high, size = col["low"].view(np.uint64), col["high"].view(np.uint64), col["size"]
    order = np.lexsort((size, high, low))
    keys = np.stack([low[order], high[order], size[order].astype(np.uint64)])
    first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if len(order) else np.empty(0, dtype=np.int64)
    at = order[first]
    return Index(size[at], low[at], high[at], np.append(first, len(order)), col["item_id"][order], {int(s): np.unique(col["print"].view(np.uint64)[size == s]) for s in np.unique(size)})


def _member(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(x), dtype=bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)] == x


def _candidates(prints: np.ndarray, size: int, w: c.Words, low: np.ndarray) -> np.ndarray:
    """Starts of windows around the documents' fingerprints that the benchmark has too."""
    ok = c.whole(w, size)
    if not len(ok):
        return np.empty(0, dtype=np.int64)
    best, at = _prints(low, size)
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = at[1:] != at[:-1]
    return np.flatnonzero(_member(prints, best[fresh])[np.cumsum(fresh) - 1] & ok)


def _matches(index: Index, size: int, starts: np.ndarray, hashes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, number of the benchmark's window) for those of ``starts`` that begin one; a start has at most one of a size."""
    keep = np.flatnonzero(index.size == size)
    low = index.low[keep]
    mine_low, mine_high = (c.gram_hashes(h, size, starts) for h in hashes)
    left, right = np.searchsorted(low, mine_low), np.searchsorted(low, mine_low, "right")
    n = right - left  # over 1 only where halves of hashes are equal by chance
    which = np.repeat(np.arange(len(starts)), n)
    places = keep[np.repeat(left, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
    same = index.high[places] == mine_high[which]
    return starts[which[same]], places[same]


def _split(texts: list[bytes]) -> tuple[c.Words, tuple[np.ndarray, np.ndarray]]:
    w = c.words_of([t.translate(c.LOWER) for t in texts], c.ALPHANUMERIC)
    return w, c.word_hashes(w)


def _with(batch: pa.RecordBatch, hits: list[bytes], items: list) -> pa.RecordBatch:
    new = {"hit": pa.array(hits, type=pa.binary()), "items": pa.array(items, type=pa.list_(pa.int64()))}
    names = [n for n in batch.schema.names if n not in (*new, "marks", "found")] + list(new)
    return pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)


def _finder(shared):  # noqa: ANN001, ANN202
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in c.slices(batches):
            w, hashes = _split(c.raw_texts(batch.column("text")))
            hit, pairs = np.zeros(len(w.doc), dtype=bool), [np.empty((0, 2), dtype=np.int64)]
            for size, prints in index.prints.items():
                at, window = _matches(index, size, _candidates(prints, size, w, hashes[0]), hashes)
                hit |= c.covered(at, size, len(hit))
                pairs.append(np.unique(np.stack([w.doc[at], window], axis=1).astype(np.int64), axis=0))  # a text's repeats count once
            doc, window = np.concatenate(pairs).T
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1), sorter=(order := np.argsort(doc, kind="stable")))
            found = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                mine = [index.item[index.starts[k] : index.starts[k + 1]] for k in window[order[a:b]].tolist()]
                found.append(np.unique(np.concatenate(mine)) if mine else np.empty(0, dtype=np.int64))
            yield _with(batch, [hit[a:b].tobytes() for a, b in zip(w.first[:-1], w.first[1:], strict=True)], found)

    return find


def _emit_prints(sizes: list[int]):  # noqa: ANN202
    """Distinct fingerprints of each text; size and fingerprint are mixed into one number."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            w, hashes = _split(c.raw_texts(batch.column("text")))
            docs, prints = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.uint64)]
            for size in sizes:
                ok = c.whole(w, size)
                best, at = _prints(hashes[0], size)
                ok[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
                docs.append(w.doc[: len(ok)][ok])
                prints.append(best[ok] + np.uint64(size))
            doc, mark = np.concatenate(docs), np.concatenate(prints)
            order = np.lexsort((mark, doc))
            doc, mark = doc[order], mark[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
            yield pa.RecordBatch.from_arrays([batch.column("blob").take(pa.array(doc[new])), pa.array(mark[new].view(np.int64))], names=["blob", "mark"])

    return emit


def _emit_windows(sizes: list[int]):  # noqa: ANN202
    """Windows of a text around those of its fingerprints that the benchmark has."""

    def emit(texts: pa.Table, live: pa.Table) -> pa.Table:
        columns = [np.empty(0, dtype=t) for t in (np.int64, np.int32, np.uint64, np.uint64)]
        if texts.num_rows and live.num_rows:
            w, hashes = _split(c.raw_texts(texts.column("text")))
            marks = np.unique(live.column("mark").to_numpy().view(np.uint64))
            starts = [_candidates(np.sort(marks - np.uint64(s)), s, w, hashes[0]) for s in sizes]
            kinds = np.repeat(sizes, [len(x) for x in starts]).astype(np.int32)
            columns = [np.concatenate(starts), kinds, *(np.concatenate([c.gram_hashes(h, s, x) for s, x in zip(sizes, starts, strict=True)]) for h in hashes)]
        blob = texts.column("blob").combine_chunks()[:1] if texts.num_rows else pa.array([], type=pa.binary())
        at = pa.array(np.zeros(len(columns[0]), dtype=np.int64))
        return pa.table([blob.take(at), pa.array(columns[0]), pa.array(columns[1]), *(pa.array(x.view(np.int64)) for x in columns[2:])], names=["blob", "start", "size", "low", "high"])

    return emit


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of hit words from the starts and sizes of the windows found."""
    for batch in c.slices(batches):
        w = c.words_of(c.raw_texts(batch.column("text")), c.ALPHANUMERIC)
        hits = []
        for n, marks in zip(np.diff(w.first).tolist(), batch.column("marks").to_pylist(), strict=True):
            change = np.zeros(n + 1, dtype=np.int32)
            for m in marks or ():
                change[m["start"]] += 1
                change[m["start"] + m["size"]] -= 1
            hits.append((np.cumsum(change[:n]) > 0).tobytes())
        yield _with(batch, hits, [x or [] for x in batch.column("found").to_pylist()])


def _joined(state: DataFrame, windows: DataFrame, schema: StructType) -> DataFrame:
    """Hits by shuffled joins of fingerprints and windows; nothing of the benchmark is held whole. Equal texts are looked at once."""
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # ten at most
    state = state.withColumn("blob", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    texts = state.groupBy("blob").agg(F.first("text").alias("text"))
    known = windows.select((F.col("print") + F.col("size")).alias("mark")).distinct()
    live = c.join_one(texts.mapInArrow(_emit_prints(sizes), "blob binary, mark long"), known, "mark")
    found = c.cut(texts.groupBy("blob").cogroup(live.groupBy("blob")).applyInArrow(_emit_windows(sizes), "blob binary, start long, size int, low long, high long"))
    kinds = windows.select("low", F.col("high").alias("other_high"), F.col("size").alias("other_size")).distinct()
    same = (F.col("high") == F.col("other_high")) & (F.col("size") == F.col("other_size"))
    marks = c.join_one(found, kinds, "low").where(same).groupBy("blob").agg(F.collect_list(F.struct("start", "size")).alias("marks"))
    pairs = found.select("blob", "size", "low", "high").distinct().join(windows, ["size", "low", "high"]).select("blob", "item_id").distinct()
    items = pairs.groupBy("blob").agg(F.array_sort(F.collect_list("item_id")).alias("found"))
    return c.join_one(state, c.cut(marks.join(items, "blob")), "blob", "left").drop("blob").mapInArrow(_filled, schema)


def _reporter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = [np.frombuffer(h, dtype=bool) for h in batch.column("hit").to_pylist()]
        items = [sorted(map(str, i)) for i in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(h) for h in hits], type=pa.int64()),
                pa.array([int(h.sum()) for h in hits], type=pa.int64()),
                pa.array([len(i) for i in items], type=pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
        )


def _marked(state: DataFrame, benchmark: DataFrame, part_windows: int) -> DataFrame:
    """Add hit and items to rows that have a column text."""
    schema = StructType([*state.schema.fields, StructField("hit", BinaryType()), StructField("items", ArrayType(LongType()))])
    windows = c.cut(benchmark_windows(benchmark))
    if windows.count() > part_windows:
        return _joined(state, windows, schema)
    return state.mapInArrow(_finder(state.sparkSession.sparkContext.broadcast(_index(windows.toArrow()))), schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, part_windows: int = PART_WINDOWS) -> DataFrame:
    """doc_id, text, hit (a byte for each word: 1 if it lies in a benchmark window), items (ids with an occurring window).

    One row for each row of ``docs``, also for repeated ones. Null texts have no words; a null doc_id stays null. An empty
    benchmark gives no hits. With a benchmark of at most ``part_windows`` windows documents are read once and not shuffled.
    """
    return _marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark, part_windows)


def leak_report(docs: DataFrame, benchmark: DataFrame, part_windows: int = PART_WINDOWS) -> DataFrame:
    """Counts and a digest of :func:`find_leaks` for each document."""
    found = find_leaks(docs, benchmark, part_windows)
    return found.mapInArrow(_reporter, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string").withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, part_windows: int = PART_WINDOWS) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns kept; rows are judged where they lie."""
    state = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    return _marked(state, benchmark, part_windows).where(F.size("items") == 0).select("row.*")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "benchmark"))


QUERIES = {"op8_benchmark_decontamination": op8_benchmark_decontamination}

ORACLE = {
    "op8_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
m AS (SELECT DISTINCT doc_id, item_id, k, i FROM dw JOIN bw USING (k, s)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
