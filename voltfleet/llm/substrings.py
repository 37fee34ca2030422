"""Substring de-duplication with difference-cover anchors.

{0, 1, 3} is a difference cover modulo 7: for any two word positions there is a shift of at most 6 that brings both to a
cover position. So two documents that share ``WINDOW`` = 13 words share a 7-gram that starts at a cover position in both
(6 + 7 = 13), and only three of seven positions need to be hashed. Anchors that stand in two documents at least are extended:
only windows around them are hashed, and of equal windows those of the smallest doc_id stay.

Documents are dealt to batches by a hash of the whole row. Batches exchange bare hashes, at most one for each distinct anchor or
window, however often it occurs; a window goes with the smallest doc_id that holds it in the batch.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

WINDOW = 13
COVER = (0, 1, 3)
PERIOD = 7
#: Words of an anchor; any WINDOW words hold one that starts PERIOD - 1 words in at most.
ANCHOR = WINDOW - PERIOD + 1
#: Text bytes of a batch, and text bytes whose hashes meet in a bucket, on average.
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Fewest batches and buckets.
LEAST_BATCHES = 256
LEAST_BUCKETS = 1024

#: What batches and buckets send each other: hashes, and of windows the documents (byte planes of their ids).
_SENT = "bucket int, batch long, data binary, docs binary"
_WINDOW_HASH = np.dtype([("low", "<u8"), ("high", "<u4")])


def _text_slices(table: pa.Table):  # noqa: ANN202
    """Rows of a batch in order of doc_id, some MB of text at a time: ids, texts, words, hashes."""
    ids = c.ids_of(table.column("doc_id").combine_chunks())
    order = np.argsort(ids, kind="stable")
    texts = c.raw_texts(table.column("text"))
    size, at = 0, 0
    for n, i in enumerate(order.tolist()):
        size += len(texts[i])
        if size >= c.SLICE_BYTES or n == len(order) - 1:
            chosen = order[at : n + 1]
            own = [texts[j] for j in chosen.tolist()]
            w = c.words_of(own, c.NOT_SPACE)
            yield ids[chosen], own, w, c.word_hashes(w)
            size, at = 0, n + 1


def _anchors(w: c.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the anchors in texts that hold a window."""
    n = max(0, len(w.doc) - ANCHOR + 1)
    doc = w.doc[:n]
    within = np.arange(n) - w.first[:-1][doc]
    at = np.flatnonzero(np.isin(within % PERIOD, COVER) & c.whole(w, ANCHOR) & (np.diff(w.first)[doc] >= WINDOW))
    return at, c.gram_hashes(hashes, ANCHOR, at)


def _planes(ids: np.ndarray) -> bytes:
    """Ids with equal bytes of all of them on end, which compresses well."""
    return np.ascontiguousarray(ids.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view("<i8").reshape(-1)


def _rows(bucket: np.ndarray, batch: np.ndarray, by: np.ndarray, data: np.ndarray, docs: np.ndarray | None = None) -> pa.Table:
    """A row for each value of ``by`` (sorted), which is the bucket or the batch."""
    starts = np.flatnonzero(np.diff(by, prepend=by[0] - 1)) if len(by) else np.empty(0, dtype=np.int64)
    ends = np.append(starts[1:], len(by))
    cut = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=False)]
    own = [None if docs is None else _planes(docs[a:b]) for a, b in zip(starts, ends, strict=False)]
    return pa.table([pa.array(bucket[starts].astype(np.int32)), pa.array(batch[starts].astype(np.int64)), pa.array(cut, type=pa.binary()), pa.array(own, type=pa.binary())], names=["bucket", "batch", "data", "docs"])


def _sent(batch: int, buckets: np.ndarray, data: np.ndarray, docs: np.ndarray | None = None) -> pa.Table:
    """A row for each bucket; data is sorted by bucket."""
    return _rows(buckets, np.full(len(buckets), batch), buckets, data, docs)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _emit_anchors(buckets: int):  # noqa: ANN202
    """Distinct anchors of a batch: low 31 bits of the hash, and in the top bit whether two of its documents hold it."""

    def emit(table: pa.Table) -> pa.Table:
        keys, docs = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
        for ids, _, w, hashes in _text_slices(table):
            at, grams = _anchors(w, hashes[0])
            keys.append(grams)
            docs.append(ids[w.doc[at]])
        key, doc = np.concatenate(keys), np.concatenate(docs)
        short = _bucket_of(key, buckets) << 31 | (key & np.uint64(0x7FFFFFFF)).astype(np.int64)
        order = np.argsort(short, kind="stable")  # ids rise within equal keys
        short, doc = short[order], doc[order]
        first = np.ones(len(short), dtype=bool)
        first[1:] = short[1:] != short[:-1]
        starts = np.flatnonzero(first)
        several = doc[starts] != doc[np.append(starts[1:], len(doc)) - 1] if len(starts) else np.empty(0, dtype=bool)
        short = short[starts]
        return _sent(table.column("batch")[0].as_py(), short >> 31, (short & 0x7FFFFFFF).astype("<u4") | several.astype("<u4") << np.uint32(31))

    return emit


def _gathered(table: pa.Table, kind: np.dtype | str) -> tuple[np.ndarray, np.ndarray]:
    rows, batch = table.column("data").to_pylist(), table.column("batch").to_numpy()
    data = np.frombuffer(b"".join(rows), dtype=kind)
    return data, np.repeat(batch, [len(r) // np.dtype(kind).itemsize for r in rows])


def _returned(bucket: int, batch: np.ndarray, data: np.ndarray) -> pa.Table:
    order = np.argsort(batch, kind="stable")
    return _rows(np.full(len(batch), bucket), batch[order], batch[order], data[order])


def _shared_anchors(table: pa.Table) -> pa.Table:
    """To each batch, those of its anchors that another document holds too."""
    data, batch = _gathered(table, "<u4")
    key, several = data & np.uint32(0x7FFFFFFF), data >> np.uint32(31)
    kinds, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    shared = (counts > 1) | (np.bincount(inverse, weights=several, minlength=len(kinds)) > 0)
    keep = shared[inverse]
    return _returned(table.column("bucket")[0].as_py(), batch[keep], key[keep])


def _known_anchors(shared: pa.Table) -> np.ndarray:
    rows = shared.column("data").to_pylist()
    return np.sort(np.frombuffer(b"".join(rows), dtype="<u4").astype(np.int64) | np.repeat(shared.column("bucket").to_numpy().astype(np.int64), [len(r) // 4 for r in rows]) << 31)


def _extended(w: c.Words, hashes: tuple[np.ndarray, np.ndarray], known: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that hold a known anchor."""
    at, grams = _anchors(w, hashes[0])
    short = _bucket_of(grams, buckets) << 31 | (grams & np.uint64(0x7FFFFFFF)).astype(np.int64)
    at = at[known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short] if len(known) else at[:0]
    whole = c.whole(w, WINDOW)
    near = c.covered(np.maximum(at - PERIOD + 1, 0), PERIOD, len(w.doc))[: len(whole)]
    starts = np.flatnonzero(near & whole)
    out = np.empty(len(starts), dtype=_WINDOW_HASH)
    out["low"] = c.gram_hashes(hashes[0], WINDOW, starts)
    out["high"] = (c.gram_hashes(hashes[1], WINDOW, starts) & np.uint64(0xFFFFFFFF)).astype("<u4")
    return starts, out


def _owners(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows and the smallest document of each."""
    data, doc = (np.concatenate(x) for x in zip((np.empty(0, dtype=_WINDOW_HASH), np.empty(0, dtype=np.int64)), *parts, strict=True))
    order = np.lexsort((doc, data["high"], data["low"]))
    data, doc = data[order], doc[order]
    first = np.ones(len(data), dtype=bool)
    first[1:] = data[1:] != data[:-1]
    return data[first], doc[first]


def _emit_windows(buckets: int):  # noqa: ANN202
    """Extend shared anchors: the distinct windows of a batch that hold one, with their smallest document."""

    def emit(docs: pa.Table, shared: pa.Table) -> pa.Table:
        found, batch = [], 0
        if docs.num_rows and shared.num_rows:
            known, batch = _known_anchors(shared), docs.column("batch")[0].as_py()
            for ids, _, w, hashes in _text_slices(docs):
                starts, windows = _extended(w, hashes, known, buckets)
                found.append(_owners([(windows, ids[w.doc[starts]])]))
        own, doc = _owners(found)
        bucket = _bucket_of(own["low"], buckets)
        order = np.argsort(bucket, kind="stable")
        return _sent(batch, bucket[order], own[order], doc[order])

    return emit


def _later_windows(table: pa.Table) -> pa.Table:
    """To each batch, those of its windows of which another batch holds a smaller document than all of its own."""
    data, batch = _gathered(table, _WINDOW_HASH)
    doc = np.concatenate([np.empty(0, dtype=np.int64), *map(_from_planes, table.column("docs").to_pylist())])
    order = np.lexsort((doc, data["high"], data["low"]))
    data, batch, doc = data[order], batch[order], doc[order]
    first = np.ones(len(data), dtype=bool)
    first[1:] = data[1:] != data[:-1]
    later = doc > doc[first][np.cumsum(first) - 1]
    return _returned(table.column("bucket")[0].as_py(), batch[later], data[later])


_RESULT = "doc_id long, n_words long, n_removed long, kept string"
_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remover(digest: bool, buckets: int):  # noqa: ANN202
    def remove(docs: pa.Table, incoming: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [], [])
        kind = incoming.column("kind")
        known = _known_anchors(incoming.filter(pc.equal(kind, 0)))
        later = np.concatenate([np.empty(0, dtype=_WINDOW_HASH), *(np.frombuffer(r, dtype=_WINDOW_HASH) for r in incoming.filter(pc.equal(kind, 1)).column("data").to_pylist())])
        later = later[np.argsort(later["low"])]
        windows = []
        for ids, _, w, hashes in _text_slices(docs) if docs.num_rows else ():
            starts, own = _extended(w, hashes, known, buckets)
            windows.append((starts, own, ids[w.doc[starts]]))
        kinds, owner = _owners([x[1:] for x in windows])
        taken = np.zeros(len(kinds), dtype=bool)
        if len(later):
            taken = later[np.minimum(np.searchsorted(later["low"], kinds["low"]), len(later) - 1)] == kinds
        copies = docs.column("copies").to_numpy() if docs.num_rows else np.empty(0, dtype=np.int64)
        for (ids, texts, w, _), (starts, own, doc) in zip(_text_slices(docs) if docs.num_rows else (), windows, strict=True):
            at = np.searchsorted(kinds["low"], own["low"])
            hit = c.covered(starts[taken[at] | (owner[at] < doc)], WINDOW, len(w.doc))
            removed = np.add.reduceat(np.append(hit, False).astype(np.int64), w.first[:-1]) * (np.diff(w.first) > 0)
            for i, text in enumerate(texts):
                words = text.split()
                if removed[i]:
                    words = list(compress(words, ~hit[w.first[i] : w.first[i + 1]]))
                kept = b" ".join(words)
                out[3].append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            out[0].append(ids)
            out[1].append(np.diff(w.first))
            out[2].append(removed)
        ids, n, gone = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in out[:3])
        order = np.argsort(c.ids_of(docs.column("doc_id").combine_chunks()), kind="stable") if docs.num_rows else []
        return pa.table([c.ids_back(ids), pa.array(n), pa.array(gone), pa.array(out[3], type=pa.string()), pa.array(copies[order])], names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "kept", "copies"])

    return remove


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space (or their digest), for each row of ``docs``.

    A word goes if it is in a window of 13 words that also starts in a document with a smaller doc_id. Rows that repeat a
    doc_id count as one document. A null doc_id counts as smaller than any other and stays null. Null texts have no words.

    The text is shuffled once, to its batch; that exchange serves all three readings. Each batch sends an anchor or window
    once, so one that stands in a third of all documents is as many short hashes as there are batches. Batches are dealt by
    id and text together, so neither copies nor an id of very many rows fill one; rows equal in both are folded where they are many.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    row = F.xxhash64("doc_id", "text")
    hot, size = c.hot_keys(texts, row, F.coalesce(F.octet_length("text"), F.lit(0)))
    texts = texts.withColumn("copies", F.lit(1).cast("long"))
    if hot:
        many = row.isin(hot)
        texts = texts.where(~many).unionByName(texts.where(many).groupBy("doc_id", "text").agg(F.sum("copies").alias("copies")))
    batches, buckets = max(LEAST_BATCHES, size // BATCH_BYTES), max(LEAST_BUCKETS, size // BUCKET_BYTES)
    texts = texts.withColumn("batch", F.pmod(row, F.lit(batches)))
    anchors = texts.groupBy("batch").applyInArrow(_emit_anchors(buckets), _SENT)
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, _SENT)
    windows = texts.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(_emit_windows(buckets), _SENT)
    later = windows.groupBy("bucket").applyInArrow(_later_windows, _SENT)
    incoming = shared.withColumn("kind", F.lit(0)).unionByName(later.withColumn("kind", F.lit(1)))
    result = texts.groupBy("batch").cogroup(incoming.groupBy("batch")).applyInArrow(_remover(digest, buckets), f"{_DIGEST if digest else _RESULT}, copies long")
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies") if hot else result.drop("copies")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(c.read(spark, sf_dir, "documents"), digest=True)


QUERIES = {"op5_substring_dedup": op5_substring_dedup}

ORACLE = {
    "op5_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT t, min(doc_id) AS owner FROM s GROUP BY t),
g AS (SELECT DISTINCT doc_id, i + k AS j FROM s JOIN f USING (t), generate_series(0, 12) AS o(k) WHERE doc_id > owner),
k AS (SELECT doc_id, count(*) AS n_words, count(g.j) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE g.j IS NULL), '') AS kept
      FROM (SELECT doc_id, generate_subscripts(w, 1) AS j, unnest(w) AS word FROM d) p LEFT JOIN g USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
}
