"""Ranked lexical search by exact inner products over sparse ball trees.

A document is a sparse vector with a coordinate for each of its terms, the term's weight times its damped frequency, and an
item asks for the sum of the coordinates of its terms: an inner product with a vector of ones and zeros. Documents stay in the
partitions they lie in. A task deals its vectors into trees of bounded size, whose balls have a centroid and, for each of some
groups of terms, a radius. By Cauchy and Schwarz no document of a ball scores more than the centroid does plus, over the groups,
radius times root of the item's number of terms there. A search goes through balls best first, leaves out those whose bound,
rounded up, is under the score of the item's present last hit, and scores documents of leaves in whole numbers. What a task has
found for an item bounds its later trees too; the tasks' hits are merged.

Items are handled in blocks of so many terms that a block's vocabulary can be broadcast; each block reads all documents.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

#: Hits of an item.
TOP = 10
#: Terms of the items of a block, each item's counted, about.
BLOCK_TERMS = 1 << 20
#: Most documents and, but for a single document with more, coordinates of a tree; documents of a leaf, at most.
TREE_ROWS, TREE_ENTRIES, LEAF = 8192, 1 << 20, 16
#: Groups of terms that have a radius of their own.
GROUPS = 1 << 14
#: Bounds are raised by this share, far over the rounding error of sums of up to a million doubles.
SLACK = 2.0**-30
#: Sorts after all ids.
_LAST = np.iinfo(np.int64).max


class Items(NamedTuple):
    """A block of items: ids, where each one's terms begin, and the terms, sorted. Terms are numbered anew from the most frequent on.

    number: the new number of each term of the vocabulary; weight, group: of each new number.
    """

    ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    number: np.ndarray
    weight: np.ndarray
    group: np.ndarray
    n_docs: int
    n_terms: int


def _words(texts: list[bytes]) -> tuple[c.Words, pa.DictionaryArray]:
    w = c.words_of([t.translate(c.LOWER) for t in texts], c.ALPHANUMERIC)
    column = pa.Array.from_buffers(pa.large_binary(), len(w.doc), [None, pa.py_buffer(w.offsets), pa.py_buffer(w.letters)])
    return w, column.dictionary_encode()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        w, column = _words(c.raw_texts(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(w.doc)), column.cast(pa.large_binary()).cast(pa.binary())], names=["item_id", "term"])


def terms_of_items(items: DataFrame) -> DataFrame:
    """Distinct item_id, term (bytes). Items with a null id or without terms have none; rows of one id are one item."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.where("item_id is not null").mapInArrow(_item_terms, "item_id long, term binary").distinct()


def _counter(shared):  # noqa: ANN001, ANN202
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: pa.Array = shared.value
        for batch in c.slices(batches):
            w, column = _words(c.raw_texts(batch.column("text")))
            number = pc.index_in(column.dictionary, value_set=vocabulary).fill_null(-1).to_numpy()
            term = number[column.indices.to_numpy()].astype(np.int64) if len(w.doc) else np.empty(0, dtype=np.int64)
            key, tf = np.unique((w.doc * len(vocabulary) + term)[term >= 0], return_counts=True)
            doc = key // max(1, len(vocabulary))
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key - doc * len(vocabulary), tf)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(w.first).astype(np.int64)), *lists], names=["doc_id", "n", "terms", "tf"])

    return count


def vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """doc_id, n (terms with repeats), terms (those of the vocabulary, by number) and tf of each row; null texts have none."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_counter(docs.sparkSession.sparkContext.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, tf array<int>")


def _document_counts(size: int):  # noqa: ANN202
    """A task's number of documents for each term; under -1 that of documents with terms, under -2 that of all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, docs, total = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
            found += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2]).astype(np.int64)), pa.array(np.append(found[at], [docs, total]))], names=["term", "df"])

    return count


def _groups(df: np.ndarray) -> np.ndarray:
    """Groups of terms, which come with falling frequency, that about as many coordinates fall into: a frequent term is alone, rare ones share one."""
    return np.minimum((np.cumsum(df) / max(1, df.sum()) * GROUPS).astype(np.int64), GROUPS - 1)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


class Sparse(NamedTuple):
    """Numbers by key and ball, sorted by key."""

    key: np.ndarray
    ball: np.ndarray
    number: np.ndarray

    @staticmethod
    def of(balls: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        key, number = (np.concatenate(x) for x in zip(*balls, strict=True))
        order = np.argsort(key, kind="stable")
        return Sparse(key[order], np.repeat(np.arange(len(balls)), [len(k) for k, _ in balls])[order], number[order])

    def sums(self, keys: np.ndarray, times: np.ndarray | float, balls: int) -> np.ndarray:
        """Of each ball, the sum of its numbers under ``keys``, each ``times`` its own factor."""
        low = np.searchsorted(self.key, keys)
        sizes = np.searchsorted(self.key, keys, "right") - low
        e = _ranges(low, sizes)
        return np.bincount(self.ball[e], weights=self.number[e] * (np.repeat(times, sizes) if np.ndim(times) else times), minlength=balls)


class Tree(NamedTuple):
    """Documents in order of the leaves, with their coordinates; balls of a complete binary tree from the root, number 0, on.

    ids, starts, terms (numbers within the tree), value: documents; used: the vocabulary's number of each term of the tree.
    first, last: documents of each ball; whole: its radius over all terms. middle: coordinates of centroids, by term; part:
    radii over single groups, by group, where they aren't 0.
    """

    ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    value: np.ndarray
    used: np.ndarray
    first: np.ndarray
    last: np.ndarray
    whole: np.ndarray
    middle: Sparse
    part: Sparse


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins."""
    change = np.ones(len(keys[0]), dtype=bool)
    change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(change)


def plant(ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, value: np.ndarray, group: np.ndarray) -> Tree:
    """A tree of documents with ``sizes`` coordinates each, at least one, in order of their terms; ``group`` rises with the term.

    A ball is halved across the line between two far documents of it.
    """
    used, local = np.unique(terms, return_inverse=True)
    starts, of, y = np.cumsum(sizes) - sizes, group[used], value.astype(np.float64)
    norms = np.add.reduceat(y * y, starts)
    depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF))))
    rows, first, last, whole, middles, parts = [np.arange(len(ids))], [], [], [], [], []
    for level in range(depth + 1):
        halves, at = [], 0
        for mine in rows:
            first.append(at)
            at += len(mine)
            last.append(at)
            if not len(mine):  # documents are fewer than leaves
                whole.append(0.0)
                middles.append((used[:0], y[:0]))
                parts.append((group[:0], y[:0]))
                halves += [mine, mine]
                continue
            size = sizes[mine]
            e = _ranges(starts[mine], size)
            row, term, own = np.repeat(np.arange(len(mine)), size), local[e], y[e]
            present, place = np.unique(term, return_inverse=True)
            middle = np.bincount(place, weights=own, minlength=len(present)) / len(mine)
            middles.append((present, middle))
            run = _runs(row, of[term])
            on, at_group = row[run], of[term[run]]
            ones, cross = np.add.reduceat(own * own, run), np.add.reduceat(own * middle[place], run)
            groups = np.unique(of[present])
            square = np.add.reduceat(middle * middle, _runs(of[present]))
            g = np.searchsorted(groups, at_group)
            lacking = np.bincount(g, minlength=len(groups)) < len(mine)
            far, most = np.where(lacking, square, 0), np.zeros(len(groups))
            np.maximum.at(far, g, ones - 2 * cross + square[g])
            np.maximum.at(most, g, ones)
            parts.append((groups, np.sqrt(far + 4 * SLACK * (most + square))))
            away = np.bincount(on, weights=ones - 2 * cross, minlength=len(mine)) + square.sum()
            whole.append(np.sqrt(max(0.0, away.max()) + 4 * SLACK * (norms[mine].max() + square.sum())))
            if level == depth:
                continue
            to = lambda k: np.bincount(row, weights=own * np.bincount(place[row == k], weights=own[row == k], minlength=len(present))[place], minlength=len(mine))  # noqa: B023, E731
            near = to(int(away.argmax()))
            order = np.argsort(to(int((norms[mine] - 2 * near).argmax())) - near, kind="stable")
            halves += [mine[order[: len(mine) // 2]], mine[order[len(mine) // 2 :]]]
        rows = halves if level < depth else rows
    order = np.concatenate(rows)
    e = _ranges(starts[order], sizes[order])
    return Tree(ids[order], np.concatenate([[0], np.cumsum(sizes[order])]), local[e], value[e], used, np.array(first), np.array(last), np.array(whole), Sparse.of(middles), Sparse.of(parts))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Hits:
    """The best documents of each item so far, and how many leaves were scored."""

    def __init__(self, items: Items, k: int) -> None:
        self.items, self.k, self.leaves = items, k, 0
        self.found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))] * len(items.ids)

    def search(self, tree: Tree) -> None:
        balls = len(tree.first)
        asked, inner = np.zeros(len(tree.used), dtype=np.int64), balls // 2
        for i in range(len(self.items.ids)):
            terms = self.items.terms[self.items.starts[i] : self.items.starts[i + 1]]
            at = np.searchsorted(tree.used, terms)
            at = at[tree.used[np.minimum(at, len(tree.used) - 1)] == terms]
            if not len(at):
                continue
            groups, n = np.unique(self.items.group[tree.used[at]], return_counts=True)
            spread = np.minimum(tree.part.sums(groups, np.sqrt(n), balls), np.sqrt(len(at)) * tree.whole)
            bound = (tree.middle.sums(at, 1.0, balls) + spread) * (1 + SLACK) + 1
            asked[at] = 1
            scores, ids = self.found[i]
            heap = [(-bound[0], 0)]
            while heap:
                upper, node = heapq.heappop(heap)
                least = scores[-1] if len(scores) == self.k else 1
                if -upper < least:
                    break
                if node < inner:
                    for child in (2 * node + 1, 2 * node + 2):
                        if bound[child] >= least:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                self.leaves += 1
                a, b = tree.first[node], tree.last[node]
                s = tree.starts[a : b + 1]
                part = np.concatenate([[0], np.cumsum(asked[tree.terms[s[0] : s[-1]]] * tree.value[s[0] : s[-1]])])
                own = part[s[1:] - s[0]] - part[s[:-1] - s[0]]
                hit = np.flatnonzero(own >= least)
                if len(hit):
                    scores, ids = _best(np.concatenate([scores, own[hit]]), np.concatenate([ids, tree.ids[a:b][hit]]), self.k)
            self.found[i] = scores, ids
            asked[at] = 0


def _plant(parts: list[tuple[np.ndarray, ...]], items: Items) -> Tree:
    ids, n, sizes, terms, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
    terms, row = items.number[terms], np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(row * len(items.number) + terms)
    terms, tf = terms[order], tf[order]
    m = np.array([100 - 90 + 90 * v * items.n_docs // items.n_terms for v in n.tolist()], dtype=np.int64)
    damped = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes))
    return plant(ids, sizes, terms, items.weight[terms] * damped, items.group)


def _searcher(shared, k: int):  # noqa: ANN001, ANN202
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        hits = Hits(items, k)
        parts, rows, entries = [], 0, 0
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))  # others score nothing
            sizes = pc.list_value_length(batch.column("terms")).to_numpy()
            ends = np.cumsum(sizes)
            at = 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = min(batch.num_rows, at + TREE_ROWS - rows, max(at + 1, int(np.searchsorted(ends, before + TREE_ENTRIES - entries, "right"))))
                part = batch.slice(at, to - at)
                ids = c.ids_of(part.column("doc_id"))
                lists = (part.column(x).flatten().to_numpy().astype(np.int64) for x in ("terms", "tf"))
                parts.append((np.where(ids == c.NO_ID, _LAST, ids), part.column("n").to_numpy(), sizes[at:to].astype(np.int64), *lists))
                rows, entries, at = rows + to - at, entries + int(ends[to - 1] - before), to
                if rows >= TREE_ROWS or entries >= TREE_ENTRIES or at < batch.num_rows:
                    hits.search(_plant(parts, items))
                    parts, rows, entries = [], 0, 0
        if parts:
            hits.search(_plant(parts, items))
        which = np.repeat(np.arange(len(items.ids)), [len(s) for s, _ in hits.found])
        scores, ids = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in zip(*hits.found, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(items.ids[which]), pa.array(ids, mask=ids == _LAST), pa.array(scores)], names=["item_id", "doc_id", "score"])

    return search


def _load(terms: DataFrame, known: DataFrame, vocabulary: pa.Array) -> Items:
    """The items of a block with weights from ``known``, the documents' vectors; as many numbers come back as the block has terms."""
    counts = known.mapInArrow(_document_counts(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    number, count = counts.column("term").to_numpy(), counts.column("df").to_numpy()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    df[number[number >= 0]] = count[number >= 0]
    n_docs, n_terms = int(count[number == -1].sum()), int(count[number == -2].sum())
    by_df = np.argsort(-df, kind="stable")
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[by_df] + 1))).astype(np.int64)
    number = np.empty(len(df), dtype=np.int64)
    number[by_df] = np.arange(len(df))
    rows = terms.toArrow()
    item, term = rows.column("item_id").to_numpy(), number[pc.index_in(rows.column("term").cast(pa.large_binary()), value_set=vocabulary).to_numpy()]
    order = np.lexsort((term, item))
    ids, starts = np.unique(item[order], return_index=True)
    return Items(ids, np.append(starts, len(item)), term[order], number, weight, _groups(df[by_df]), n_docs, n_terms)


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Scores are those of the module's formula over whole texts; only scores above 0 count. Each row of ``docs`` is a document,
    repeated ones too. Among equal scores smaller ids come first and null ids last. Items with a null id take no part; rows
    of one item_id are one item with the terms of all. Empty tables give no rows.
    """
    spark = docs.sparkSession
    folder = f"{c.shared_folder(spark)}/lexical-{uuid.uuid4().hex}"
    terms_of_items(items).write.parquet(f"{folder}/items")
    terms = spark.read.parquet(f"{folder}/items")
    blocks = max(1, -(-terms.count() // block_terms))
    found = []
    for block in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        vocabulary = mine.select("term").distinct().toArrow().column("term").cast(pa.large_binary()).combine_chunks()
        if not len(vocabulary):
            continue
        vectors(docs, vocabulary).write.parquet(f"{folder}/vectors-{block}")
        known = spark.read.parquet(f"{folder}/vectors-{block}")
        shared = spark.sparkContext.broadcast(_load(mine, known, vocabulary))
        found.append(known.select("doc_id", "n", "terms", "tf").mapInArrow(_searcher(shared, k), "item_id long, doc_id long, score long"))
    hits = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for one in found:
        hits = hits.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(c.read(spark, sf_dir, "documents"), c.read(spark, sf_dir, "benchmark"))


QUERIES = {"op12_ranked_lexical_search": op12_ranked_lexical_search}

_SQL_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = {
    "op12_ranked_lexical_search": f"""
WITH d AS (SELECT doc_id, {_SQL_TERMS} AS w FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, sum(len(w))::BIGINT AS total FROM d),
m AS (SELECT doc_id, 100 - 90 + (90 * len(w) * docs) // total AS m FROM d, s WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_SQL_TERMS}) AS t FROM benchmark)),
f AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY doc_id, t),
k AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS k FROM f, s GROUP BY t, docs),
r AS (SELECT item_id, doc_id, sum(k * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN f USING (t) JOIN k USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10""",
}
