"""Token counts by byte-pair merging with a heap and a linked list: symbols minus merges, no identifiers are emitted."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .vocabulary import Vocabulary, load, pieces, special_pattern

#: Distinct pieces whose counts a Python worker remembers; beyond this it forgets all and goes on.
MEMORY = 400_000
LIMIT = 512
VOCABULARY = "byte_bpe_50k.json"


def merge_symbols(vocabulary: Vocabulary, symbols: list[int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, the leftmost of equal ones, until none is left; the symbols that remain."""
    merges, n = vocabulary.merges, len(symbols)
    symbols, after, before = [*symbols, -1], list(range(1, n + 1)), list(range(-1, n))
    heap = [(m[0], i) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if j >= n or symbols[i] < 0:
            continue
        found = merges.get((symbols[i], symbols[j]))
        if not found or found[0] != rank:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j], after[i] = found[1], -1, after[j]
        before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (m := merges.get((symbols[k], symbols[after[k]]))):
                heappush(heap, (m[0], k))
    return [s for s in symbols[:n] if s >= 0]


class _Counts(dict):
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(merge_symbols(self.vocabulary, [self.vocabulary.base[b] for b in piece.encode()]))
        return n


#: A worker's counts for the vocabulary that it has seen last; tasks of one worker share them.
_KEPT: list[tuple[object, _Counts]] = []


def _counter(shared):  # noqa: ANN001, ANN202
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        if not _KEPT or _KEPT[0][0] is not vocabulary:
            _KEPT[:] = [(vocabulary, _Counts(vocabulary))]
        counts, special = _KEPT[0][1], special_pattern(vocabulary)
        for batch in c.slices(batches):
            texts = batch.column("text").fill_null("").to_pylist()
            totals = []
            for text in texts:
                parts = special.split(text) if special else [text]
                totals.append(len(parts) // 2 + sum(sum(map(counts.__getitem__, pieces(p))) for p in parts[::2]))
            if len(counts) > MEMORY:
                counts.clear()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], type=pa.int64()), pa.array(np.array(totals, dtype=np.int64))], names=["doc_id", "n_bytes", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``; null texts are empty and have no tokens.

    A special token's string in a text is one token, as in the tokenizers library. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary_path))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_counter(shared), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(c.read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op6_token_counts": op6_token_counts}

ORACLE: dict[str, str] = {}
