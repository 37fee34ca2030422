"""Shared helpers: reading tables, shared-folder checkpoints, and vectorised word handling on Arrow batches."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside numpy code.
NO_ID = np.iinfo(np.int64).min
#: Text bytes handled at once inside a Python task; bounds numpy temporaries to some tens of MB.
SLICE_BYTES = 1 << 21
#: Rows of one key that no table is too small for.
FEW = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir. Where it is unset, a session of one machine gets one of its own, any other an error."""
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


def hot_keys(rows: DataFrame, key: Column, size: Column) -> tuple[list, int]:
    """Keys that hold over a thousandth of all rows, thus fewer than a thousand of them, and the total of ``size``."""
    counts = rows.groupBy(key.alias("hot_key")).agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    counts = cut(counts)
    total = counts.agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
    hot = counts.where(F.col("hot_key").isNotNull() & (F.col("n") > F.greatest(F.lit(FEW), F.lit((total["n"] or 0) / 1000)))).collect()
    return [r["hot_key"] for r in hot], int(total["size"] or 0)


def join_one(rows: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows (left) with the one row that each key has in ``unique``; the few rows of hot keys are broadcast, so no task gets all rows of one."""
    hot, _ = hot_keys(rows, F.col(key), F.lit(0))
    if not hot:
        return rows.join(unique, key, how)
    many = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return rows.where(~many).join(unique.where(~many), key, how).unionByName(rows.where(many).join(F.broadcast(unique.where(many)), key, how))


def ids_of(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, type=pa.int64(), mask=ids == NO_ID)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


class Words(NamedTuple):
    """Words of several texts: the text each belongs to, each text's first word, the words' bytes on end, and where each begins there."""

    doc: np.ndarray
    first: np.ndarray
    letters: np.ndarray
    offsets: np.ndarray


def words_of(texts: list[bytes], is_word: np.ndarray) -> Words:
    """Maximal runs of bytes for which the 256-entry table ``is_word`` holds; runs never cross texts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = is_word[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, end = edges[::2], edges[1::2]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    first = np.searchsorted(start, begins)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(doc, first, data[inside], np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64))


#: Word bytes when words are runs of anything but ASCII white space.
NOT_SPACE = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])
#: Word bytes when words are runs of ASCII letters, digits and any non-ASCII character.
ALPHANUMERIC = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
#: A-Z to a-z, other bytes unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit with probability near one half."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word, the halves of a BLAKE2 digest; equal words are told by their bytes and digested once."""
    column = pa.Array.from_buffers(pa.large_binary(), len(w.doc), [None, pa.py_buffer(w.offsets), pa.py_buffer(w.letters)]).dictionary_encode()
    digests = b"".join(blake2b(x, digest_size=16).digest() for x in column.dictionary.to_pylist())
    both = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)[column.indices.to_numpy()]
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def gram_hashes(hashes: np.ndarray, k: int, starts: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Hash of each run of k consecutive words (of whatever texts), one for each start, or for the given ``starts``."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, dtype=np.uint64)[starts]
    for j in range(k):
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += hashes[j : j + n][starts]
    return mix(out)


def whole(w: Words, k: int) -> np.ndarray:
    """For each start, whether the k words from there are of one text."""
    n = len(w.doc) - k + 1
    return w.doc[:n] == w.doc[k - 1 :] if n > 0 else np.empty(0, dtype=bool)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of n words lie in a run of k words that begins at one of ``starts``."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + k, -1)
    return np.cumsum(change[:n]) > 0
