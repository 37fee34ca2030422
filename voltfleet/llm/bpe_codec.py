"""BPE encoding by per-prefix dynamic programming, and decoding.

The BPE encoding of a prefix ends in one token only: of the vocabulary's tokens that are suffixes of the prefix, the one that
may follow the last token of what is left before it. So it is enough to store each prefix's last token; back-pointers from
the whole text's give the exact ids. An Aho-Corasick automaton over the vocabulary gives the tokens that end at a place.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .token_counts import merge_symbols
from .vocabulary import Vocabulary, load, pieces, special_pattern

#: Distinct pieces, and token pairs, that a Python worker remembers; beyond this it forgets all and goes on.
MEMORY = 300_000
VOCABULARY = "byte_bpe_50k.json"


class Encoder(dict):
    """Ids of pieces as little-endian unsigned 32-bit integers; remembers the pieces it has encoded."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.rank = [-1] * len(vocabulary.tokens)
        self.parts = [(-1, -1)] * len(vocabulary.tokens)
        for (a, b), (rank, i) in vocabulary.merges.items():
            self.rank[i], self.parts[i] = rank, (a, b)
        self.follows: dict[tuple[int, int], bool] = {}
        self.special = special_pattern(vocabulary)
        self.endings = ahocorasick.Automaton()
        for i in [*vocabulary.base, *(i for _, i in vocabulary.merges.values())]:
            token = vocabulary.tokens[i]
            if merge_symbols(vocabulary, [vocabulary.base[b] for b in token]) == [i]:  # else no encoding holds it
                self.endings.add_word(token.decode("latin-1"), (i, len(token)))
        self.endings.make_automaton()

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE keeps two adjacent tokens: no merge across their border comes before those that build them.

        The merges that build the two are undone from the last one back. ``until`` is the rank at which a side of the border
        was taken into a larger token; a merge of the two sides of the border before that would have come first.
        """
        known = self.follows.get((left, right))
        if known is not None:
            return known
        a, b, until, kept = left, right, len(self.vocabulary.merges), True
        while True:
            across = self.vocabulary.merges.get((a, b))
            if across and across[0] < until:
                kept = False
                break
            if self.rank[a] < 0 and self.rank[b] < 0:
                break
            if self.rank[a] > self.rank[b]:
                until, a = self.rank[a], self.parts[a][1]
            else:
                until, b = self.rank[b] + 1, self.parts[b][0]  # of equal merges the left one comes first
        self.follows[left, right] = kept
        return kept

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode().decode("latin-1")
        last, size = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        for end, (token, n) in self.endings.iter(data):
            start = end + 1 - n
            if not size[end + 1] and (start == 0 or self.may_follow(last[start], token)):
                last[end + 1], size[end + 1] = token, n
        ids, at = [], len(data)
        while at:
            ids.append(last[at])
            at -= size[at]
        packed = array("I", reversed(ids))
        self[piece] = out = packed.tobytes()
        return out

    def encode(self, text: str) -> bytes:
        out = []
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                out.append(array("I", [self.vocabulary.special[part]]).tobytes())
            else:
                out.extend(map(self.__getitem__, pieces(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocabulary.tokens.__getitem__, array("I", ids))).decode("utf-8", "replace")

    def forget(self) -> None:
        if len(self) > MEMORY:
            self.clear()
        if len(self.follows) > MEMORY:
            self.follows.clear()


#: A worker's encoder for the vocabulary that it has seen last.
_KEPT: list[tuple[object, Encoder]] = []


def _encoder(shared) -> Encoder:  # noqa: ANN001
    if not _KEPT or _KEPT[0][0] is not shared.value:
        _KEPT[:] = [(shared.value, Encoder(shared.value))]
    return _KEPT[0][1]


#: What can be returned of a document's ids and of the text decoded from them.
OUTPUTS = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def _codec(shared, outputs: tuple[str, ...]):  # noqa: ANN001, ANN202
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in c.slices(batches):
            ids = [encoder.encode(t) for t in batch.column("text").fill_null("").to_pylist()]
            decoded = [encoder.decode(i) for i in ids]
            encoder.forget()
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            make = {
                "ids": lambda: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))),
                "decoded": lambda: pa.array(decoded, type=pa.string()),
                "ids_sha256": lambda: pa.array([hashlib.sha256(i).hexdigest() for i in ids], type=pa.string()),
                "decoded_sha256": lambda: pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], type=pa.string()),
            }
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), *(make[o]() for o in outputs)], names=["doc_id", "n_tokens", *outputs])

    return code


def encode_documents(docs: DataFrame, vocabulary_path: str, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """doc_id, n_tokens and the ``outputs`` (of ``OUTPUTS``) for each row of ``docs``.

    Null texts are empty: no ids, and an empty decoded text. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary_path))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_codec(shared, outputs), ", ".join(["doc_id long", "n_tokens long", *(f"{o} {OUTPUTS[o]}" for o in outputs)]))


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(c.read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), outputs=("ids_sha256", "decoded_sha256"))


QUERIES = {"op10_bpe_encode_decode": op10_bpe_encode_decode}

ORACLE: dict[str, str] = {}
