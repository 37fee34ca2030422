"""Language identification by rank-order profiles.

A profile is the ``TOP`` most frequent n-grams of one to three characters (word borders count as one) in order of frequency.
A document's distance to a language is the sum, over the document's own profile, of how far each n-gram is out of place in the
language's; one that the language lacks is ``TOP`` out of place. The nearest language wins, equal ones by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

TOP = 300
UNKNOWN = "und"
#: Rows that a task holds before it adds up equal n-grams.
HELD = 1 << 21
#: Of a n-gram's code points; 0 stands for none and 1 for a word border.
CODE_BITS = 21
#: Texts whose n-grams are counted at once.
_ROWS = 1 << 16
#: Numbers of ranks, n-grams times languages, that are compared at once.
_RANKS = 1 << 21


class Profiles(NamedTuple):
    """names: languages in order; grams: all their n-grams, sorted; ranks: rank of each n-gram in each language, or TOP."""

    names: list[str]
    grams: np.ndarray
    ranks: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


class _Grams(NamedTuple):
    """Distinct n-grams of each text: text, n-gram as code points, count; in order of text and n-gram."""

    text: np.ndarray
    gram: np.ndarray
    count: np.ndarray


def _run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _grams(texts: list[str], group: np.ndarray) -> _Grams:
    """Count n-grams of texts by group number; a text's number may come more than once where groups rise and fall."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(lower) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    of = np.repeat(group, [len(t) + 1 for t in lower])
    of = np.concatenate([of[:1], of, of[-1:]])[: len(points)]  # the first border, and each text with the border after it
    present = np.flatnonzero(np.bincount(points, minlength=2))
    present = present[_letters()[present]]
    codes = np.zeros(0x110000, dtype=np.int64)
    codes[present] = np.arange(2, len(present) + 2)
    codes[codes == 0] = 1
    s = codes[points]
    keep = s != 1
    keep[1:] |= s[:-1] != 1
    keep[0] = True
    s, of = s[keep], of[keep]
    bits = int(len(present) + 2).bit_length()
    if len(texts) > 1 and 3 * bits + int(group.max() - group.min()).bit_length() > 63:  # one number can't hold a text and three letters
        half = len(texts) // 2
        return _added([_grams(texts[:half], group[:half]), _grams(texts[half:], group[half:])])
    base, of = group.min(), of - group.min()
    inner = s[1:-1]
    letter = s != 1
    keys = [
        of[letter] << 3 * bits | s[letter] << 2 * bits,
        np.where(letter[1:], of[1:], of[:-1]) << 3 * bits | s[:-1] << 2 * bits | s[1:] << bits,
        (of[1:-1] << 3 * bits | s[:-2] << 2 * bits | inner << bits | s[2:])[inner != 1],
    ]
    keys[1] = keys[1][letter[1:] | letter[:-1]]
    unique, count = _run_lengths(np.concatenate(keys))
    back = np.concatenate([[0, 1], present]).astype(np.int64)
    mask = (1 << bits) - 1
    a, b, d = (back[unique >> i * bits & mask] for i in (2, 1, 0))
    return _Grams((unique >> 3 * bits) + base, a << 2 * CODE_BITS | b << CODE_BITS | d, count)


def _added(parts: list[_Grams]) -> _Grams:
    text, gram, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((gram, text))
    text, gram, count = text[order], gram[order], count[order]
    first = np.ones(len(text), dtype=bool)
    first[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
    starts = np.flatnonzero(first)
    return _Grams(text[starts], gram[starts], np.add.reduceat(count, starts)) if len(starts) else _Grams(text, gram, count)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of each language of a task's texts."""
    names: dict[str, int] = {}
    parts, held = [], 0
    for batch in c.slices(batches):
        group = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], dtype=np.int64)
        parts.append(_grams(batch.column("text").to_pylist(), group))
        held += len(parts[-1].text)
        if held > HELD:
            parts = [_added(parts)]
            held = len(parts[0].text)
    if parts:
        total = _added(parts)
        lang = pa.DictionaryArray.from_arrays(pa.array(total.text, type=pa.int32()), pa.array(list(names), type=pa.string())).cast(pa.string())
        yield pa.RecordBatch.from_arrays([lang, pa.array(total.gram), pa.array(total.count.astype(np.int64))], names=["lang", "gram", "n"])


def learn_profiles(labelled: DataFrame) -> DataFrame:
    """lang, gram, rank (from 0) of each language of ``labelled`` (text, lang); all its texts count, nulls do not."""
    texts = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = texts.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return counts.withColumn("rank", rank - 1).where(F.col("rank") < TOP).select("lang", "gram", "rank")


def _profiles(learned: DataFrame) -> Profiles:
    """Profiles as arrays; ``TOP`` rows for each language, however large the corpus."""
    rows = learned.toPandas()
    names = sorted(rows["lang"].unique())
    grams = np.unique(rows["gram"].to_numpy(dtype=np.int64))
    ranks = np.full((len(grams) + 1, len(names)), TOP, dtype=np.int32)
    ranks[np.searchsorted(grams, rows["gram"]), [names.index(x) for x in rows["lang"]]] = rows["rank"]
    return Profiles(names, grams, ranks)


def rank_documents(texts: list[str], profiles: Profiles) -> tuple[list[str], np.ndarray]:
    """Nearest language and score of each text. The score is 1 if nothing is out of place, 0 if the two share no n-gram."""
    found = _grams(texts, np.arange(len(texts), dtype=np.int64)) if texts else _Grams(*[np.empty(0, dtype=np.int64)] * 3)
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not len(found.text) or not profiles.names:
        return names, scores
    order = np.lexsort((-found.count, found.text))  # stable, so equal counts stay in order of their n-grams
    text, gram = found.text[order], found.gram[order]
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    sizes = np.diff(np.append(starts, len(text)))
    rank = np.arange(len(text)) - np.repeat(starts, sizes)
    text, gram, rank = (x[rank < TOP] for x in (text, gram, rank))
    at = np.searchsorted(profiles.grams, gram)
    at = np.where(profiles.grams[np.minimum(at, len(profiles.grams) - 1)] == gram, at, len(profiles.grams))
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    ends = np.append(starts[1:], len(text))
    first = 0
    while first < len(starts):  # as many texts as keep within the bound, each of which has TOP n-grams at most
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + _RANKS // len(profiles.names), "right")))
        mine = slice(low, ends[last - 1])
        places = profiles.ranks[at[mine]]
        out = np.where(places < TOP, np.abs(places - rank[mine, None]), TOP)
        distance = np.add.reduceat(out, starts[first:last] - low, axis=0, dtype=np.int64)
        best = distance.argmin(axis=1)
        for i, b in zip(text[starts[first:last]].tolist(), best.tolist(), strict=True):
            names[i] = profiles.names[b]
        scores[text[starts[first:last]]] = 1 - distance[np.arange(len(best)), best] / ((ends[first:last] - starts[first:last]) * TOP)
        first = last
    return names, scores


def _predictor(shared):  # noqa: ANN001, ANN202
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in c.slices(batches):
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                names, scores = rank_documents(part.column("text").fill_null("").to_pylist(), profiles)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, type=pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return predict


def predict_languages(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) for each row of ``docs``, from its whole text alone.

    Texts that are null or hold no letters are ``und`` with score 0, and so is every text if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_profiles(learned))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_predictor(shared), "doc_id long, lang_pred string, score double")


def _keeper(shared, least: float):  # noqa: ANN001, ANN202
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                names, scores = rank_documents(part.column("text").fill_null("").to_pylist(), shared.value)
                yield part.filter(pa.array(np.array([n != UNKNOWN for n in names], dtype=bool) & (scores >= least)))

    return keep


#: Least score of a recognised language; prose of a learned language scores about twice as much.
LEAST_SCORE = 0.2


def recognised(docs: DataFrame, learned: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` (text a string) whose language is known and near enough, all columns kept; nothing is shuffled."""
    return docs.mapInArrow(_keeper(docs.sparkSession.sparkContext.broadcast(_profiles(learned)), least), docs.schema)


def held_out():  # noqa: ANN201
    """Documents that are not learned from; those with a null id are neither."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.read(spark, sf_dir, "documents")
    found = predict_languages(docs, learn_profiles(docs.where(~held_out() & F.col("doc_id").isNotNull())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op2_language_id": op2_language_id}

ORACLE: dict[str, str] = {}
