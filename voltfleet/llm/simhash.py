"""SimHash near-duplicates by the generalised pigeonhole principle.

Two 64-bit fingerprints within ``tau`` bits of each other are, for some part of a division of the bits, within that part's
threshold, if the parts' thresholds plus one sum to ``tau`` + 1. Bits that go together are put into one part, and thresholds
are allotted by dynamic programming on estimated numbers of candidates, from bit statistics of all fingerprints. A part with
threshold t is probed by its bits with any t of them masked out; candidates of equal probes are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations
from math import comb, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common as c
from .graph import components, forest

BITS = 64
SEED = 42
#: Seconds that a probe row and a compared pair cost, about.
ROW_S, PAIR_S = 2e-6, 1e-8
#: Fingerprints that are compared with each other at once; larger groups of equal probes are dealt out in pairs of blocks.
BLOCK = 4096
#: Probe rows that meet in a bucket, on average, and the fewest buckets.
BUCKET_ROWS = 200_000
LEAST_BUCKETS = 512


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` lower-cased words, repeats included; of the whole text if it has fewer, none if none."""
    words = text.translate(c.LOWER).split()
    if not words:
        return np.empty(0, dtype="<u8")
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, SEED)], dtype="<u8")
    ends = np.cumsum([len(x) + 1 for x in words])
    starts = np.concatenate([[0], ends[:-1]])
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)], dtype="<u8")


def majority(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits that over half of the hashes have set, as one number."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 255):  # one byte counts up to 255, so eight bits are added at once
        bits = np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.view(np.uint64).sum(axis=0, dtype=np.uint64).view(np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of each bit over all shingle hashes; 0 without words."""
    return int(majority(shingle_hashes(text, shingle))[0])


def _fingerprints(shingle: int):  # noqa: ANN202
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            prints = np.array([fingerprint(t, shingle) for t in c.raw_texts(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return rows


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, print (the 64 bits as a long) of each row's whole text; null texts have no words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_fingerprints(shingle), "doc_id long, print long")


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _co_occurrence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros((BITS, BITS)), 0
    for batch in batches:
        x = _bits(batch.column("print").to_numpy()).astype(np.float64)
        total += x.T @ x
        n += len(x)
    cells = np.append(total.reshape(-1), n)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), type=pa.int32()), pa.array(cells)], names=["cell", "n"])


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have each pair of bits set: 4,097 sums, whatever the input."""
    cells = prints.select("print").mapInArrow(_co_occurrence, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS + 1)
    for row in cells:
        out[row["cell"]] = row["n"]
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Divide the bits into parts of near-equal width, each grown by the bit that goes most with those it has."""
    share = np.diag(together) / max(1, n)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs(together / max(1, n) - np.outer(share, share)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for width in (len(x) for x in np.array_split(np.arange(BITS), parts)):
        part = [left.pop(0)]
        while len(part) < width:
            best = max(left, key=lambda b: (tie[b, part].sum(), -b))
            left.remove(best)
            part.append(best)
        out.append(sorted(part))
    return out


def _costs(n: int, share: np.ndarray, part: list[int], most: int) -> list[float]:
    """Estimated seconds for thresholds -1 (unused), 0, ..., most."""
    differ = np.array([1.0])
    for b in part:
        p = 2 * share[b] * (1 - share[b])
        differ = np.append(differ, 0) * (1 - p) + np.append(0, differ) * p
    out = [0.0]
    for t in range(most + 1):
        pairs = n * n / 2 * sum(differ[d] * comb(len(part) - d, t - d) for d in range(t + 1))
        out.append(n * comb(len(part), t) * ROW_S + pairs * PAIR_S)
    return out


def allot_thresholds(costs: list[list[float]], tau: int) -> tuple[float, list[int]]:
    """Least total cost with thresholds whose successors sum to tau + 1, by dynamic programming over the parts."""
    best = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for done, (total, chosen) in best.items():
            for t, extra in enumerate(cost, start=-1):
                key = done + t + 1
                if key <= tau + 1 and total + extra < new.get(key, (inf, []))[0]:
                    new[key] = (total + extra, [*chosen, t])
        best = new
    return best[tau + 1]


def plan_probes(n: int, together: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """(part, mask of the bits to compare) of every probe, for the division of least estimated cost."""
    share = np.diag(together) / max(1, n)
    options = []
    for parts in range(1, min(tau + 1, 16) + 1):
        division = correlated_parts(n, together, parts)
        most = min(tau, 3)
        try:
            cost, thresholds = allot_thresholds([_costs(n, share, p, min(most, len(p))) for p in division], tau)
        except KeyError:
            continue
        options.append((cost, division, thresholds))
    _, division, thresholds = min(options, key=lambda x: x[0])
    probes = []
    for i, (part, t) in enumerate(zip(division, thresholds, strict=True)):
        for masked in combinations(part, t) if t >= 0 else ():
            mask = sum(1 << b for b in part if b not in masked)
            probes.append((i, mask - (1 << BITS) if mask >> 63 else mask))
    return probes


def _linker(tau: int):  # noqa: ANN202
    def link(table: pa.Table) -> pa.Table:
        key, own = table.column("key").to_numpy(), table.column("print").to_numpy().view(np.uint64)
        order = np.argsort(key, kind="stable")
        key, (kinds, node) = key[order], np.unique(own[order], return_inverse=True)
        label, at, step = np.arange(len(kinds)), np.arange(len(key)), 1
        a, b, held = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], 0
        while len(at):
            at = at[at + step < len(key)]
            at = at[key[at + step] == key[at]]
            close = at[np.bitwise_count(kinds[node[at]] ^ kinds[node[at + step]]) <= tau]
            a.append(node[close])
            b.append(node[close + step])
            held += len(close)
            step += 1
            if held > 1 << 20 or not len(at):
                label = forest(len(kinds), np.concatenate([np.arange(len(kinds)), *a]), np.concatenate([label, *b]))
                a, b, held = [], [], 0
        linked = np.flatnonzero(label != np.arange(len(kinds)))
        return pa.table([pa.array(kinds[linked].view(np.int64)), pa.array(kinds[label[linked]].view(np.int64))], names=["a", "b"])

    return link


def _in_blocks(rows: DataFrame, key: str, block: int, by: str = "print") -> DataFrame:
    """Rows with column task: all rows of a key, or for keys of over ``block`` rows, each pair of blocks of half that size, dealt by ``by``."""
    hot = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > block).select(key, F.ceil(F.col("n") * 2 / block).alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = rows.join(hot, key, "left").withColumn("own", F.pmod(F.xxhash64(by, F.lit(7)), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.withColumn("task", F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"))).drop("blocks", "own", "other")


def links(prints: DataFrame, tau: int) -> DataFrame:
    """Links a-b between distinct fingerprints (column print) that connect all pairs within tau bits.

    Every pair within tau bits is compared, but of each bucket's links only a spanning forest is returned. Groups of over
    ``BLOCK`` equal probes are divided at random into blocks, and each pair of blocks is compared in a group of its own.
    """
    n, together = bit_statistics(prints)
    probes = plan_probes(n, together, tau)
    masks = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("long").alias("mask")) for i, m in probes])
    keyed = prints.select("print", F.explode(masks).alias("probe")).select("print", F.xxhash64("probe.part", "probe.mask", F.col("print").bitwiseAND(F.col("probe.mask"))).alias("key"))
    dealt = _in_blocks(keyed, "key", BLOCK).select("print", F.col("task").alias("key"))
    buckets = max(LEAST_BUCKETS, n * len(probes) // BUCKET_ROWS)
    return dealt.withColumn("bucket", F.pmod(F.shiftright("key", 20), F.lit(buckets))).groupBy("bucket").applyInArrow(_linker(tau), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, tau: int = 4) -> DataFrame:
    """doc_id, print, component_id (smallest doc_id reachable over links of at most tau bits) for each row of ``docs``.

    Repeated rows are rows of their own. Rows with a null doc_id link like others but never name a component; a component of
    such rows only has a null component_id. Documents without words have the fingerprint 0.
    """
    own = c.cut(fingerprints(docs, shingle))
    kinds = c.cut(own.groupBy("print").agg(F.min("doc_id").alias("least")))
    roots = components(links(kinds, tau))
    named = c.cut(kinds.join(roots, kinds["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return c.join_one(own, c.cut(c.join_one(named, names, "root").select("print", "component_id")), "print")


#: Bits up to which documents meet by the pigeonhole before their shingles are compared.
TAU = 4
#: Words of a wide fingerprint, of 64 bits each, and the share of pairs at the least similarity that the probes must meet.
WIDE, MEET = 8, 0.999
#: How much less than the least similarity the estimate of a pair to verify may be: 3.7 standard errors of 512 bits.
MARGIN = 0.15
#: Documents of a group of candidates that each other one is compared with first.
LEADERS = 4
#: Documents of a group of candidates that are verified together; larger groups are dealt out in pairs of blocks.
VERIFY_BLOCK = 1024
#: Shingles up to which bits say too little: pairs whose smaller set has no more are found by shared shingles instead.
SMALL = 48
#: Expected documents of the sample that tells common shingles, and the fewest that make a shingle one.
SAMPLE, COMMON = 16_384, 8


def turned(similarity: float) -> float:
    """Expected share of differing bits of two sets of such a Jaccard similarity."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def plan_wide(n: int, similarity: float) -> tuple[int, int]:
    """Width and number of parts, all with threshold 0, of least estimated cost that meet ``MEET`` of the pairs."""
    options = []
    for width in range(8, 25):
        parts = int(np.ceil(np.log(1 - MEET) / np.log(1 - (1 - turned(similarity)) ** width)))
        if parts * width <= WIDE * BITS:
            options.append((n * parts * ROW_S + n * n / 2 * parts / 2**width * PAIR_S, width, parts))
    return min(options)[1:]


def _digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a sorted set of shingles."""
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def parity(hashes: np.ndarray) -> int:
    """64 bits, each the parity of the shingles that fall on it: maps of two sets differ in no more bits than the sets do in shingles."""
    return int(np.bitwise_xor.reduce(np.uint64(1) << (c.mix(hashes) & np.uint64(63)), initial=np.uint64(0)))


def may_be_similar(a, b, maps, similarity: float):  # noqa: ANN001, ANN201
    """Whether sets of a and b shingles can be similar, by their sizes and the bits in which their parity maps differ; never false for those that are."""
    return (np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9) & (np.bitwise_count(maps) <= (1 - similarity) / (1 + similarity) * (a + b) + 1e-9)


def rarest(hashes: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest shingles of a set, as many as it takes for two similar sets to share one; correct in any order that all sets have."""
    kinds, counts = common
    at = np.minimum(np.searchsorted(kinds, hashes), max(0, len(kinds) - 1))
    often = np.where(kinds[at] == hashes, counts[at], 0) if len(kinds) else np.zeros(len(hashes), dtype=np.int64)
    return hashes[np.lexsort((hashes, often))[: len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1]]


def _small_shingles(shingle: int, largest: int):  # noqa: ANN202
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            sets = [np.unique(shingle_hashes(t, shingle)) for t in c.raw_texts(batch.column("text")) if len(t) < largest * 200]
            sets = [x for x in sets if len(x) <= largest]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, dtype="<u8"), *sets]).view(np.int64))], names=["hash"])

    return rows


def common_shingles(texts: DataFrame, n: int, shingle: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, sorted, and their counts, of those that several small documents of a sample have; only an order depends on them."""
    sample = texts.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(max(n, 1))) < SAMPLE)
    found = sample.mapInArrow(_small_shingles(shingle, largest), "hash long").groupBy("hash").count().where(F.col("count") >= COMMON).toArrow()
    kinds = found.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(kinds)
    return kinds[order], found.column("count").to_numpy()[order]


def _wide(shingle: int, width: int, parts: int, similarity: float, common):  # noqa: ANN001, ANN202
    """Digest, size, fingerprint, wide fingerprint with its keys, and parity map with rarest shingles, of each document's set of shingles;
    like the similarity they take a repeated one once. The fingerprint is the wide one's first word. Sets of up to ``SMALL`` have no keys
    and of the wide one only that word, and those that are too large to be similar to one have no shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts, largest = c.mix(np.arange(1, WIDE + 1, dtype=np.uint64) << np.uint64(32)), int(SMALL / similarity + 1e-9)
        for batch in c.slices(batches):
            prints, digests, sizes, maps, rare = np.zeros((batch.num_rows, WIDE), dtype="<u8"), [], [], [], []
            for i, text in enumerate(c.raw_texts(batch.column("text"))):
                hashes = np.unique(shingle_hashes(text, shingle))
                words = WIDE if len(hashes) > SMALL else 1
                prints[i, :words] = [majority(c.mix(hashes ^ salt))[0] for salt in salts[:words]]
                digests.append(_digest(hashes))
                sizes.append(len(hashes))
                maps.append(parity(hashes))
                rare.append(rarest(hashes, similarity, common.value).view(np.int64).tolist() if len(hashes) <= largest else [])
            bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")[:, : parts * width].reshape(-1, parts, width)
            keys = bits.astype(np.int64) @ (1 << np.arange(width)) + np.arange(parts) * (1 << width)
            columns = [pa.array(digests, type=pa.binary()), pa.array([p.tobytes() for p in prints], type=pa.binary()), pa.array([k if n > SMALL else [] for k, n in zip(keys.tolist(), sizes, strict=True)], type=pa.list_(pa.int64()))]
            columns += [pa.array(sizes, type=pa.int32()), pa.array(np.array(maps, dtype=np.uint64).view(np.int64)), pa.array(rare, type=pa.list_(pa.int64()))]
            columns.append(pa.array(prints[:, 0].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "digest", "print", "keys", "size", "map", "rare", "own"])

    return rows


def _wide_linker(most: int):  # noqa: ANN202
    """Link documents whose wide fingerprints differ in at most ``most`` bits; a spanning forest of a bucket's links."""

    def link(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        key, (ids, node) = table.column("key").to_numpy()[order], np.unique(table.column("doc_id").to_numpy()[order], return_inverse=True)
        prints = np.frombuffer(b"".join(table.column("print").to_pylist()), dtype="<u8").reshape(-1, WIDE)[order]
        label, at, step, loose = np.arange(len(ids)), np.arange(len(key)), 1, most / WIDE + 12
        while len(at):
            at = at[at + step < len(key)]
            at = at[key[at + step] == key[at]]
            close = at[np.bitwise_count(prints[at, 0] ^ prints[at + step, 0]) <= loose]
            close = close[np.bitwise_count(prints[close] ^ prints[close + step]).sum(axis=1, dtype=np.int64) <= most]
            if len(close):
                label = forest(len(ids), np.concatenate([np.arange(len(ids)), node[close]]), np.concatenate([label, node[close + step]]))
            step += 1
        linked = np.flatnonzero(label != np.arange(len(ids)))
        return pa.table([pa.array(ids[linked]), pa.array(ids[label[linked]])], names=["a", "b"])

    return link


def _small_linker(similarity: float):  # noqa: ANN202
    """Link documents that share a key and may be similar; a spanning forest of a bucket's links."""

    def link(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        key, size, maps = (table.column(x).to_numpy()[order] for x in ("key", "size", "map"))
        ids, node = np.unique(table.column("doc_id").to_numpy()[order], return_inverse=True)
        maps, label, at, step = maps.view(np.uint64), np.arange(len(ids)), np.arange(len(key)), 1
        while len(at):
            at = at[at + step < len(key)]
            at = at[key[at + step] == key[at]]
            close = at[may_be_similar(size[at], size[at + step], maps[at] ^ maps[at + step], similarity)]
            if len(close):
                label = forest(len(ids), np.concatenate([np.arange(len(ids)), node[close]]), np.concatenate([label, node[close + step]]))
            step += 1
        linked = np.flatnonzero(label != np.arange(len(ids)))
        return pa.table([pa.array(ids[linked]), pa.array(ids[label[linked]])], names=["a", "b"])

    return link


def _sets(shingle: int):  # noqa: ANN202
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            sets = [np.unique(shingle_hashes(t, shingle)).tobytes() for t in c.raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("doc_id", "group", "print")), pa.array(sets, type=pa.binary())], names=["doc_id", "group", "print", "shingles"])

    return rows


def _similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have the least Jaccard similarity."""
    small, large = sorted((len(a), len(b)))
    if small < similarity * large:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (small + large - common)


def _led(similarity: float):  # noqa: ANN202
    """Links of documents to their group's leaders, with the group."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches, "shingles"):
            a, b, which = [], [], []
            ids, sets, groups = (batch.column(x).to_pylist() for x in ("doc_id", "shingles", "group"))
            for i, own in enumerate(sets):
                mine = np.frombuffer(own, dtype="<u8")
                for leader in batch.column("leaders")[i].as_py():
                    if leader["doc_id"] != ids[i] and _similar(mine, np.frombuffer(leader["shingles"], dtype="<u8"), similarity):
                        a.append(ids[i])
                        b.append(leader["doc_id"])
                        which.append(groups[i])
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (a, b, which)], names=["a", "b", "group"])

    return rows


def _left_to_verify(members: DataFrame, near: DataFrame) -> DataFrame:
    """Members with label and task, of the groups in which no leader is near all others.

    Documents near the leader with most of them have its label and need no comparison with each other: each block of the others
    meets each block of all. So a large group of near copies of one text costs a row for each document, and one for each block of stragglers.
    """
    main = near.groupBy("group", "b").agg(F.count("*").alias("n")).groupBy("group").agg(F.max_by("b", F.struct("n", "b")).alias("main"))
    main = c.cut(main)
    led = c.join_one(near, main, "group").where("b = main").select(F.col("a").alias("doc_id"), F.lit(True).alias("led"))
    label = F.when(F.coalesce("led", F.lit(False)) | (F.col("doc_id") == F.col("main")), F.col("main")).otherwise(F.col("doc_id"))
    named = c.cut(c.join_one(members.select("doc_id", "group"), main, "group", "left").join(led, "doc_id", "left").select("doc_id", "group", label.alias("label"), (label == F.col("main")).alias("in_main")))
    blocks = lambda n: F.greatest(F.ceil(n * 2 / VERIFY_BLOCK), F.lit(1))
    counts = named.groupBy("group").agg(F.count_if("in_main").alias("mains"), F.count_if(~F.coalesce("in_main", F.lit(False))).alias("others"))
    open_ = c.cut(counts.where("others > 0").select("group", blocks(F.col("mains")).alias("mains"), blocks(F.col("others")).alias("others")))
    rows = members.join(c.join_one(named, open_, "group").drop("group"), "doc_id")
    deal = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(7)), n)
    row = lambda *cells: F.struct(*[x.cast("long").alias(n) for x, n in zip(cells, "xyz", strict=True)])
    other, every = ~F.coalesce("in_main", F.lit(False)), lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    with_others = F.transform(every(F.col("others")), lambda o: row(F.lit(0), F.least(o, deal(F.col("others"))), F.greatest(o, deal(F.col("others")))))
    with_mains = F.transform(every(F.col("mains")), lambda m: row(F.lit(1), deal(F.col("others")), m))
    from_main = F.transform(every(F.col("others")), lambda o: row(F.lit(1), o, deal(F.col("mains"))))
    tasks = F.when(other, F.concat(with_others, with_mains)).otherwise(from_main)
    return rows.withColumn("cell", F.explode(tasks)).withColumn("task", F.xxhash64("group", "cell")).drop("cell", "in_main", "mains", "others")


def _verifier(similarity: float, most: int):  # noqa: ANN202
    """Links of at least the least exact Jaccard similarity, but for pairs that are already connected; likeliest pairs first."""

    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        prints = np.frombuffer(b"".join(table.column("print").to_pylist()), dtype="<u8").reshape(-1, WIDE)[order]
        raw = table.column("shingles").to_pylist()
        sets = [np.frombuffer(raw[i], dtype="<u8") for i in order.tolist()]
        sizes, maps = np.array([len(x) for x in sets]), np.array([parity(x) for x in sets], dtype=np.uint64)
        labels = table.column("label").to_numpy()[order]
        pairs = [np.empty((0, 3), dtype=np.int64)]
        for i in range(len(ids) - 1):
            apart = np.bitwise_count(prints[i + 1 :] ^ prints[i]).sum(axis=1, dtype=np.int64)
            close = (apart <= most) | (np.bitwise_count(prints[i + 1 :, 0] ^ prints[i, 0]) <= TAU)
            near = np.where(np.minimum(sizes[i], sizes[i + 1 :]) <= SMALL, may_be_similar(sizes[i], sizes[i + 1 :], maps[i + 1 :] ^ maps[i], similarity), close)
            j = np.flatnonzero(near & (labels[i + 1 :] != labels[i]))
            pairs.append(np.stack([apart[j], np.full(len(j), i), j + i + 1], axis=1))
        _, root = np.unique(labels, return_index=True)  # documents of a label are connected already
        root = root[np.searchsorted(np.unique(labels), labels)].tolist()

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        every, a, b = np.concatenate(pairs), [], []
        for _, i, j in every[np.argsort(every[:, 0], kind="stable")].tolist():
            p, q = find(i), find(j)
            if p != q and _similar(sets[i], sets[j], similarity):
                root[max(p, q)] = min(p, q)
                a.append(ids[i])
                b.append(ids[j])
        return pa.table([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], names=["a", "b"])

    return verify


def _large_groups(members: DataFrame, similarity: float, most: int) -> DataFrame:
    """Links of groups of over ``VERIFY_BLOCK`` documents: with leaders, and of what these leave apart with all others, in blocks."""
    members = c.cut(members)
    leaders = F.array_distinct(F.array(F.min("doc_id"), *[F.min_by("doc_id", F.xxhash64("doc_id", F.lit(k))) for k in range(1, LEADERS)]))
    chosen = members.groupBy("group").agg(leaders.alias("leaders")).select(F.explode("leaders").alias("doc_id"))
    leading = members.join(chosen, "doc_id").groupBy("group").agg(F.collect_list(F.struct("doc_id", "shingles")).alias("leaders"))
    near = c.cut(c.join_one(members.select("doc_id", "group", "shingles"), leading, "group").mapInArrow(_led(similarity), "a long, b long, group long"))
    return near.select("a", "b").unionByName(_left_to_verify(members, near).groupBy("task").applyInArrow(_verifier(similarity, most), "a long, b long"))


def within_bits(rows: DataFrame, tau: int) -> DataFrame:
    """Links a-b that connect all documents whose fingerprints (column own) differ in at most tau bits, by the probes of :func:`links`."""
    each = c.cut(rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("own").alias("own")))
    kinds = c.cut(each.groupBy(F.col("own").alias("print")).agg(F.min("doc_id").alias("least")))
    ends = [kinds.select(F.col("print").alias(x), F.col("least").alias(f"least_{x}")) for x in "ab"]
    near = c.join_one(c.join_one(c.cut(links(kinds, tau)), ends[0], "a"), ends[1], "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    equal = c.join_one(each.select("doc_id", "own"), kinds.withColumnRenamed("print", "own"), "own").where("doc_id <> least")
    return near.unionByName(equal.select(F.col("doc_id").alias("a"), F.col("least").alias("b")))


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, component_id of the documents that have a similar one; component_id is the smallest id of the group.

    Similarity is the Jaccard similarity of word shingles. Candidates are, first, all pairs whose 64-bit fingerprints differ in at
    most ``TAU`` bits, by the generalised pigeonhole. For pairs farther apart there are 512 SimHash bits: at 0.8 they differ in a
    seventh of their bits, too many for a pigeonhole guarantee, so the parts have threshold 0 and meet 999 in 1000 of such pairs,
    and more of nearer ones. Bits of few shingles say too little, so pairs whose smaller set has at most ``SMALL`` are all found, by
    a shared one of their rarest shingles, too. Groups of candidates are then verified by their exact shingles: of large ones each document
    with a few leaders, then what these leave apart with all others, in blocks. Texts of equal shingle sets are folded
    before probing; those that only have equal bits are not. Documents with a null id or without words have no group.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    n = docs.count()
    width, parts = plan_wide(max(n, 1), similarity)
    buckets = max(LEAST_BUCKETS, n * parts // (BUCKET_ROWS // 8))
    most = int(turned(similarity - MARGIN) * WIDE * BITS)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(texts, n, shingle, int(SMALL / similarity + 1e-9)))
    rows = c.cut(texts.mapInArrow(_wide(shingle, width, parts, similarity, common), "doc_id long, digest binary, print binary, keys array<long>, size int, map long, rare array<long>, own long"))
    copies = rows.where(F.size("keys") > 0).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *[F.first(x).alias(x) for x in ("print", "keys")])
    tasks = _in_blocks(copies.select("doc_id", "print", F.explode("keys").alias("key")), "key", BLOCK, "doc_id").select("doc_id", "print", F.col("task").alias("key"))
    found = tasks.withColumn("bucket", F.pmod(F.shiftright("key", 20), F.lit(buckets))).groupBy("bucket").applyInArrow(_wide_linker(most), "a long, b long")
    few = rows.where(F.size("rare") > 0).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *[F.first(x).alias(x) for x in ("size", "map", "rare")])
    tasks = _in_blocks(few.select("doc_id", "size", "map", F.explode("rare").alias("key")), "key", BLOCK, "doc_id").select("doc_id", "size", "map", F.col("task").alias("key"))
    found = found.unionByName(tasks.withColumn("bucket", F.pmod(F.shiftright("key", 20), F.lit(buckets))).groupBy("bucket").applyInArrow(_small_linker(similarity), "a long, b long"))
    found = within_bits(rows, TAU).unionByName(found)
    groups = components(found).select(F.col("node").alias("doc_id"), F.col("root").alias("group"))
    members = c.cut(rows.select("doc_id", "print").join(groups, "doc_id").join(texts, "doc_id").mapInArrow(_sets(shingle), "doc_id long, group long, print binary, shingles binary"))
    big = c.cut(groups.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > VERIFY_BLOCK).select("group"))
    small = members.join(big, "group", "left_anti").withColumn("label", F.col("doc_id"))
    exact = small.groupBy("group").applyInArrow(_verifier(similarity, most), "a long, b long")
    if not big.isEmpty():
        exact = exact.unionByName(_large_groups(members.join(big, "group", "left_semi"), similarity, most))
    least = c.cut(rows.groupBy("digest").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n"))
    roots = c.cut(components(exact).select(F.col("node").alias("doc_id"), F.col("root").alias("component_id")))
    copies_of = c.join_one(rows.select("doc_id", "digest"), least, "digest").select("doc_id", "b").where("doc_id <> b")
    named = c.join_one(copies_of, roots.select(F.col("doc_id").alias("b"), "component_id"), "b", "left").select("doc_id", F.coalesce("component_id", "b").alias("component_id"))
    alone = least.select(F.col("b").alias("doc_id")).join(roots, "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("component_id"))
    return roots.unionByName(named).unionByName(alone)


def one_row_of_each_id(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each repeated id, the one whose text sorts first; rows with a null id stay. Nothing is shuffled where ids are unique."""
    repeated = c.cut(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if repeated.isEmpty():
        return docs
    row = F.struct(*docs.columns)
    least = F.min_by(row, F.struct(F.col("text"), F.to_json(row))).alias("row")
    folded = docs.join(repeated, "doc_id", "left_semi").select(docs.columns)
    return c.cut(docs.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(folded.groupBy(F.col("doc_id").alias("id")).agg(least).select("row.*")))


def one_of_each(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without those that have a similar document with a smaller id, all columns kept. Of rows with one id one stays, see :func:`one_row_of_each_id`."""
    docs = one_row_of_each_id(docs)
    losers = similar_groups(docs, shingle, similarity).where("doc_id <> component_id").select("doc_id")
    return docs.join(losers, "doc_id", "left_anti").select(docs.columns)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(c.read(spark, sf_dir, "documents"), shingle=4, tau=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash_near_dedup": op4_simhash_near_dedup}

ORACLE: dict[str, str] = {}
