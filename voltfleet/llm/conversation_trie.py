"""The prefix trie of conversations, by range minima over the common prefixes of sorted sequences.

A turn is a 128-bit digest of role and text, a conversation the sequence of its turns' digests. Equal sequences are folded to
one; the distinct ones are sorted over the cluster and cut into blocks of bounded size. In a block a sparse table over the
lengths of common prefixes of neighbours answers range minima in constant time, and each candidate prefix (a sequence and a
depth) finds by two binary searches, independent of all others, how far to the left and to the right sequences share it. That
interval is the node's members; candidates of the same interval and depth are the same node, and what a node needs to know are
sums, minima and counts over intervals.

Only prefixes of a block's first and last sequence can have members in other blocks. Their parts are gathered, two sequences
from each block, and put together by the same searches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

#: Turns and conversations of a block, at most, but for a single conversation of more turns.
BLOCK_TURNS, BLOCK_ROWS = 1 << 18, 1 << 16
#: Ids of a piece of a long list of members.
CHUNK_IDS = 4096
#: Bytes of a turn's digest.
WIDTH = 16
_MOST = np.iinfo(np.int64).max
_NO_ENDS = hashlib.sha256(b"").hexdigest()
#: What is known of a node but its parent.
_NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of SHA-256 over role and text, of which nulls are empty; the role's length keeps the two apart."""
    role, text = (F.coalesce(x.cast("string"), F.lit("")) for x in (role, text))
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest, words of ``turns`` (conv_id, turn, role, text) in order of turn, null first.

    Rows of equal turn are in order of their digests; equal rows are turns of their own. Rows with a null conv_id take no part.
    Texts are reduced to a digest and a number of words before anything is shuffled.
    """
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest(F.col("role"), F.col("text")).alias("digest"), words.alias("words"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")) - 1
    return rows.where("conv_id is not null").select("conv_id", place.cast("long").alias("pos"), "digest", "words")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column("turns")
        digests = b"".join(turns.flatten().field("digest").to_pylist())
        ends = np.concatenate([[0], np.cumsum(turns.value_lengths().to_numpy())])
        packed = pa.Array.from_buffers(pa.large_binary(), len(turns), [None, pa.py_buffer(ends * WIDTH), pa.py_buffer(digests)]).cast(pa.binary())
        words = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), turns.flatten().field("words"))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), packed, words], names=["conv_id", "packed", "words"])


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, packed (its turns' digests on end), words (of each turn) for each conv_id of ``turns`` (conv_id, pos, digest, words).

    A row whose pos is null stands for a conversation that may have no turns. A conversation's digests are one row, 24 bytes a turn.
    """
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "digest", "words"))
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")).mapInArrow(_packed, "conv_id long, packed binary, words array<long>")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of key and conv_id: a digest of each group that surely lies here whole, and pieces of the others."""
    rows: list[tuple] = []
    key, ids, parted, first = None, [], True, True

    def close(whole: bool) -> None:
        text = ",".join(map(str, ids))
        rows.append((key, ids[0], len(ids), None if whole else text, hashlib.sha256(text.encode()).hexdigest() if whole else None))

    def given() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["key", "rep", "n", "chunk", "sha"])
        rows.clear()
        return out

    for batch in batches:
        for mine, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if mine != key:
                if ids:
                    close(not parted)
                key, ids, parted, first = mine, [], first, False
            elif len(ids) >= CHUNK_IDS:
                close(False)
                ids, parted = [], True
            ids.append(conv)
        if rows:
            yield given()
    if ids:
        close(False)  # the group may go on in the next partition
        yield given()


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces in order of key and first id: the digest of each group's pieces on end."""
    key, rep, n, state = None, 0, 0, None
    for batch in batches:
        out: list[tuple] = []
        for mine, conv, size, chunk in zip(*(batch.column(x).to_pylist() for x in ("key", "rep", "n", "chunk")), strict=True):
            if mine != key:
                if state:
                    out.append((rep, n, state.hexdigest()))
                key, rep, n, state = mine, conv, 0, hashlib.sha256()
            elif state:
                state.update(b",")
            state.update(chunk.encode())
            n += size
        if out:
            yield _ends(out)
    if state:
        yield _ends([(rep, n, state.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["rep", "n", "sha"])


def folded(found: DataFrame) -> DataFrame:
    """packed, words, rep (smallest conv_id), n, sha (digest of all conv_ids in order) of each distinct sequence.

    Members are dealt by ranges of sequence and id, so many equal ones are spread; a list that ranges cut is digested from
    pieces, which pass through a task one after the other.
    """
    keys = found.select(F.unhex(F.sha2("packed", 256)).alias("key"), "conv_id")
    parts = c.cut(keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_chunks, "key binary, rep long, n long, chunk string, sha string"))
    linked = parts.where("chunk is not null").repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_linked, "rep long, n long, sha string")
    ends = parts.where("sha is not null").select("rep", "n", "sha").unionByName(linked)
    return found.join(ends, F.col("conv_id") == F.col("rep")).drop("conv_id")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


def _table(x: np.ndarray) -> list[np.ndarray]:
    """Sparse table: at level k the minima of all runs of 2^k."""
    out = [x]
    while 2 << len(out) - 1 <= len(x):
        half = 1 << len(out) - 1
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def _least(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minima of the runs from ``left`` to ``right``."""
    k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), dtype=np.int64)
    for level in np.unique(k):
        at = k == level
        out[at] = np.minimum(table[level][left[at]], table[level][right[at] - (1 << level) + 1])
    return out


class Nodes(NamedTuple):
    """Nodes in order of first row and depth, and what leads to them.

    left, right, depth: rows and depth of each node; end: the node after the last of its subtree, which begins with itself;
    parent: its parent's number (of the root its own); of: the node of each candidate; at: each row's first candidate.
    """

    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    end: np.ndarray
    parent: np.ndarray
    of: np.ndarray
    at: np.ndarray


def common_prefixes(digests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many turns each of the sequences, given on end, shares with the one before; -1 for the first."""
    starts = np.cumsum(sizes) - sizes
    out = np.full(len(sizes), -1, dtype=np.int64)
    k = np.minimum(sizes[1:], sizes[:-1])
    out[1:] = 0
    some = np.flatnonzero(k)
    if len(some):
        n = k[some]
        j = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        same = digests[np.repeat(starts[some], n) + j] == digests[np.repeat(starts[some + 1], n) + j]
        out[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(n, n), j), np.cumsum(n) - n)
    return out


def find_nodes(shared: np.ndarray, sizes: np.ndarray) -> Nodes:
    """Nodes of sorted distinct sequences of ``sizes`` turns, whose neighbours have ``shared`` turns in common."""
    m, table = len(sizes), _table(shared)
    at = np.cumsum(sizes + 1) - sizes - 1
    row = np.repeat(np.arange(m), sizes + 1)
    depth = np.arange(len(row)) - at[row]
    left, right = row.copy(), row.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        to = left - step
        left = np.where((to >= 0) & (table[k][np.clip(to + 1, 0, len(table[k]) - 1)] >= depth), to, left)
    for k in range(len(table) - 1, -1, -1):
        to = right + (1 << k)
        right = np.where((to < m) & (table[k][np.clip(right + 1, 0, len(table[k]) - 1)] >= depth), to, right)
    own = np.flatnonzero(left == row)
    number = np.full(len(row), -1, dtype=np.int64)
    number[own] = np.arange(len(own))
    of = number[at[left] + depth]
    up = own - (depth[own] > 0)
    return Nodes(left[own], right[own], depth[own], np.searchsorted(left[own], right[own], "right"), of[up], of, at)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x)])


class Block(NamedTuple):
    """Consecutive distinct sequences."""

    packed: list[bytes]
    sizes: np.ndarray
    words: np.ndarray
    rep: np.ndarray
    n: np.ndarray
    sha: list[str]

    @property
    def digests(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.packed), dtype=f"V{WIDTH}")


_INNER = f"{_NODE}, parent_conv_id long, side int, side_depth long"
_EDGE = "packed binary, words array<long>, last boolean, n array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>"
_BLOCKS = f"block binary, {_INNER}, {_EDGE}"


def _block_rows(b: Block) -> tuple[dict, dict]:
    """Nodes that lie in a block whole, and of its first and last sequence, for each of their prefixes, what the block knows of it."""
    m = len(b.sizes)
    shared = common_prefixes(b.digests, b.sizes)
    nodes = find_nodes(shared, b.sizes)
    starts = np.cumsum(b.sizes) - b.sizes
    inner = (nodes.left > 0) & (nodes.right < m - 1)
    members = _sums(b.n)
    n = members[nodes.right + 1] - members[nodes.left]
    least = _least(_table(b.rep), nodes.left, nodes.right)
    words = np.where(nodes.depth > 0, np.append(b.words, 0)[starts[nodes.left] + nodes.depth - 1], 0)
    saved = _sums(np.where(inner, (n - 1) * words, 0))
    leaf = np.append(shared[1:], 0) < b.sizes
    leaf[-1] = False  # only the next block can tell
    leaves = _sums(leaf)
    leaves = leaves[nodes.right + 1] - leaves[nodes.left]
    children = np.bincount(nodes.parent[inner], minlength=len(n))
    ends = np.array([b.sha[i] if b.sizes[i] == d else None for i, d in zip(nodes.left.tolist(), nodes.depth.tolist(), strict=True)], dtype=object)
    i = np.flatnonzero(inner)
    up = nodes.parent[i]
    whole = inner[up]
    found = {
        "conv_id": least[i],
        "depth": nodes.depth[i],
        "n_convs": n[i],
        "n_children": children[i],
        "n_leaves": leaves[i],
        "saved_tokens": saved[nodes.end[i]] - saved[i],
        "ends_sha256": [e or _NO_ENDS for e in ends[i]],
        "parent_conv_id": pa.array(least[up], mask=~whole),
        "side": pa.array((nodes.left[up] > 0).astype(np.int32), mask=whole),
        "side_depth": pa.array(nodes.depth[up], mask=whole),
    }
    by_row = _sums(np.bincount(nodes.left, weights=np.diff(saved), minlength=m).astype(np.int64))
    edges: dict[str, list] = {"side": []} | {k.split()[0]: [] for k in _EDGE.split(", ")}
    for side in range(min(m, 2)):
        row = side * (m - 1)
        mine = nodes.of[nodes.at[row] : nodes.at[row] + b.sizes[row] + 1]
        new = np.ones(len(mine), dtype=bool) if not side else nodes.left[mine] > 0  # the first sequence has what both share
        for name, value in (
            ("side", side),
            ("packed", b.packed[row]),
            ("words", b.words[starts[row] : starts[row] + b.sizes[row]].tolist()),
            ("last", row == m - 1),
            ("n", np.where(new, n[mine], 0).tolist()),
            ("least", np.where(new, least[mine], _MOST).tolist()),
            ("children", np.where(new, children[mine], 0).tolist()),
            ("leaves", np.where(new, leaves[mine], 0).tolist()),
            ("saved", np.where(new, by_row[nodes.right[mine] + 1] - by_row[nodes.left[mine]], 0).tolist()),
            ("ends", ends[mine].tolist()),
        ):
            edges[name].append(value)
    return found, edges


def _schema(text: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return [(name, kinds[kind]) for name, kind in (x.split() for x in text.split(", "))]


def _batch(schema: str, rows: dict, block: bytes) -> pa.RecordBatch:
    n = len(next(iter(rows.values())))
    columns = [pa.array([block] * n, type=t) if name == "block" else pa.nulls(n, t) if name not in rows else rows[name] if isinstance(rows[name], pa.Array) else pa.array(rows[name], type=t) for name, t in _schema(schema)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in _schema(schema)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = turns = 0

    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        col = {x: t.column(x).combine_chunks() for x in t.column_names}
        sizes = col["words"].value_lengths().to_numpy().astype(np.int64)
        b = Block(col["packed"].to_pylist(), sizes, col["words"].flatten().to_numpy(), col["rep"].to_numpy(), col["n"].to_numpy(), col["sha"].to_pylist())
        block = hashlib.sha256(b.packed[0]).digest()
        for part in _block_rows(b):
            yield _batch(_BLOCKS, part, block)

    for batch in batches:
        ends, at = np.cumsum(batch.column("words").value_lengths().to_numpy()), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = min(batch.num_rows, at + BLOCK_ROWS - rows, max(at + 1, int(np.searchsorted(ends, before + BLOCK_TURNS - turns, "right"))))
            held.append(batch.slice(at, to - at))
            rows, turns, at = rows + to - at, turns + int(ends[to - 1] - before), to
            if rows >= BLOCK_ROWS or turns >= BLOCK_TURNS or at < batch.num_rows:
                yield from done()
                held, rows, turns = [], 0, 0
    if held:
        yield from done()


_TOP = f"block binary, side int, side_depth long, {_NODE}, parent_conv_id long, node boolean"


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that prefixes of the blocks' first and last sequences are, and for each such prefix its node's conv_id."""
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    t = pa.Table.from_batches(held)
    packed = t.column("packed").to_pylist()
    order = sorted(range(len(packed)), key=packed.__getitem__)
    t = t.take(pa.array(order)).combine_chunks()
    col = {x: t.column(x).combine_chunks() for x in t.column_names}
    sizes = col["words"].value_lengths().to_numpy().astype(np.int64)
    shared = common_prefixes(np.frombuffer(b"".join(packed[i] for i in order), dtype=f"V{WIDTH}"), sizes)
    nodes = find_nodes(shared, sizes)
    flat = {x: col[x].flatten().to_numpy(zero_copy_only=False) for x in ("n", "least", "children", "leaves", "saved", "ends")}
    row = np.repeat(np.arange(len(sizes)), sizes + 1)

    def total(x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(nodes.left), dtype=np.int64)
        np.add.at(out, nodes.of, x)
        return out

    n, least = total(flat["n"]), np.full(len(nodes.left), _MOST)
    np.minimum.at(least, nodes.of, flat["least"])
    leaf = (np.append(shared[1:], -1) < sizes) & col["last"].to_numpy(zero_copy_only=False)
    ends = np.full(len(nodes.left), _NO_ENDS, dtype=object)
    some = np.flatnonzero([e is not None for e in flat["ends"]])
    ends[nodes.of[some]] = flat["ends"][some]
    starts = np.cumsum(sizes) - sizes
    words = np.where(nodes.depth > 0, np.append(col["words"].flatten().to_numpy(), 0)[starts[nodes.left] + nodes.depth - 1], 0)
    own = _sums((n - 1) * words)
    root = nodes.depth == 0
    found = {
        "conv_id": least,
        "depth": nodes.depth,
        "n_convs": n,
        "n_children": total(flat["children"]) + np.bincount(nodes.parent[~root], minlength=len(n)),
        "n_leaves": total(flat["leaves"] + leaf[row]),
        "saved_tokens": total(flat["saved"]) + own[nodes.end] - own[: len(n)],
        "ends_sha256": ends.tolist(),
        "parent_conv_id": pa.array(least[nodes.parent], mask=root),
        "node": np.ones(len(n), dtype=bool),
    }
    yield _batch(_TOP, found, b"")
    known = {"side": pa.array(col["side"].to_numpy()[row]), "side_depth": np.arange(len(row)) - nodes.at[row], "conv_id": least[nodes.of], "node": np.zeros(len(row), dtype=bool)}
    known["block"] = col["block"].take(pa.array(row))
    yield _batch(_TOP.replace("block binary, ", ""), known, b"").add_column(0, "block", known["block"])


def trie(found: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    ``found`` has conv_id (unique, not null), packed and words, as :func:`sequences` gives them. Conversations without turns are
    members of the root alone. Without any conversation there is no node, not even the root.
    """
    rows = folded(c.cut(found)).repartitionByRange("packed").sortWithinPartitions("packed").mapInArrow(_blocks, _BLOCKS)
    parts = c.cut(rows)
    edges = parts.where("packed is not null").select("block", "side", *(x.split()[0] for x in _EDGE.split(", ")))
    top = c.cut(edges.repartition(1).mapInArrow(_put_together, _TOP))
    known = top.where("not node").select("block", "side", "side_depth", F.col("conv_id").alias("up"))
    inner = parts.where("depth is not null").join(known, ["block", "side", "side_depth"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(names).unionByName(top.where("node").select(names))


def with_shared_starts(turns: DataFrame, every: int = 20) -> DataFrame:
    """Ordered turns in which each conversation starts as the one with the next smaller multiple of ``every`` does.

    Its first h turns, h being its id's crc32 modulo 4, are those of that conversation, all of them if there are fewer and none
    if there is no such conversation; its own turns from the h-th on follow. One more row of each conversation has no pos.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    every_id = turns.where("pos = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < 3)).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    copied = every_id.join(heads, "base").where("pos < h").select("conv_id", "pos", "digest", "words")
    nothing = every_id.select("conv_id", *(F.lit(None).cast(t).alias(n) for n, t in (("pos", "long"), ("digest", "binary"), ("words", "long"))))
    return turns.where(F.col("pos") >= h).unionByName(copied).unionByName(nothing)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = c.cut(ordered_turns(c.read(spark, sf_dir, "conversations")))
    return trie(sequences(with_shared_starts(turns)))


QUERIES = {"op13_conversation_trie": op13_conversation_trie}

ORACLE = {
    "op13_conversation_trie": r"""
WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p,
                  sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations),
h AS (SELECT c, c - c % 20 AS base,
             xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                 lambda a, b: list_reduce([xor(a, b)] || range(8), lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 4 AS h FROM (SELECT DISTINCT c FROM o)),
r AS (SELECT o.c, p, s, w FROM o JOIN h USING (c) WHERE p >= h UNION ALL SELECT h.c, p, s, w FROM h JOIN o ON o.c = h.base WHERE p < h),
d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS depth, string_agg(s, '') OVER (PARTITION BY c ORDER BY p) AS k, w FROM r UNION ALL SELECT c, 0, '', 0 FROM h),
n AS (SELECT k, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM d GROUP BY k),
e AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM (SELECT c, max_by(k, depth) AS k FROM d GROUP BY c) GROUP BY k),
u AS (SELECT left(k, 64 * (depth - 1)) AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
b AS (SELECT left(x.k, 64 * x.a) AS k, count(*) FILTER (WHERE u.k IS NULL) AS n_leaves, sum((n_convs - 1) * w) AS saved
      FROM (SELECT k, n_convs, w, unnest(range(0, depth + 1)) AS a FROM n) AS x LEFT JOIN u ON u.k = x.k GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n LEFT JOIN e USING (k) LEFT JOIN u USING (k) JOIN b USING (k) LEFT JOIN n AS up ON n.depth > 0 AND up.k = left(n.k, 64 * (n.depth - 1))""",
}
