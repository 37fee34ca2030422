"""Exact de-duplication, ranked lexical search and the conversation trie: brute force, hot groups, recovery, odd rows."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltfleet.llm import common, conversation_trie, exact_dedup, lexical_search

TEXTS = [None, "", " ", "\t\n", "a b", "a  b", "a\tb", " a b", "A b", "a b ", "ñ b", "x" * 3000, "hot"]


def index(spark, name):
    return exact_dedup.open_index(spark, f"{common.shared_folder(spark)}/{name}", 4)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, True, 2) for i, t in rows], "doc_id long, text string, digest string, row int, kept boolean, batch int")


def test_exact_groups_equal_brute_force(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(i, "hot") for i in range(100, 900)] + [(5, "a b"), (5, "a b"), (None, "a b"), (None, "lone"), (None, "lone")]
    at = index(spark, "exact-brute")
    exact_dedup.ingest(at, 1, docs(spark, rows))
    got = exact_dedup.report(at).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    assert len(got) == len(rows)
    kept = defaultdict(int)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for r in got:
        mine = groups[by_sha[r["text_sha256"]]]
        ids = [i for i in mine if i is not None]
        assert r["group_size"] == len(mine)
        assert r["keep_id"] == (min(ids) if ids else None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}


def test_later_batches_are_judged_by_the_index_and_can_be_repeated(spark):
    at = index(spark, "exact-batches")
    first, second = docs(spark, [(7, "old"), (8, "old"), (9, "solo")]), docs(spark, [(1, "old"), (2, "new"), (3, "new  "), (4, "new ")])
    exact_dedup.ingest(at, 1, first)
    exact_dedup.ingest(at, 2, second)
    want = {(7, 7, 3, True), (8, 7, 3, False), (1, 7, 3, False), (9, 9, 1, True), (2, 2, 1, True), (3, 3, 2, True), (4, 3, 2, False)}
    found = lambda: {tuple(r)[:4] for r in exact_dedup.report(at).collect()}
    assert found() == want
    exact_dedup.ingest(at, 2, second)
    assert found() == want
    again = exact_dedup.open_index(spark, at.folder, 4)
    exact_dedup.compact(again)
    assert found() == want and again.rows.count() == 4


def test_the_index_is_not_shuffled(spark, capsys):
    at = index(spark, "exact-plan")
    exact_dedup.ingest(at, 1, docs(spark, [(1, "a"), (2, "b")]))
    heads = docs(spark, [(3, "c")]).select(exact_dedup.digest_of(F.col("text")).alias("digest")).repartition(4, "digest")
    heads.join(at.rows.select("digest").hint("merge"), "digest", "left_anti").explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange") == 1


def test_exact_on_nothing(spark):
    at = index(spark, "exact-none")
    exact_dedup.ingest(at, 1, docs(spark, []))
    assert exact_dedup.report(at).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def best(rows, items, k=10):
    bags = [(i, terms(t)) for i, t in rows]
    n_docs, total = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = defaultdict(int)
    for _, w in bags:
        for t in set(w):
            df[t] += 1
    pooled = defaultdict(set)
    for i, t in items:
        if i is not None:
            pooled[i] |= set(terms(t))
    out = []
    for item, asked in pooled.items():
        scored = []
        for i, w in bags:
            if not w:
                continue
            m = 10 + 90 * len(w) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in asked & set(w))
            if s:
                scored.append((-s, math.inf if i is None else i))
        out += [(item, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows", "leaf", "groups"), [(50, 3, 4), (8192, 16, 1 << 14), (7, 1, 1)])
def test_ranking_equals_brute_force(spark, monkeypatch, rows, leaf, groups):
    monkeypatch.setattr(lexical_search, "TREE_ROWS", rows)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "GROUPS", groups)
    rng = np.random.default_rng(4)
    vocabulary = np.array([f"w{i}" for i in range(80)] + ["Ünï", "漢字", "don", "ABC"])
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=weights / weights.sum()))
    table = [(i, text(int(n))) for i, n in enumerate(rng.integers(1, 60, 300))] + [(1000 + i, "w70 w71 w72 hot") for i in range(200)]
    table += [(None, "w70 w71 w72 hot w1"), (None, None), (5, "w70 w71 w72 hot w1"), (5, "w70 w71 w72 hot w1"), (6, ""), (7, "--- ..."), (8, "w60 w61 " * 5000)]
    items = [(i, text(12)) for i in range(25)] + [(100, "HOT w72; w71-w70"), (101, None), (102, "!!"), (103, "never seen"), (None, "w1"), (104, "w60"), (104, "w61")]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in table], "doc_id long, text string, terms string, n int, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical_search.ranked(frame, asked).collect()), key=str)
    assert got == best(table, items)
    if rows == 50:
        small = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical_search.ranked(frame, asked, block_terms=60).collect()), key=str)
        assert small == got


def test_ranking_nothing(spark):
    frame, asked = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.ranked(frame.where("false"), asked).count() == 0
    assert lexical_search.ranked(frame, asked.where("false")).count() == 0
    assert [tuple(r)[:3] for r in lexical_search.ranked(frame, asked).collect()] == [(1, 1, 1)]


def test_balls_of_clustered_documents_are_pruned():
    rng = np.random.default_rng(6)
    ids, sizes, columns = np.arange(8192), np.full(8192, 12), []
    for i in range(8192):
        columns.append(np.sort(rng.choice(20, 12, replace=False)) + 20 * (i % 128))
    terms_, value = np.concatenate(columns), rng.integers(1, 10**6, 8192 * 12)
    tree = lexical_search.plant(ids, sizes, terms_, value, np.arange(2560))
    items = lexical_search.Items(np.arange(128), np.arange(129) * 3, np.concatenate([20 * i + np.array([1, 5, 9]) for i in range(128)]), np.arange(2560), np.ones(2560, dtype=np.int64), np.arange(2560), 8192, 1)
    hits = lexical_search.Hits(items, 10)
    hits.search(tree)
    scores = np.zeros((8192, 2560), dtype=np.int64)
    scores[np.repeat(ids, 12), terms_] = value
    for i in range(128):
        whole = scores[:, items.terms[3 * i : 3 * i + 3]].sum(axis=1)
        assert hits.found[i][1].tolist() == np.lexsort((ids, -whole))[:10].tolist()
    assert hits.leaves < 0.05 * 128 * 512


def trie_of(conversations):
    """conversations: {id: [(role, text, words)]}; a dictionary of nodes by prefix."""
    members = defaultdict(list)
    for i, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(i)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []

    def walk(p):
        leaves, saved = (0 if children[p] else 1), ((len(members[p]) - 1) * p[-1][2] if p else 0)
        for q in children[p]:
            more = walk(q)
            leaves, saved = leaves + more[0], saved + more[1]
        ends = ",".join(map(str, sorted(i for i in members[p] if len(conversations[i]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if conversations:
        walk(())
    return sorted(out, key=str)


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def got_trie(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("turns", "rows", "chunk"), [(1 << 18, 1 << 16, 4096), (9, 5, 2), (4, 1, 1), (40, 12, 3)])
def test_trie_equals_brute_force(spark, monkeypatch, turns, rows, chunk):
    for name, value in (("BLOCK_TURNS", turns), ("BLOCK_ROWS", rows), ("CHUNK_IDS", chunk)):
        monkeypatch.setattr(conversation_trie, name, value)
    rng = np.random.default_rng(5)
    said = [("user", "a b c"), ("user", "a"), ("assistant", "x  y"), (None, None), ("", "user"), ("use", "r")]
    table, conversations = [], {}
    for i in range(-3, 300):
        n = int(rng.integers(1, 9)) if i % 11 else 60
        chosen = [said[int(k)] for k in rng.integers(0, len(said), n)] if i % 3 else [said[k % 2] for k in range(n)]
        order = rng.permutation(n)
        table += [(i, None if k == 0 else int(k), *chosen[k], 1) for k in order]
        conversations[i] = [(r or "", t or "", n_words(t)) for r, t in chosen]
    table += [(1000 + i, 1, "user", "hot start", 1) for i in range(500)]
    conversations |= {1000 + i: [("user", "hot start", 2)] for i in range(500)}
    table.append((None, 1, "user", "nobody", 1))
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, depth int").repartition(3)
    assert got_trie(conversation_trie.trie(conversation_trie.sequences(conversation_trie.ordered_turns(frame)))) == trie_of(conversations)


def test_trie_of_nothing_and_of_no_turns(spark):
    turns = spark.createDataFrame([], "conv_id long, pos long, digest binary, words long")
    assert conversation_trie.trie(conversation_trie.sequences(turns)).count() == 0
    bare = spark.createDataFrame([(3, None, None, None), (1, None, None, None)], "conv_id long, pos long, digest binary, words long")
    assert got_trie(conversation_trie.trie(conversation_trie.sequences(bare))) == trie_of({1: [], 3: []})


def test_equal_turns_and_long_conversations(spark):
    table = [(1, 0, "u", f"t {i % 7}") for i in range(3000)] + [(2, 0, "u", "b"), (2, 0, "u", "a"), (2, None, "u", "z")]
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    got = conversation_trie.trie(conversation_trie.sequences(conversation_trie.ordered_turns(frame))).collect()
    assert len(got) == 1 + 3000 + 3 and max(r["depth"] for r in got) == 3000
    assert [r["n_leaves"] for r in got if r["depth"] == 0] == [2]


def test_shared_starts(spark):
    turns = conversation_trie.ordered_turns(spark.createDataFrame([(c, t, "u", f"{c} {t}") for c in (20, 21, 22, 23, 45) for t in range(5 if c != 22 else 1)], "conv_id long, turn long, role string, text string"))
    digest = {(r["conv_id"], r["pos"]): bytes(r["digest"]) for r in turns.collect()}
    import zlib

    got = {r["conv_id"]: bytes(r["packed"]) for r in conversation_trie.sequences(conversation_trie.with_shared_starts(turns)).collect()}
    for c, own in ((20, 5), (21, 5), (22, 1), (23, 5), (45, 5)):
        h = zlib.crc32(str(c).encode()) % 4
        head = [digest[20, p] for p in range(h)] if c != 45 else []
        assert got[c] == b"".join(head + [digest[c, p] for p in range(h, own)])
