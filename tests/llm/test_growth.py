"""Inputs on which work or memory once grew with a product: each in seconds."""

import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltfleet.llm import decontaminate, language, urls


def test_many_items_of_one_repeated_window(spark):
    phrase = "one two three four five six seven eight nine ten"
    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.lit(phrase).alias("text"))
    docs = spark.createDataFrame([(1, f"{phrase} " * 1250), (2, "clean words only"), (3, phrase)], "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: r for r in decontaminate.leak_report(docs, items).collect()}
    assert (got[1]["n_hit"], got[1]["n_items"], got[2]["n_items"], got[3]["n_items"]) == (12_500, 20_000, 0, 20_000)
    joined = {r["doc_id"]: r["n_items"] for r in decontaminate.leak_report(docs, items, part_windows=10).collect()}
    assert joined == {1: 20_000, 2: 0, 3: 20_000}
    assert time.time() - began < 60


def test_memory_of_ranking_does_not_grow_with_texts_times_languages():
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = ["".join(x) for x in rng.choice(letters, (20_000, 28))]
    grams = np.unique(language._grams(texts[:2000], np.zeros(2000, dtype=np.int64)).gram)
    ranks = np.full((len(grams) + 1, 100), language.TOP, dtype=np.int32)
    for k in range(100):
        ranks[rng.choice(len(grams), language.TOP, replace=False), k] = np.arange(language.TOP)
    profiles = language.Profiles([f"l{k:02}" for k in range(100)], grams, ranks)
    few = language.rank_documents(texts[:50], profiles)
    tracemalloc.start()
    names, scores = language.rank_documents(texts, profiles)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names[:50] == few[0] and np.allclose(scores[:50], few[1])
    assert peak < 400e6


def test_chunks_of_texts_rank_alike(monkeypatch):
    texts = ["the quick fox", "", "le renard", "1234", "der fuchs und der hund"] * 7
    learned = language._grams(texts, np.arange(len(texts), dtype=np.int64) % 3)
    grams = np.unique(learned.gram)
    ranks = np.full((len(grams) + 1, 3), language.TOP, dtype=np.int32)
    for k in range(3):
        mine = np.searchsorted(grams, learned.gram[learned.text == k])
        ranks[mine, k] = np.arange(len(mine)) % language.TOP
    profiles = language.Profiles(["a", "b", "c"], grams, ranks)
    whole = language.rank_documents(texts, profiles)
    monkeypatch.setattr(language, "_RANKS", 3)
    part = language.rank_documents(texts, profiles)
    assert whole[0] == part[0] and np.array_equal(whole[1], part[1])


def test_entropy_of_hosts_of_many_letters(spark):
    wide = "".join(chr(0x4E00 + i % 20_000) + chr(0xAC00 + i % 11_000) for i in range(50_000))
    cases = ["", "aaaa", "abab", "abcd", "example.com", wide]
    began = time.time()
    got = [r["e"] for r in spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", urls._entropy(F.col("t")).alias("e")).orderBy("i").collect()]
    for text, e in zip(cases, got, strict=True):
        n = np.unique(list(text), return_counts=True)[1] if text else np.array([])
        assert e == pytest.approx(float(-(n / n.sum() * np.log2(n / n.sum())).sum()) if text else 0.0)
    assert time.time() - began < 30
    pages = spark.createDataFrame([(k, f"https://{t}/en/") for k, t in enumerate(cases)] + [(9, "https://a.net/es/")], "page_id long, url string")
    assert urls.judge_urls(pages).count() == 7
