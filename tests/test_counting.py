"""Counts without pairs against brute force: earlier smaller entries, inverted pairs, median slopes."""

import numpy as np
import pytest

from voltfleet.functions import counting, stats


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100, 257])
def test_counts_equal_brute_force(n):
    rng = np.random.default_rng(n)
    rank, weight = rng.permutation(n), rng.integers(0, 3, n)
    assert counting.smaller_before(rank, weight).tolist() == [int(weight[:i][rank[:i] < rank[i]].sum()) for i in range(n)]
    pairs = sorted(zip(*(p.tolist() for p in counting.inverted_pairs(rank)), strict=True))
    assert pairs == [(a, b) for a in range(n) for b in range(a + 1, n) if rank[a] > rank[b]]
    assert counting.inversions(rank) == len(pairs)


def all_slopes(x, y):
    return [(y[j] - y[i]) / (x[j] - x[i]) for i in range(len(x)) for j in range(len(x)) if x[i] < x[j]]


def series_of(n):
    rng = np.random.default_rng(n)
    months = np.arange(n) / 30.4
    return {
        "noise": (rng.normal(size=n), rng.normal(size=n)),
        "ties": (rng.integers(0, 20, n).astype(float), rng.integers(0, 5, n).astype(float)),
        "flat": (months, np.full(n, 100.0)),
        "line": (months, 0.3 * months + 1e6),
        "clipped": (months, np.minimum(100, 101 - 0.5 * months + rng.normal(size=n))),
        "wide": (rng.normal(size=n), 10.0 ** rng.integers(-8, 8, n)),
        "one x": (np.zeros(n), rng.normal(size=n)),
        "two x": (np.r_[0.0, np.ones(n - 1)], rng.normal(size=n)),
        "close x": (np.cumsum(10.0 ** rng.integers(-12, 3, n)), rng.normal(size=n)),
        "repeated": (np.tile(months[: n // 2 + 1], 2), np.tile(rng.normal(size=n // 2 + 1), 2)),
    }


@pytest.mark.parametrize("n", [2, 5, 256, 257, 300, 401])
def test_median_slope_equals_all_slopes(n):
    for name, (x, y) in series_of(n).items():
        slopes = all_slopes(x.tolist(), y.tolist())
        got = counting.median_slope(x, y)
        if not slopes:
            assert got is None, name
            continue
        want = float(np.median(slopes))
        assert abs(got - want) <= 1e-9 * max(1e-3, abs(want)), name


def test_slope_of_a_long_series_lists_no_pairs(monkeypatch):
    listed = []
    whole = counting.inverted_pairs
    monkeypatch.setattr(counting, "inverted_pairs", lambda rank: listed.append(counting.inversions(rank)) or whole(rank))
    n = 20_000
    x = np.arange(n, dtype=float)
    noise = np.random.default_rng(3).normal(size=n)
    assert abs(counting.median_slope(x, 90 - 0.5 * x + noise) + 0.5) < 1e-4
    assert counting.median_slope(x, np.where(x % 3, 100.0, 100.0)) == 0.0
    assert listed and max(listed) <= 4 * n  # of 200 million


def test_theil_sen_of_odd_groups(spark):
    nan = float("nan")
    rows = [("a", 0.0, 1.0), ("a", 1.0, 3.0), ("a", 2.0, 50.0), ("a", None, 9.0), ("a", nan, 9.0), ("a", 3.0, nan), ("b", 1.0, 2.0), ("b", 1.0, 4.0), ("c", 1.0, 7.0), ("d", None, 1.0), (None, 0.0, 1.0), (None, 2.0, 2.0)]
    long = series_of(300)
    assert len(long["noise"][0]) > counting.FEW
    rows += [(name, float(u), float(v)) for name, (x, y) in long.items() for u, v in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "car string, t double, y double").repartition(3)
    got = {r["car"]: (r["slope"], r["intercept"], r["n"]) for r in stats.theil_sen(df, "t", "y", "car").collect()}
    assert got["a"] == (24.5, 1.0, 3) and got["b"] == (0.0, 3.0, 2) and got["c"] == (0.0, 7.0, 1) and got[None] == (0.5, 1.0, 2)
    assert set(got) == {"a", "b", "c", None, *long}
    assert stats.theil_sen(df.where("false"), "t", "y", "car").count() == 0
