"""Exact quantiles by passes, bootstrap by sums, medians of later values: against sorting and brute force."""

import numpy as np
import pytest

from voltfleet.functions import selection

SHARES = (0.0, 0.1, 0.5, 0.77, 1.0)


@pytest.mark.parametrize(("cells", "few"), [(4096, 2048), (3, 4), (2, 1)])
def test_exact_quantiles_equal_sorting(spark, cells, few):
    rng = np.random.default_rng(7)
    groups = {
        "spread": rng.normal(size=500).tolist(),
        "clustered": (10.0 ** rng.integers(-9, 9, 300)).tolist() + [-1e300, 1e300, 5e-324],
        "hot": [3.0] * 400 + rng.normal(3, 1e-6, 100).tolist(),
        "one": [42.0],
        "two": [1.0, 2.0],
        None: [5.0, None, float("nan"), float("inf"), 7.0],
        "none": [None, None],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "metric string, value double").repartition(3)
    got = {r["metric"]: r for r in selection.exact_quantiles(df, "value", SHARES, "metric", cells, few).collect()}
    assert set(got) == set(groups) - {"none"}
    for g, r in got.items():
        values = np.array([v for v in groups[g] if v is not None and np.isfinite(v)])
        assert r["n"] == len(values) and np.allclose(r["q"], np.quantile(values, SHARES), rtol=1e-12), g
    whole = selection.exact_quantiles(df, "value", SHARES, None, cells, few).first()
    every = np.array([v for vs in groups.values() for v in vs if v is not None and np.isfinite(v)])
    assert whole["n"] == len(every) and np.allclose(whole["q"], np.quantile(every, SHARES), rtol=1e-12)
    assert selection.exact_quantiles(df.where("metric = 'none'"), "value", SHARES).count() == 0


def test_a_pass_shuffles_counts_only(spark):
    df = spark.range(200_000).selectExpr("sqrt(id) as v")
    r = selection.exact_quantiles(df, "v", (0.25, 0.5), cells=64, few=100).first()
    assert np.allclose(r["q"], np.quantile(np.sqrt(np.arange(200_000)), (0.25, 0.5)))


def test_bootstrap_of_a_correlation_equals_resampling_by_its_weights(spark, monkeypatch):
    monkeypatch.setattr(selection, "_HELD", 500)
    rng = np.random.default_rng(8)
    x = rng.normal(size=120)
    y = 0.6 * x + rng.normal(size=120) + 1e6
    ids = rng.integers(0, 2**48, 120)
    df = spark.createDataFrame([(int(i), float(a), float(b)) for i, a, b in zip(ids, x, y, strict=True)] + [(1, None, 2.0)], "id long, x double, y double").repartition(4)
    got = selection.bootstrap_correlation(df, "x", "y", 400).first()
    weights = selection.poisson_weights(ids, 400)
    assert abs(weights.mean() - 1) < 0.02 and abs(weights.var() - 1) < 0.05
    rhos = [np.corrcoef(np.repeat(x, w), np.repeat(y, w))[0, 1] for w in weights.T]
    assert np.allclose([got["rho"], got["low"], got["high"]], [np.corrcoef(x, y)[0, 1], *np.quantile(rhos, [0.025, 0.975])])
    assert got["n"] == 120 and got["low"] < got["rho"] < got["high"]


def test_bootstrap_of_nothing_and_of_no_spread(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 4.0)], "id long, x double, y double")
    assert selection.bootstrap_correlation(df, "x", "y", 20).first()["low"] is None
    assert selection.bootstrap_correlation(df.where("false"), "x", "y", 20).first()["n"] == 0


def test_medians_of_later_values(spark):
    rng = np.random.default_rng(9)
    values = [*rng.integers(0, 9, 200).astype(float).tolist(), None, 3.0, float("nan"), 4.0]
    got = selection.medians_of_later(values)
    for i, g in enumerate(got):
        later = [v for v in values[i + 1 :] if v is not None and v == v]
        assert g == (np.median(later) if later else None)
    rows = [(v, m, float(x), "k") for v in (1, 2) for m, x in enumerate(rng.permutation(40))]
    df = spark.createDataFrame(rows, "vin long, month int, soh double, tag string").repartition(3)
    out = {(r["vin"], r["month"]): r["later"] for r in selection.later_medians(df, "soh", "later").collect()}
    for v in (1, 2):
        mine = [x for w, _, x, _ in rows if w == v]
        assert all(out[v, m] == (np.median(mine[m + 1 :]) if m < 39 else None) for m in range(40))
    long = selection.medians_of_later(rng.normal(size=100_000).tolist())
    assert long[-1] is None and len(long) == 100_000


def test_contrasting_pair_equals_all_pairs(spark):
    from voltfleet.operators import joins

    rng = np.random.default_rng(10)
    rows = [(int(v), "ab"[int(v) % 2], float(n), float(f)) for v, n, f in zip(range(1, 400), rng.integers(-300, 300, 399) / 4, rng.integers(0, 12, 399), strict=True)]
    rows += [(1000, "lone", 5.0, 1.0), (1001, "far", 0.0, 1.0), (1002, "far", 99.0, 9.0), (1003, "same", 1.0, 4.0), (1005, "same", 1.0, 4.0), (1004, "same", 2.0, 4.0), (1006, "a", None, 99.0), (1007, "a", 1.0, None)]
    df = spark.createDataFrame(rows, "vin long, oem string, km double, low double").repartition(3)
    got = {r["oem"]: (r["apart"], r["vin_a"], r["vin_b"]) for r in joins.contrasting_pair(df, "km", "low", 2.0, "oem").collect()}
    want = {}
    for v, g, n, f in rows:
        for w, h, m, k in rows:
            if g == h and v < w and None not in (n, m, f, k) and abs(n - m) <= 2.0:
                want[g] = min(want.get(g, (1, 0, 0)), (-abs(f - k), v, w))
    assert got == {g: (-a, v, w) for g, (a, v, w) in want.items()}
