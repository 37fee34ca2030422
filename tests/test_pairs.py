"""Later rows and ranks of groups against brute force."""

import numpy as np
import pytest

from voltfleet.operators import joins, series


@pytest.mark.parametrize("most", [None, 1, 3, 100])
def test_later_pairs_equal_brute_force(spark, most):
    rows = [(v, m * m, None if m == 2 else float(m)) for v in (1, 2, 3) for m in range(2 * v)] + [(None, 1, 1.0), (None, 2, 2.0)]
    df = spark.createDataFrame(rows, "vin long, month int, soh double").select("month", "soh", "vin").repartition(3)
    out = joins.later_pairs(df, "month", most=most)
    assert out.columns == ["vin", "month", "soh", "rn", "later_month", "later_soh", "later_rn"]
    want = [(v, i * i, j * j, j - i) for v in (1, 2, 3) for i in range(2 * v) for j in range(i + 1, 2 * v) if most is None or j - i <= most]
    assert sorted((r["vin"], r["month"], r["later_month"], r["later_rn"] - r["rn"]) for r in out.collect()) == want
    assert sum(r["later_soh"] is None for r in out.collect()) == sum(j == 4 for _, _, j, _ in want)


@pytest.mark.parametrize("large", [10, 150, 65_536])
def test_ranks_of_groups_of_any_size(spark, monkeypatch, large):
    monkeypatch.setattr(series, "LARGE", large)
    rng = np.random.default_rng(12)
    groups = {"big": rng.integers(0, 60, 400), "same": np.full(200, 7), "mid": rng.integers(0, 1000, 100), "one": np.array([3])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("big", None), ("none", None)]
    got = series.with_ranks(spark.createDataFrame(rows, "oem string, soh double").repartition(3), "soh", ["oem"]).collect()
    assert len(got) == 701
    for r in got:
        values = groups[r["oem"]]
        assert (r["below"], r["ties"], r["of"]) == ((values < r["soh"]).sum(), (values == r["soh"]).sum(), len(values))
