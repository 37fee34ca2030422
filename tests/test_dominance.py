"""Peers and lower peers by counts against brute force, over strips of a few rows."""

import numpy as np
import pytest

from voltfleet.operators import dominance, joins


def made(n=600):
    rng = np.random.default_rng(11)
    ages = np.where(rng.random(n) < 0.4, 12.0, np.round(rng.uniform(0, 60, n) * 4) / 4)  # two fifths of one age
    values = np.where(rng.random(n) < 0.3, 100.0, np.round(rng.normal(90, 5, n)))
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(["b", "c", "d"], n))
    rows = [(i, str(g), float(a), float(v)) for i, (g, a, v) in enumerate(zip(group, ages, values, strict=True))]
    rows += [(9001, "hot", 12.0, None), (9002, "hot", 18.0, float("nan")), (9003, "hot", None, 5.0), (9004, None, 5.0, 5.0), (9005, "lone", 5.0, 5.0), (9006, "void", 5.0, None), (9007, "hot", float("nan"), 3.0)]
    return rows


def brute(rows, band):
    number = lambda x: x is not None and x == x
    out = {}
    for i, g, a, v in rows:
        if g is None or not number(a):
            continue
        near = [w for _, h, b, w in rows if h == g and number(b) and a - band <= b <= a + band]
        out[i] = (len(near), sum(number(w) and w < v for w in near) if number(v) else None)
    return out


@pytest.mark.parametrize(("strip", "asked"), [(65_536, 131_072), (40, 90), (7, 16), (25, 10_000)])
def test_band_counts_equal_brute_force(spark, strip, asked):
    rows = made()
    df = spark.createDataFrame(rows, "vin long, oem string, age double, soh double").repartition(3)
    got = {r["vin"]: (r["within"], r["lower"]) for r in dominance.band_counts(df, "vin", "age", "soh", "oem", 6.0, strip, asked).collect()}
    assert got == brute(rows, 6.0)


def test_groups_of_one_x_and_one_value(spark):
    rows = [(i, "all", 1.0, 2.0) for i in range(300)]
    df = spark.createDataFrame(rows, "vin long, oem string, age double, soh double")
    got = dominance.band_counts(df, "vin", "age", "soh", "oem", 0.0, 20, 50).collect()
    assert len(got) == 300 and {(r["within"], r["lower"]) for r in got} == {(300, 0)}
    assert dominance.band_counts(df.where("false"), "vin", "age", "soh", "oem", 6.0).count() == 0


def test_keys_of_text_and_dates_of_groups(spark):
    df = spark.sql("select concat('v', id) as car, date'2024-01-01' as g, int(id % 10) as age, int(id) as soh from range(100)")
    got = {r["car"]: (r["within"], r["lower"]) for r in dominance.band_counts(df, "car", "age", "soh", "g", 1, 9, 20).collect()}
    assert got["v55"] == (30, sum(abs(i % 10 - 5) <= 1 for i in range(55)))


def test_peer_rank_takes_the_source_where_peers_are_few(spark):
    rows = [(i, "a", float(i), float(i % 7)) for i in range(40)] + [(100, "a", None, 1.0), (101, "a", 3.0, None)]
    df = spark.createDataFrame(rows, "vin long, oem string, age_months double, soh double")
    got = {r["vin"]: (r["peers"], r["rank"]) for r in joins.peer_rank(df, "soh", band=5.0, least=10).collect()}
    assert set(got) == set(range(40))
    values = [i % 7 for i in range(40)] + [1]
    for i in range(40):
        near = [j for j in range(40) if abs(i - j) <= 5]
        peers = len(near) + (abs(i - 3) <= 5)
        below = sum(j % 7 < i % 7 for j in near) / peers if peers >= 10 else sum(v < i % 7 for v in values) / len(values)
        assert got[i][0] == peers and abs(got[i][1] - 100 * below) < 1e-9
