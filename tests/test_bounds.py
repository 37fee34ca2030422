"""Bounds and ranks that the rounding of sums must not decide."""

import datetime as dt

from voltfleet.operators import events


def test_a_step_just_at_its_bound_is_in_it(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, 0, t0, 0.1, 50.0), (1, 1, t0 + dt.timedelta(minutes=1), 0.1 + 0.2, 40.0), (1, 2, t0 + dt.timedelta(minutes=2), 0.3, 30.0), (1, 3, t0 + dt.timedelta(minutes=3), 0.3 + 1e-12, 20.0)]
    samples = spark.createDataFrame(rows, "vin long, id long, t timestamp, odo double, soc double")
    assert 0.1 + 0.2 - 0.1 > 0.2
    assert [r["t"].minute for r in events.drive_segments(samples, (0.0, 0.2), digits=6).collect()] == [1]


def test_months_just_at_a_range_are_in_it_and_means_that_differ_by_rounding_tie(spark):
    from voltfleet.operators import behaviour

    near = 60.00000000000001
    months = [(v, dt.datetime(2024, m, 1), float(m), 100.0 - m * (1 + v % 3), near if m == 3 else 30.0 + v) for v in range(12) for m in range(1, 6)]
    rows = spark.createDataFrame(months, "vin long, month timestamp, age_months double, soh double, dod double")
    table = behaviour.behaviour_table(rows, {"dod": (0.0, 60.0)}, digits=behaviour.DIGITS)
    assert table.where("dod > 35").count() == 12
    pair = spark.createDataFrame([(1, 0.1 + 0.2, 1.0), (2, 0.3, 1.0), (3, 0.2, 2.0), (4, 0.4, 2.0)], "vin long, a double, loss_rate double")
    assert {r["vin"]: r["pct"] for r in behaviour.percentiles(pair, ["a"]).collect()} == {1: 25.0, 2: 25.0, 3: 0.0, 4: 75.0}
    drivers = behaviour.ranked_drivers(pair, ["a"], least=1, distinct=0).first()
    assert abs(drivers["rho"] - behaviour.ranked_drivers(pair.replace(0.1 + 0.2, 0.3), ["a"], least=1, distinct=0).first()["rho"]) < 1e-12
