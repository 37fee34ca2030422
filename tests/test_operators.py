import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltfleet.functions import bounded, folds, stats
from voltfleet.operators import clean, evaluate, events, incremental, joins, models, pooled, quality, samples
from voltfleet.operators import series as sr
from voltfleet.operators import soh as so
from voltfleet.plans import models as plans
from voltfleet.sources import fixtures as fx
from voltfleet.sources import scans
from voltfleet.streaming import live

FOLDER = "/root/testdata/sf0.001"


def fading(spark, vehicles=12, months=24, noise=0.3):
    """Vehicles that lose 0.1 to 0.9 points a month."""
    rng = np.random.default_rng(1)
    rows = []
    for v in range(vehicles):
        for m in range(months):
            level = 100 - (0.1 + 0.8 * v / vehicles) * m + rng.normal(0, noise)
            rows.append((v, dt.datetime(2020 + m // 12, m % 12 + 1, 1), float(m), float(level), 10, 30.0 + v, 1000.0, 0.1, 20.0))
    return spark.createDataFrame(rows, "vin long, month timestamp, age_months double, soh double, n long, temp_max double, km_month double, frac_soc_high double, dod_mean double")


@pytest.mark.parametrize("values", [[1.0], [3.0, 2.0, 1.0], [1.0, 2.0, 3.0], [5.0, 1.0, 4.0, 4.0, 0.0, 9.0], [2.0, 2.0]])
def test_isotonic_equals_its_min_max_form(spark, values):
    got = spark.createDataFrame([(values,)], "x array<double>").select(folds.isotonic(F.col("x")).alias("y")).first()["y"]
    n = len(values)
    expected = [min(max(np.mean(values[a : b + 1]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    assert np.allclose(got, expected)


def test_envelopes_never_rise_and_stay_below_100(spark):
    df = fading(spark, noise=4.0).withColumnRenamed("soh", "soh_raw")
    for build in (sr.greedy_envelope, sr.isotonic_envelope, sr.robust_isotonic):
        out = build(df).withColumn("step", F.col("soh") - F.lag("soh").over(sr.by_month()))
        assert out.where("step > 1e-9 or soh > 100").count() == 0
        again = build(out.drop("soh_raw", "step").withColumnRenamed("soh", "soh_raw")).join(out.select("vin", "month", F.col("soh").alias("before")), ["vin", "month"])
        assert build is sr.robust_isotonic or again.where("abs(soh - before) > 1e-9").count() == 0


@pytest.mark.parametrize(
    ("day", "last", "lookback", "most", "days", "advances", "clamped"),
    [
        ("2024-01-10", None, 1, 14, ["2024-01-10"], True, False),
        ("2024-01-10", None, 3, 14, ["2024-01-08", "2024-01-09", "2024-01-10"], True, False),
        ("2024-01-10", "2024-01-07", 1, 14, ["2024-01-08", "2024-01-09", "2024-01-10"], True, False),
        ("2024-01-10", "2024-01-09", 3, 14, ["2024-01-08", "2024-01-09", "2024-01-10"], True, False),
        ("2024-01-10", "2024-01-10", 3, 14, ["2024-01-10"], False, False),
        ("2024-01-10", "2024-01-12", 1, 14, ["2024-01-10"], False, False),
        ("2024-02-20", "2024-01-10", 1, 3, ["2024-02-18", "2024-02-19", "2024-02-20"], True, True),
    ],
)
def test_catch_up_plan(spark, day, last, lookback, most, days, advances, clamped):
    rows = incremental.plan_days(spark, day, last, lookback, most).orderBy("day").collect()
    assert [str(r["day"]) for r in rows] == days
    assert all((r["advance_to"] is not None) == advances and r["clamped"] == clamped for r in rows)


def test_upsert_folds_repeated_keys(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, load int, v string")
    new = spark.createDataFrame([(2, 2, "c"), (2, 2, "c"), (3, 2, "d")], "k int, load int, v string")
    assert sorted((r["k"], r["v"]) for r in incremental.upsert(old, new, ["k"], "load").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_watermark_and_safety_net(spark, tmp_path):
    path = f"{tmp_path}/mark"
    assert incremental.read_watermark(spark, path) is None
    incremental.write_watermark(spark, path, "2024-01-05")
    incremental.write_watermark(spark, path, "2024-01-03")
    assert incremental.read_watermark(spark, path) == "2024-01-05"
    marks, none = spark.createDataFrame([(1,)], "vin int"), spark.createDataFrame([], "vin int")
    assert incremental.safety_net(marks, marks).first()["state"] == "ok"
    with pytest.raises(Exception, match="built none"):
        incremental.safety_net(marks, none).collect()


def test_sinks_round_trip(spark, tmp_path):
    df = fading(spark, 3, 14)
    scans.write_store(df, f"{tmp_path}/store")
    assert spark.read.parquet(f"{tmp_path}/store/by_month").count() == spark.read.parquet(f"{tmp_path}/store/by_ymd").count() == df.count()
    scans.compact(df.withColumnRenamed("month", "t"), f"{tmp_path}/compact", files_per_month=1)
    assert scans.feed(spark, f"{tmp_path}/compact", ["vin", "soh", "absent"]).where("absent is null").count() == df.count()
    scans.write_by_vehicle(df, f"{tmp_path}/few")
    scans.write_by_vehicle(df, f"{tmp_path}/many", few=2)
    assert spark.read.parquet(f"{tmp_path}/few").count() == spark.read.parquet(f"{tmp_path}/many").count() == df.count()
    scans.write_report(df.limit(2), f"{tmp_path}/json")
    scans.write_report(df.limit(2), f"{tmp_path}/csv", "csv")
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    dimension = scans.csv_dimension(spark, f"{tmp_path}/csv", "vin long, month string", {"month": "yyyy-MM-dd'T'HH:mm:ss.SSSX"})
    assert dimension.where("month is not null").count() == 2


def test_feed_unites_drifting_files_and_prunes_days(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "vin long, soc double").write.parquet(f"{tmp_path}/year=2024/month=1/day=5")
    spark.createDataFrame([(1, 2.0, 3.0)], "vin long, soc double, temp double").write.parquet(f"{tmp_path}/year=2024/month=1/day=6")
    spark.createDataFrame([(1, 2.0, 3.0)], "vin long, soc double, temp double").write.parquet(f"{tmp_path}/year=0/month=1/day=6")
    assert scans.feed(spark, str(tmp_path), merge=True).where("temp is null").count() == 1
    assert scans.feed(spark, str(tmp_path), ["vin"], ["2024-01-06", "2030-01-01"]).count() == 1


def test_cleaning_handles_missing_columns_and_nulls(spark):
    df = spark.createDataFrame([("x", None), (" ", 3.0), (None, 900.0)], "vin string, soc double")
    assert clean.valid_vin(df).count() == 1
    assert [r["soc"] for r in clean.null_outside(df).collect()] == [None, 3.0, None]
    assert df.select(clean.first_present(df, ["absent", "soc"]).alias("x")).where("x is null").count() == 1


def test_sessions_break_at_ties_and_gaps(spark):
    t = dt.datetime(2024, 1, 31, 23, 58)
    rows = [(1, t, 1, 50.0, 10.0), (1, t, 2, 50.0, 10.0), (1, t + dt.timedelta(seconds=60), 3, 51.0, 10.0), (1, t + dt.timedelta(seconds=180), 4, 52.0, 10.0), (1, t + dt.timedelta(hours=3), 5, 60.0, 10.0)]
    df = spark.createDataFrame(rows, "vin long, t timestamp, id long, soc double, amps double")
    assert [r["sid"] for r in events.sessions(df, 300.0).orderBy("id").collect()] == [1, 2, 2, 3, 4]
    assert [r["sid"] for r in events.sessions(df, 300.0, break_at_month=False).orderBy("id").collect()] == [1, 2, 2, 2, 3]


def test_empty_tables_give_empty_results(spark):
    none = fx.telemetry(spark, FOLDER).where("vin < 0")
    assert events.session_rollup(events.sessions(none)).count() == 0
    assert events.event_rollup(events.charge_events(none)).count() == 0
    series = fx.series(spark, FOLDER).where("vin < 0")
    assert sr.robust_isotonic(series).count() == quality.clean_label(series).count() == stats.theil_sen(series, "age_months", "soh_raw").count() == 0


def test_interpolation_clamps_and_keeps_probes_without_knots(spark):
    knots = spark.createDataFrame([(1, 0.0, 10.0), (1, 10.0, 20.0)], "vin long, x double, y double")
    probes = spark.createDataFrame([(1, -5.0), (1, 2.5), (1, 10.0), (1, 99.0), (2, 1.0)], "vin long, x double")
    got = {(r["vin"], r["x"]): r["y"] for r in joins.interpolate(knots, probes, "x", "y").collect()}
    assert got == {(1, -5.0): 10.0, (1, 2.5): 12.5, (1, 10.0): 20.0, (1, 99.0): 20.0, (2, 1.0): None}


def test_feature_store_has_the_contract(spark):
    from voltfleet.plans.soh import feature_store

    store = feature_store(spark, FOLDER)
    assert len(store.columns) == 31
    assert store.count() == 15


def test_bounded_cubic_recovers_and_never_rises(spark):
    x = np.arange(0.0, 24.0)
    rows = [(v, dt.datetime(2020 + int(a) // 12, int(a) % 12 + 1, 1), float(a), float(y)) for v, f in ((1, lambda a: 100 - 0.2 * a - 0.01 * a**2), (2, lambda a: 80 + a)) for a, y in ((a, f(a)) for a in x)]
    df = spark.createDataFrame(rows, "vin long, month timestamp, age_months double, y double")
    fit = {r["vin"]: r for r in bounded.decreasing_cubic(df, "y").collect()}
    assert np.allclose([fit[1][c] for c in ("c0", "c1", "c2", "c3")], [100, 0.2, 0.01, 0], atol=1e-4)
    assert fit[2]["c0"] == pytest.approx(91.5) and fit[2]["c1"] == fit[2]["c2"] == fit[2]["c3"] == 0
    anchored = bounded.evaluate(bounded.decreasing_cubic(df, "y", anchored=True), spark.createDataFrame([(1, 0.0)], "vin long, age_months double"), anchored=True)
    assert anchored.first()["fitted"] == pytest.approx(100.0)


def test_bounded_cubic_keeps_its_digits_over_a_long_life(spark):
    """Fifteen years of months: sixth powers of age reach 3e13."""
    rows = [(1, float(a), float(100 - 0.15 * a - 1e-4 * a**2 - 2e-6 * a**3)) for a in range(181)]
    df = spark.createDataFrame(rows, "vin long, age_months double, y double")
    fit = bounded.decreasing_cubic(df, "y").first()
    assert np.allclose([fit[c] for c in ("c0", "c1", "c2", "c3")], [100, 0.15, 1e-4, 2e-6], rtol=1e-6, atol=0)


def test_pooled_model_recovers_effects(spark):
    rng = np.random.default_rng(3)
    rows = []
    for v in range(300):
        z = rng.normal()
        slope = -0.4 - 0.15 * z + rng.normal(0, 0.05)
        rows += [(v, float(a), float(100 + slope * a + rng.normal(0, 1.5)), 1.0, float(z)) for a in rng.uniform(1, 36, rng.integers(5, 15))]
    df = spark.createDataFrame(rows, "vin long, age_months double, soh double, one double, z double")
    table = pooled.sufficient_statistics(df).join(df.select("vin", "one", "z").distinct(), "vin")
    model = pooled.fit(table, ["one", "z"], 20)
    sd = np.sqrt(np.diag(model.cov))
    assert np.all(np.abs(model.beta - [-0.4, -0.15]) < 3 * sd + 0.01)
    assert model.noise_var == pytest.approx(2.25, rel=0.15)


def test_model_beats_persistence_on_a_fading_fleet(spark):
    df = fading(spark, 24, 30)
    rows = evaluate.holdout(df.where("vin % 2 = 0"), df.where("vin % 2 = 1"))
    error = {r["name"]: r["rmse"] for r in evaluate.summary(rows, samples.populations(df, drop=5.0)).where("degrader is null").collect()}
    assert error["model"] < error["persistence"]


def test_trajectory_trains_on_all_later_months_of_all_vehicles(spark, monkeypatch):
    df = fading(spark, 6, 40)
    assert models.trajectory_rows(df).agg(F.max("horizon")).first()[0] == 36
    assert models.trajectory_rows(df).count() == 6 * sum(range(1, 37))
    seen = []
    monkeypatch.setattr(plans.md, "fit_trajectory", seen.append)
    plans.trajectory(df)
    assert seen[0].select("vin").distinct().count() == 6
    assert seen[0].agg(F.max("horizon")).first()[0] == 36


def test_scored_histories_cover_all_vehicles(spark, monkeypatch):
    df = fading(spark, 6, 12)
    monkeypatch.setattr(plans, "table", lambda s, d: df)
    assert {(r["vin"], r["count"]) for r in plans.book.queries["n18_scored_histories"](spark, FOLDER).groupBy("vin").count().collect()} == {(v, 6) for v in range(6)}
    blank = models.with_defaults(df.withColumn("month", F.when(F.col("vin") % 2 == 0, F.col("month"))))
    assert blank.exceptAll(df).count() == 0


def test_learning_curve_covers_all_vehicles(spark):
    rows = evaluate.learning_curve(fading(spark, 8, 30), (6, 12), 20, 2).collect()
    assert {(r["history"], r["n"]) for r in rows} == {(6, 80), (12, 80)}


def test_forecast_bands_are_ordered(spark):
    out = plans.forecasts(plans.table(spark, FOLDER))
    assert out.where("p10 > p50 + 1e-9 or p50 > p90 + 1e-9 or p10 < 0 or p90 > 100").count() == 0


def test_registered_models_load_again(spark, tmp_path):
    df = samples.transitions(fading(spark))
    model, _ = models.fit_rate(df, ["age_months", "soh"])
    models.register(spark, model, str(tmp_path), "x", {"rmse": 1.0})
    path = models.register(spark, model, str(tmp_path), "x", {"rmse": 1.0})
    assert path.endswith("/x/2")
    assert models.predict(models.load_latest(spark, str(tmp_path), "x"), df).count() == df.count()


@pytest.mark.parametrize(("order", "delay"), [("unix_micros(t)", "1 second"), ("pmod(hash(id), 97)", "4000 days")])
def test_streamed_sessions_equal_batch_sessions(spark, tmp_path, order, delay):
    """In order of time, and in no order at all within the delay; a last heartbeat ends the open sessions."""
    df = clean.keep_inside(fx.telemetry(spark, FOLDER), {"soc": (0, 100), "amps": (-400, 400)})
    cuts = df.select(F.percentile_approx(F.expr(order), [0.3, 0.6])).first()[0]
    for low, high in ((None, cuts[0]), (cuts[0], cuts[1]), (cuts[1], None)):  # one file after the other, as their times of change order them
        key = F.expr(order)
        part = df.where((F.lit(low is None) | (key > F.lit(low))) & (F.lit(high is None) | (key <= F.lit(high))))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    live.heartbeat(df, "9000 days").write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = live.ordered_sessions(stream, 43_200, delay).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["vin"], r["n"], round(r["ah"], 3)) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    batch = sorted((r["vin"], r["n"], round(r["ah"], 3)) for r in events.session_rollup(events.sessions(df, 43_200, break_at_month=False)).collect())
    assert got == batch


def test_quantile_forest_orders_quantiles(spark):
    df = samples.transitions(fading(spark, noise=1.0)).withColumn("id", F.monotonically_increasing_id())
    out = models.quantile_forest(df, df.limit(20), ["age_months", "soh"], "loss")
    assert out.count() == 20 and out.where("q[0] > q[1] or q[1] > q[2]").count() == 0


def test_simple_method_dispatch(spark):
    readings = spark.createDataFrame([(1, dt.datetime(2024, m, 1), 100.0 - m) for m in range(1, 9) for _ in range(15)], "vin long, month timestamp, full_cap double")
    out = so.simple_soh(readings, "bms_capacity")
    assert out.count() == 8 and out.where("soh > 100").count() == 0


def test_zero_bases_give_no_health(spark):
    t0 = dt.datetime(2024, 1, 1)
    charges = spark.createDataFrame([(1, t0, 0.0, 2.0), (1, t0, 0.0, 3.0), (2, t0, 50.0, 2.0), (2, t0, 40.0, 3.0)], "vin long, t0 timestamp, cap double, age_months double")
    got = sorted((r["vin"], r["soh_full"]) for r in so.full_charge_soh(charges).collect() if r["vin"] == 2)
    assert [round(x[1], 3) for x in got] == [88.889, 100.0]
    assert so.full_charge_soh(charges).where("vin = 1 and soh_full is not null").count() == 0
    segments = spark.createDataFrame([(1, t0, 5.0, 0.0)] * 4, "vin long, t timestamp, dkm double, dsoc double")
    assert so.distance_proxy(segments, min_months=1).count() == 0


def test_ranks_over_cells_equal_sorting(spark, monkeypatch):
    from voltfleet.operators import series

    monkeypatch.setattr(series, "CELLS", 7)
    rows = [("a" if k % 3 else "b", float(k * 37 % 101 // 4)) for k in range(300)] + [("a", None)]
    got = {(r["g"], r["v"]): (r["below"], r["ties"], r["of"]) for r in series.with_ranks(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).collect()}
    for g, v in rows:
        own = [x for h, x in rows if h == g and x is not None]
        if v is not None:
            assert got[g, v] == (sum(x < v for x in own), own.count(v), len(own))
