"""Flattened and additive ensembles: against MLlib's own predictions, and against a fit without each vehicle."""

import datetime as dt
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_operators import fading
from voltfleet.operators import ensembles, evaluate, leave_one_out, models, samples

FEATURES = ["age_months", "soh", *models.STRESS]


@pytest.fixture(scope="module")
def fleet(spark):
    return fading(spark).withColumns({c: F.col(c) + F.col("vin") % 3 + F.hash("vin", "age_months") % 5 / 10 for c in models.STRESS}).cache()


@pytest.fixture(scope="module")
def rate(fleet):
    return models.fit_rate(samples.transitions(fleet), FEATURES)


def test_flattened_trees_predict_as_mllib_does(fleet, rate):
    rows = models.predict(rate[0], samples.transitions(fleet)).toPandas()
    flat = ensembles.flatten(rate[0].stages[-1])
    assert len(flat.roots) == rate[0].stages[-1].getNumTrees
    assert np.allclose(flat(rows[FEATURES].to_numpy(dtype=float)), rows["prediction"], rtol=0, atol=1e-12)


def test_forests_flatten_too(fleet):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor

    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(samples.transitions(fleet))
    forest = RandomForestRegressor(labelCol="loss", numTrees=5, maxDepth=7, seed=1).fit(rows)
    out = forest.transform(rows).toPandas()
    assert np.allclose(ensembles.flatten(forest)(out[FEATURES].to_numpy(dtype=float)) / 5, out["prediction"])
    stump = DecisionTreeRegressor(labelCol="loss", maxDepth=0).fit(rows)
    assert stump.numNodes == 1


@pytest.mark.parametrize("gate", [None, (0.05, 0.4)])
def test_roll_forward_equals_steps_of_mllib(fleet, rate, gate):
    model, bias = rate
    at = models.anchors(fleet).cache()
    got = {(r["vin"], r["h"]): r["p50"] for r in models.roll_forward(model, bias, at, FEATURES, 15, gate=gate).collect()}
    state = at.toPandas()
    spark = at.sparkSession
    for h in range(1, 16):
        predicted = models.predict(model, spark.createDataFrame(state[["vin", *FEATURES]])).toPandas().set_index("vin")["prediction"]
        for i, vin in enumerate(state["vin"]):
            step = min(max(predicted[vin] + bias, 0.0), 1.2)
            if gate:
                share = min(max((state["recent_loss"][i] - gate[0]) / (gate[1] - gate[0]), 0.0), 1.0)
                step = min((1 - share) * 0.35 * step + share * max(step, 1.25 * state["recent_loss"][i]), 1.2)
            state.loc[i, "soh"] -= step
            state.loc[i, "age_months"] += 1
            assert abs(got[vin, h] - state["soh"][i]) < 1e-9
    assert len(got) == 15 * len(state)


def test_roll_forward_is_one_node_whatever_the_horizon(fleet, rate, capsys):
    plans = []
    for months in (3, 60):
        models.roll_forward(*rate, models.anchors(fleet), FEATURES, months).explain()
        plans.append(capsys.readouterr().out)
    assert plans[0].count("MapInArrow") == 1 and len(plans[0].splitlines()) == len(plans[1].splitlines())


def test_a_missing_feature_gives_no_forecast(fleet, rate):
    at = models.anchors(fleet).withColumn("temp_max", F.when(F.col("vin") > 0, F.col("temp_max")))
    got = models.roll_forward(*rate, at, FEATURES, 3)
    assert got.where("vin = 0 and p50 is null").count() == 3 and got.where("vin > 0 and p50 is null").count() == 0


def test_leaving_one_out_equals_a_fit_without_it(spark, fleet):
    far_rows, near_rows = (x.cache() for x in leave_one_out.training_rows(fleet))
    trees = ensembles.additive(far_rows, models.TRAJECTORY, 12), ensembles.additive(near_rows, FEATURES, 12)
    sums = lambda far, near: [ensembles.leaf_sums(r, t, "label", "mass").cache() for r, t in zip((far, near), trees, strict=True)]
    at = models.anchors(fleet).cache()
    together = {(r["vin"], r["h"]): tuple(r)[2:] for r in leave_one_out.forecasts_without_own(at, *sums(far_rows, near_rows), trees, 8).collect()}
    assert len(together) == 12 * 8
    for vin in range(12):
        others = sums(far_rows.where(F.col("vin") != vin), near_rows.where(F.col("vin") != vin))
        for r in leave_one_out.forecasts_without_own(at.where(F.col("vin") == vin), *others, trees, 8).collect():
            assert np.allclose(together[vin, r["h"]], tuple(r)[2:], rtol=1e-9), (vin, r)


def test_five_forecasters_on_every_vehicle(fleet):
    rows = leave_one_out.backtest(fleet, trees=24).cache()
    assert rows.select("vin").distinct().count() == 12
    got = {r["forecaster"]: r for r in leave_one_out.scores(rows, samples.populations(fleet)).where("degrader is null").collect()}
    assert set(got) == set(leave_one_out.FORECASTERS)
    assert got["trajectory"]["rmse"] < 0.6 * got["persistence"]["rmse"] and got["rate_raw"]["rmse"] < got["persistence"]["rmse"]
    folds = evaluate.folds_backtest(fleet, 3)
    assert rows.count() == folds.count()


def test_leave_one_out_reads_sums_without_an_object_for_each():
    """A task's memory stays near its batch's own buffers; a vehicle without sums gets the models of all."""
    trees = ensembles.Additive(["horizon", "soh"], np.zeros((48, 6), dtype=np.int64), np.full((48, 6), 5.0))
    n, cells = 48 * trees.leaves, 1000
    all_, rows = ensembles.Sums(np.full(n, 8.0), np.full(n, 4.0)), 60
    flat = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(cells), rows)), pa.array(np.ones(cells * rows)), pa.array(np.ones(cells * rows))], ["cell", "s", "w"])
    own = pa.ListArray.from_arrays(pa.array(np.append(np.arange(rows + 1) * cells, rows * cells).astype(np.int32), mask=np.array([False] * rows + [True, False])), flat)
    assert own.null_count == 1 and len(own) == rows + 1
    column = pa.array(np.full(rows + 1, 50.0))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(rows + 1)), column, column, column, own, own], names=["vin", "soh", "age_months", "recent_loss", "far", "near"])
    near = trees._replace(features=["age_months", "soh"])
    run = leave_one_out._steps(SimpleNamespace(value=(trees, all_, near, all_)), 2, 1.2, (0.05, 0.4))
    tracemalloc.start()
    out = next(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5e6  # 120,000 sums as objects take over 30 MB
    raw = out.column("raw").to_numpy().reshape(rows + 1, 2)
    assert np.allclose(raw[-1], [2.0, 4.0]) and (raw[0] > raw[-1]).all()


def test_forest_quantiles_are_those_of_joined_leaves(spark):
    """As by a join of each row's leaves with their labels, but without one; a row with a null feature has none."""
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1 + i % 12, 1), float(a), float(b), float(round(a * 2 + c, 3))) for i, (a, b, c) in enumerate(rng.normal(size=(700, 3)))], "id long, t timestamp, a double, b double, y double").cache()
    asked = rows.where("id < 90").withColumn("b", F.when(F.col("id") != 7, F.col("b")))
    out = models.quantile_forest(rows, asked, ["a", "b"], "y", trees=4, depth=3, seed=5)
    assert "Join" not in out._jdf.queryExecution().toString() and out.columns == [*asked.columns, "q"]
    got = {r["id"]: r["q"] for r in out.collect()}
    assert len(got) == 90 and got.pop(7) is None
    forest = RandomForestRegressor(labelCol="y", numTrees=4, maxDepth=3, leafCol="leaf", seed=5)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), forest]).fit(rows)
    leaves = lambda df, *keep: model.transform(df).select(*keep, F.posexplode(vector_to_array("leaf")).alias("tree", "leaf"))
    held = leaves(rows, F.round("y", 2).alias("y")).groupBy("tree", "leaf", "y").agg(F.count("*").alias("k"))
    held = held.withColumn("share", F.col("k") / F.sum("k").over(Window.partitionBy("tree", "leaf")))
    found = leaves(asked.dropna(), "id").join(held, ["tree", "leaf"]).groupBy("id", "y").agg(F.sum("share").alias("w"))
    want = found.groupBy("id").agg(F.percentile("y", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)), F.ceil(F.col("w") * 1000).cast("long")).alias("q")).collect()
    assert got == {r["id"]: pytest.approx(r["q"], abs=0.0101) for r in want} and sum(got[r["id"]] == pytest.approx(r["q"]) for r in want) > 85


def test_leaf_labels_are_counted_before_they_are_shuffled(spark):
    rows = spark.createDataFrame([(float(i % 5), round(i % 3 + 0.004, 3)) for i in range(600)], "a double, y double").coalesce(1)
    flat = ensembles.Flat(*(np.array(v) for v in ([0, -1, -1], [2.0, 0, 0], [1, -1, -1], [2, -1, -1], [0.0, 1, 2], [0])), 1)
    for most in (1, 1 << 17):
        counts = {(r["leaf"], r["y"]): r["k"] for r in ensembles.leaf_labels(rows, flat, ["a"], F.col("y"), most).collect()}
        assert counts == {(leaf, y): k for leaf, k in ((1, 120), (2, 80)) for y in (0.0, 1.0, 2.0)}
