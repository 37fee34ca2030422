import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltfleet.functions import stats
from voltfleet.operators import evaluate, joins, models, samples, series, trajectory

from .test_operators import fading


@pytest.fixture(scope="module")
def fleet(spark):
    return fading(spark, 6, 20).withColumn("temp_max", F.when((F.col("vin") != 3) | (F.col("age_months") != 9), F.col("temp_max"))).cache()


@pytest.fixture(scope="module")
def grown(fleet):
    return trajectory.fit(models.trajectory_histories(fleet), models.TRAJECTORY, trees=2, depth=2)


def test_histories_are_a_row_for_each_vehicle_and_hold_all_pairs(fleet, monkeypatch):
    monkeypatch.setattr(trajectory, "PIECE", 7)
    rows = models.trajectory_histories(fleet)
    assert rows.count() == 6 and rows.agg(F.max("horizon")).first()[0] == 16
    batch = rows.select("months").toArrow().combine_chunks().to_batches()[0]
    found = list(trajectory.pieces(batch, models.TRAJECTORY[1:], 4))
    assert len(found) > 20
    got = sorted((round(float(p.x[a, 0]), 6), round(float(h), 6), round(float(y), 6)) for p in found for a, h, y in zip(p.anchor, p.horizon, p.loss, strict=True))
    pairs = models.trajectory_rows(fleet).dropna(subset=models.TRAJECTORY).select("age_months", "horizon", "cum_loss").collect()
    assert got == sorted(tuple(round(v, 6) for v in r) for r in pairs)
    assert not list(trajectory.pieces(pa.RecordBatch.from_arrays([batch.column("months")[:0]], names=["months"]), models.TRAJECTORY[1:], 4))


def test_leaves_are_means_of_losses_and_then_of_sides(fleet, grown):
    rows = models.trajectory_rows(fleet).dropna(subset=models.TRAJECTORY).select(*models.TRAJECTORY, "cum_loss", "weight").toPandas()

    def leaf(tree):
        at = np.zeros(len(rows), dtype=int)
        for level in range(2):
            place = (1 << level) - 1 + at
            f = grown.feature[tree, place]
            edge = [grown.edges[i][grown.edge[tree, p]] if i >= 0 else np.inf for i, p in zip(f, place, strict=True)]
            at = 2 * at + (rows[models.TRAJECTORY].to_numpy()[np.arange(len(rows)), np.maximum(f, 0)] > edge)
        return at

    first = grown.value[0, leaf(0)]
    sides = np.where(rows["cum_loss"] >= first, 1.0, -1.0)
    for tree, target, rate in ((0, rows["cum_loss"].to_numpy(), 1.0), (1, sides, 0.2)):
        assert (grown.feature[tree] >= 0).any()
        for k in np.unique(leaf(tree)):
            own = leaf(tree) == k
            assert grown.value[tree, k] == pytest.approx(rate * np.average(target[own], weights=rows["weight"][own]))


def test_model_is_saved_and_predicts_null_where_a_feature_is(spark, fleet, grown, tmp_path):
    path = models.register(spark, grown, str(tmp_path), "x", {})
    model = models.load_latest(spark, str(tmp_path), "x")
    assert path.endswith("/x/1/trees") and all(np.array_equal(a, b) for a, b in zip(model[2:], grown[2:], strict=True))
    assert models.importance(spark, model, models.TRAJECTORY).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    rows = models.predict(model, models.trajectory_rows(fleet)).select("prediction", *models.TRAJECTORY).withColumn("blank", F.greatest(*[F.col(c).isNull() for c in models.TRAJECTORY]))
    assert rows.where("blank <> (prediction is null)").count() == 0 and rows.select("prediction").distinct().count() > 3


def test_horizon_bins_are_those_of_a_search():
    for edges in (np.array([0.995, 1.005, 2.035, 79.905]), np.empty(0)):
        horizon = np.concatenate([edges, np.nextafter(edges, 0), np.nextafter(edges, 99), np.arange(1, 4000) / 30.4, [1e-9, 1e6]])
        assert np.array_equal(trajectory._horizon_bins(horizon, edges), np.searchsorted(edges, horizon))


def test_a_pass_sums_weights_and_targets_of_all_pairs(fleet, grown):
    rows = models.trajectory_rows(fleet).dropna(subset=models.TRAJECTORY).select(*models.TRAJECTORY, "cum_loss").toPandas()
    x, loss = rows[models.TRAJECTORY].to_numpy(), rows["cum_loss"].to_numpy()
    first = grown._replace(feature=grown.feature[:1], edge=grown.edge[:1], value=grown.value[:1])
    predicted = models.predict(first, models.trajectory_rows(fleet).dropna(subset=models.TRAJECTORY)).select("prediction").toPandas()["prediction"].to_numpy()
    weight = 1 + 0.15 * loss
    for tree, target in ((0, loss), (1, np.where(loss >= predicted, 1.0, -1.0))):
        sums = trajectory._sums(trajectory.packed(models.trajectory_histories(fleet), models.TRAJECTORY[1:], grown.edges[1:]), grown, tree, 0, 4, 0.15)
        for f, edges in enumerate(grown.edges):
            at = np.searchsorted(edges, x[:, f])
            assert sums[0, 0, f, : len(edges) + 1] == pytest.approx(np.bincount(at, weight, len(edges) + 1))
            assert sums[1, 0, f, : len(edges) + 1] == pytest.approx(np.bincount(at, weight * target, len(edges) + 1), abs=1e-9)


def test_models_of_the_same_passes_equal_those_fitted_alone(spark, fleet, monkeypatch):
    """Sets of vehicles that overlap, and one that is empty; sums of few tasks come as they are, those of many by way of others."""
    sets = {"all": F.lit(True), "even": F.col("vin") % 2 == 0, "late": F.col("vin") > 2, "none": F.lit(False)}
    rows = models.trajectory_histories(fleet).withColumn("vin", F.when(F.col("vin") != 1, F.col("vin")))  # a condition may be null
    alone = [trajectory.fit(rows.where(one), models.TRAJECTORY, trees=2, depth=2) for one in sets.values()]
    for few in (64, 0):
        monkeypatch.setattr(trajectory, "FEW", few)
        got = trajectory.fit_each(rows, models.TRAJECTORY, list(sets.values()), trees=2, depth=2)
        for a, b in zip(got, alone, strict=True):
            assert all(np.array_equal(x, y) for x, y in zip(a.edges, b.edges, strict=True))
            assert np.array_equal(a.feature, b.feature) and np.array_equal(a.edge, b.edge)
            assert a.value == pytest.approx(b.value) and a.gain == pytest.approx(b.gain)
    assert (got[0].feature >= 0).any() and not (got[3].feature >= 0).any()


def test_passes_are_dealt_by_pairs_and_cores():
    piece = trajectory.PIECE
    assert [trajectory._tasks(n * piece, 8) for n in (0, 3, 7, 24, 143, 1430)] == [1, 1, 3, 8, 8, 96]


def test_training_sets_are_fitted_by_the_passes_of_one_fit(spark, fleet, monkeypatch):
    passes = []
    monkeypatch.setattr(trajectory, "_sums_each", lambda *a, f=trajectory._sums_each: passes.append(1) or f(*a))
    monkeypatch.setattr(models, "fit_trajectories", lambda rows, sets, f=models.fit_trajectories: f(rows, sets, 2))
    kinds = fleet.select("vin").distinct().withColumn("degrader", F.col("vin") > 1)
    sets = {"all": F.lit(True), "degraders": F.col("degrader")}
    got = {r["training"]: r for r in evaluate.compare_training(fleet.drop("degrader"), kinds, sets, F.col("vin") % 2).collect()}
    assert len(passes) == 8
    monkeypatch.setattr(models, "fit_trajectory", lambda rows, f=models.fit_trajectory: f(rows, 2))
    for name, train in (("all", fleet), ("degraders", fleet.where("vin > 1"))):
        rows = evaluate.holdout(train.where("vin % 2 = 0"), fleet.where("vin % 2 = 1")).unionByName(evaluate.holdout(train.where("vin % 2 = 1"), fleet.where("vin % 2 = 0")))
        want = stats.errors(rows, "model", "actual").first()
        assert all(got[name][c] == pytest.approx(want[c], abs=2e-6) for c in want.asDict())


def test_learning_curve_is_fitted_by_the_passes_of_one_fit(spark, fleet, monkeypatch):
    passes = []
    monkeypatch.setattr(trajectory, "_sums_each", lambda *a, f=trajectory._sums_each: passes.append(1) or f(*a))
    monkeypatch.setattr(models, "fit_trajectories", lambda rows, sets, f=models.fit_trajectories: f(rows, sets, 2))
    got = {r["history"]: (r["mae"], r["n"]) for r in evaluate.learning_curve(fleet, (5, 9), 14, 2).collect()}
    assert len(passes) == 8
    rows, fold = fleet.withColumn("rn", F.row_number().over(series.by_month())), samples.fold_of(F.col("vin"), 2)
    late = rows.where("rn > 14").select("vin", F.col("age_months").alias("age"), F.col("soh").alias("actual"))
    off = {5: [], 9: []}
    for i in range(2):
        model = models.fit_trajectory(models.trajectory_histories(fleet.where(fold != i)), 2)
        for months, all_off in off.items():
            at = models.anchors(rows.where((fold == i) & (F.col("rn") <= months)).drop("rn"))
            steps = models.forecast(model, at, 90).select("vin", "h", "p50")
            asked = late.join(at.select("vin", F.col("age_months").alias("start")), "vin")
            all_off += [r[0] for r in joins.rounded_step_join(steps, asked, "age", "start").select(F.abs(F.col("p50") - F.col("actual"))).collect()]
    assert got == {months: (pytest.approx(np.mean(x)), len(x)) for months, x in off.items()}


def test_steps_ahead_equal_the_expression_and_leave_it_out_of_the_plan(spark, fleet, grown):
    at = models.anchors(fleet).withColumn("recent_temp_max", F.when(F.col("vin") != 2, F.col("recent_temp_max"))).withColumn("vin", F.struct("vin", F.lit(6).alias("history")))
    at = at.select("vin", "soh", "age_months", "recent_loss", "history_drop", *grown.features[4:])
    got = {(*r["vin"], r["h"], r["horizon"]): r["raw"] for r in grown.ahead(at, 30).collect()}
    steps = at.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(30)))).withColumn("horizon", F.col("h").cast("double"))
    assert got == {(*r["vin"], r["h"], r["horizon"]): r["raw"] for r in models.predict(grown, steps, "raw").collect()}
    assert len(got) == 180 and sum(v is None for v in got.values()) == 30 and len(set(got.values())) > 3
    plan = models.forecast(grown, models.anchors(fleet), 6)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and plan.count("CASE WHEN") < 40
