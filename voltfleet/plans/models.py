"""Queries of MLlib models and their evaluation. Most rows have no SQL form; tests hold them to yardsticks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions as de
from ..operators import evaluate as evl
from ..operators import joins as j
from ..operators import leave_one_out as loo
from ..operators import models as md
from ..operators import pinball as pb
from ..operators import samples as sm
from ..operators import series as sr
from ..sources import fixtures as fx
from ..sources.shared import cut, cut_once, shared_folder
from .base import SERIES, Book
from .quality import kinds, labelled
from .series import HAMPEL, NUM, pava
from .soh import WALK

book = Book()
add = book.add

LIMITED = "lim AS (SELECT h.*, CASE WHEN months = 1 THEN least(soh_raw, 100.0) ELSE least(fit, 100.0) END AS y FROM ham h JOIN iso USING (vin, rn))"
RATE = ["age_months", "soh", *md.STRESS]


def table(s: SparkSession, d: str) -> DataFrame:
    return labelled(s, d).drop("cap_raw")


def stored(s: SparkSession, d: str) -> DataFrame:
    """The table for queries that fit on it, forecast from it and judge by it."""
    return cut_once(table(s, d))


def cohorts(rows: DataFrame) -> DataFrame:
    return sm.populations(rows, drop=33.0)


def transitions(s: SparkSession, d: str) -> DataFrame:
    return sm.transitions(table(s, d), glitch=6.0)


def past(rows: DataFrame) -> DataFrame:
    """What a backtest knows of each vehicle: its first 40 months, the later ones being the truth."""
    return rows.where("age_months < 40")


def trajectory(rows: DataFrame):  # noqa: ANN201
    return md.fit_trajectory(md.trajectory_histories(rows))


def forecasts(rows: DataFrame) -> DataFrame:
    return md.forecast(trajectory(rows), md.anchors(rows), 24)


add("n01_n03_rate_model", lambda s, d: (lambda t: (lambda m: md.predict(m[0], t).select("vin", "month", "loss", (F.col("prediction") + m[1]).alias("predicted")))(md.fit_rate(t, RATE)))(transitions(s, d)))
add("n02_quantile_forest", lambda s, d: (lambda t: md.quantile_forest(t, j.latest(t).withColumn("id", F.col("vin")), RATE, "loss").select("vin", F.col("q")[0].alias("q10"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q90")))(cut(transitions(s, d).select("vin", "month", *RATE, "loss"))))
add("n02_pinball_boosting", lambda s, d: (lambda t: pb.predict(pb.fit(t, RATE, "loss"), j.latest(t), "vin").select("vin", F.col("q")[0].alias("q10"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q90")))(cut(transitions(s, d).select("vin", "month", *RATE, "loss"))))


def quantile_losses(s: SparkSession, d: str) -> DataFrame:
    """N2: pinball losses of boosted quantiles, and of the training set's own, for vehicles (one of three folds) not fitted on."""
    rows, levels = cut(transitions(s, d).select("vin", F.concat_ws(" ", "vin", "month").alias("id"), *RATE, "loss")), (0.1, 0.5, 0.9)
    held = sm.fold_of(F.col("vin"), 3) == 0
    model, asked = pb.fit(rows.where(~held), RATE, "loss", levels), rows.where(held)
    found = {"boosted": pb.predict(model, asked, "id").join(asked.select("id", "loss"), "id"), "constant": asked.withColumn("q", F.lit(model.start.tolist()))}
    parts = [pb.loss(r, "loss", levels).select(F.lit(name).alias("model"), F.posexplode(F.arrays_zip("loss", "under")).alias("level", "at"), "n") for name, r in found.items()]
    return parts[0].unionByName(parts[1]).select("model", "level", "at.loss", "at.under", "n")


add("n02_quantile_losses", quantile_losses)
add("n04_n05_trajectory_forecast", lambda s, d: forecasts(stored(s, d)))
add("n06_roll_forward", lambda s, d: (lambda m: md.roll_forward(m[0], m[1], md.anchors(table(s, d)), RATE, 24))(md.fit_rate(transitions(s, d), RATE)))
add("n07_gated_roll_forward", lambda s, d: (lambda m: md.roll_forward(m[0], m[1], md.anchors(table(s, d)), RATE, 24, gate=(0.05, 0.4)))(md.fit_rate(transitions(s, d), RATE)))
add("n08_free_run", lambda s, d: (lambda m: md.free_run(m[0], m[1], table(s, d), ["age_months", *md.STRESS]))(md.fit_rate(transitions(s, d), ["age_months", *md.STRESS])))
add("n13_reanchored", lambda s, d: (lambda t: md.reanchored(forecasts(t), j.latest(t).select("vin", "soh", F.col("soh_raw").alias("raw"))))(stored(s, d)))
add("n16_importance", lambda s, d: md.importance(s, trajectory(table(s, d)), md.TRAJECTORY))
add("n17_fleet_scores", lambda s, d: (lambda t: md.score_fleet(forecasts(t), md.anchors(t), t.select("vin").distinct().withColumn("deadline", F.lit(96.0)), 60.0)[0])(stored(s, d)))
add("n18_scored_histories", lambda s, d: (lambda t: md.forecast(trajectory(t), md.anchors(md.with_defaults(t)), 6))(stored(s, d)))


def registered(s: SparkSession, d: str) -> DataFrame:
    """N19: save, register, load the latest and score with it."""
    root = f"{shared_folder(s)}/models-{uuid.uuid4().hex}"
    t = stored(s, d)
    md.register(s, trajectory(t), root, "fleet", {"rmse": 0.0})
    return md.forecast(md.load_latest(s, root, "fleet"), md.anchors(t), 6)


add("n19_registered_model", registered)


def both_halves(rows: DataFrame) -> DataFrame:
    """Held-out errors of all vehicles: each half is judged by models of the other."""
    even, odd = rows.where("vin % 2 = 0"), rows.where("vin % 2 = 1")
    return evl.holdout(even, odd).unionByName(evl.holdout(odd, even))


def estimated(s: SparkSession, d: str) -> DataFrame:
    """N20: each of three folds of vehicles estimated by a model of the other two."""
    rows, columns = sm.imputed(table(s, d).withColumn("temp_max", F.when(F.col("n") > 4, F.col("temp_max"))), ["age_months", *md.STRESS])
    rows = cut(rows.select("vin", "month", "soh", *columns))  # read by three fits and their predictions
    fold = lambda k: sm.fold_of(F.col("vin"), 3) == k
    parts = [md.predict(md.fit_boosted(rows.where(~fold(k)), columns, "soh"), rows.where(fold(k))).select("vin", "month", "soh", "prediction") for k in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add("n20_estimated_soh", estimated)
add("o01_o02_folds_backtest", lambda s, d: evl.folds_backtest(stored(s, d), 2).select("vin", "h", "actual", "model", "persistence", "trend", "fold"))
add("o02_leave_one_out", lambda s, d: loo.backtest(table(s, d)))
add("o05_summary", lambda s, d: (lambda t: evl.summary(both_halves(t), cohorts(t)).withColumn("degrader", F.col("degrader").cast("int")))(stored(s, d)))
add("o03_coverage", lambda s, d: (lambda t: evl.coverage(both_halves(t), cohorts(t)).withColumn("degrader", F.col("degrader").cast("int")))(stored(s, d)))
add("o04_split_diagnostics", lambda s, d: evl.split_diagnostics(transitions(s, d), sm.split(kinds(s, d)), RATE))
add("o07_acceptance_gate", lambda s, d: (lambda t: evl.gate(forecasts(past(t)), de.sqrt_forecast(past(t), months=24), t.where("age_months >= 40").select("vin", "age_months", F.col("soh_raw").alias("soh")), cohorts(t)))(stored(s, d)))


def training_sets(s: SparkSession, d: str) -> DataFrame:
    """All vehicles or degraders only as training set; each half of the fleet is judged by what the other half trained."""
    t = stored(s, d)
    return evl.compare_training(t, cohorts(t), {"all": F.lit(True), "degraders": F.col("degrader")}, F.pmod("vin", F.lit(2)))


add("o08_o09_training_sets", training_sets)
add(
    "o10_envelopes",
    lambda s, d: evl.envelope_comparison(fx.series(s, d), "soh_raw", {"greedy": sr.greedy_envelope, "isotonic": sr.robust_isotonic}),
    SERIES, NUM, HAMPEL, pava("ham", "clipped", "iso"), LIMITED, WALK.format(t="num", y="soh_raw").replace("walk", "wlg"), WALK.format(t="lim", y="y").replace("walk", "wli"),
    "env AS (SELECT *, abs(soh - lag(soh) OVER (PARTITION BY envelope, vin ORDER BY rn)) < 0.05 AS still FROM (SELECT 'greedy' AS envelope, vin, rn, soh FROM wlg UNION ALL SELECT 'isotonic', vin, rn, soh FROM wli))",
    select="SELECT envelope, avg(abs(soh - soh_raw)) AS mae, avg(CAST(still AS DOUBLE)) AS flat_share FROM env JOIN num USING (vin, rn) GROUP BY envelope",
    columns="envelope:s mae:d flat_share:d",
)
add("o11_transfer_matrix", lambda s, d: (lambda t: evl.transfer_matrix({"even": t.where("vin % 2 = 0"), "odd": t.where("vin % 2 = 1")}, ["age_months", *md.STRESS]))(cut(table(s, d).select("vin", "month", "soh", "age_months", *md.STRESS))))
add("o12_o13_learning_curve", lambda s, d: evl.learning_curve(stored(s, d), (6, 12, 24), 40, 2))
add("o15_ablation", lambda s, d: evl.ablation(cut(transitions(s, d).select("vin", *RATE, "loss", "weight")), sm.split(kinds(s, d)), {"age": ["age_months", "soh"], "all": RATE}, (0,)))
