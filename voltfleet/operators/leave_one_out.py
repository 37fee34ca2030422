"""Backtest that leaves one vehicle out: each vehicle's held-out months are forecast by models of all others.

The models are additive ensembles (see ``ensembles``), so that a vehicle's models are those of all less its own sums: two passes
over the training rows, whatever the number of vehicles. Cuts are drawn from quantiles of all vehicles' features; labels of
the vehicle that is left out enter nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..sources.shared import cut
from . import decisions, ensembles, joins, models, samples

RATE = ["age_months", "soh", *models.STRESS]
FORECASTERS = ("trajectory", "rate_gated", "rate_raw", "persistence", "trend")


def training_rows(df: DataFrame, soh: str = "soh") -> tuple[DataFrame, DataFrame]:
    """(trajectory rows, monthly rows), each with label and mass: loss per month over a horizon, and from one month to the next."""
    far = models.trajectory_rows(df, soh).withColumns({"label": F.col("cum_loss") / F.col("horizon"), "mass": F.col("weight") * F.col("horizon")})
    near = samples.transitions(df, soh)
    return far, near.withColumns({"label": F.col("loss"), "mass": F.col("weight")} | ({} if soh == "soh" else {"soh": F.col(soh)}))


def _steps(shared, months: int, most: float, gate: tuple[float, float]):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far_trees, far_all, near_trees, near_all = shared.value
        horizon = np.arange(1, months + 1, dtype=float)
        for batch in batches:
            far_x, near_x = ensembles.matrix(batch, [f for f in far_trees.features if f != "horizon"]), ensembles.matrix(batch, near_trees.features)
            start = ensembles.matrix(batch, ["soh", "age_months", "recent_loss"])
            out = {name: np.empty((batch.num_rows, months)) for name in ("raw", "rate_gated", "rate_raw")}
            held = [ensembles.Lists(batch.column(c)) for c in ("far", "near")]
            for i in range(batch.num_rows):
                far, near = (all_.without(*own[i]) for all_, own in ((far_all, held[0]), (near_all, held[1])))
                x = np.repeat(far_x[i : i + 1], months, axis=0)
                at = far_trees.features.index("horizon")
                out["raw"][i] = horizon * far.predict(far_trees, np.concatenate([x[:, :at], horizon[:, None], x[:, at:]], axis=1))
                soh, observed = np.full(2, start[i, 0]), start[i, 2]
                y = np.repeat(near_x[i : i + 1], 2, axis=0)
                for h in range(months):
                    predicted = near.predict(near_trees, y)
                    soh = soh - np.array([ensembles.next_loss(predicted[0], observed, most, gate), ensembles.next_loss(predicted[1], observed, most, None)])
                    y[:, near_trees.features.index("soh")], y[:, near_trees.features.index("age_months")] = soh, start[i, 1] + h + 1
                    out["rate_gated"][i, h], out["rate_raw"][i, h] = soh
            yield ensembles.stacked(batch, out, months)

    return run


def forecasts_without_own(at: DataFrame, far: DataFrame, near: DataFrame, trees: tuple[ensembles.Additive, ensembles.Additive], months: int, gate: tuple[float, float] = (0.05, 0.4), most: float = 1.2) -> DataFrame:
    """vin, h, raw (loss over the horizon), rate_gated, rate_raw (health after h months) for each anchor, by the sums of all others.

    ``far``, ``near``: leaf sums of the two ensembles. An anchor that has none of its own gets the models of all.
    """
    spark = at.sparkSession
    shared = spark.sparkContext.broadcast((trees[0], ensembles.totals(far, trees[0]), trees[1], ensembles.totals(near, trees[1])))
    names = [c for c in dict.fromkeys(["vin", "soh", "age_months", "recent_loss", *trees[0].features, *trees[1].features]) if c != "horizon"]
    rows = at.select(names).join(ensembles.own_sums(far, "far"), "vin", "left").join(ensembles.own_sums(near, "near"), "vin", "left")
    return rows.mapInArrow(_steps(shared, months, most, gate), "vin long, h int, raw double, rate_gated double, rate_raw double")


def backtest(df: DataFrame, tail: float = 0.4, months: int = 48, soh: str = "soh", trees: int = 48) -> DataFrame:
    """vin, h, actual, a column for each of ``FORECASTERS``, p10 and p90, for the held-out tail of every vehicle long enough."""
    far_rows, near_rows = training_rows(df, soh)
    grown = ensembles.additive(far_rows, models.TRAJECTORY, trees, always=("recent_loss", "soh")), ensembles.additive(near_rows, RATE, trees, always=("soh",))
    far, near = (cut(ensembles.leaf_sums(rows, t, "label", "mass")) for rows, t in zip((far_rows, near_rows), grown, strict=True))
    marked = samples.history(df, tail)
    past = marked.where("past")
    at = cut(models.anchors(past, soh))
    steps = cut(forecasts_without_own(at, far, near, grown, months))
    blended = models.blended(at.join(steps.select("vin", "h", "raw"), "vin").withColumn("horizon", F.col("h").cast("double")))
    flat = decisions.persistence(past, soh, months).select("vin", "h", F.col("p50").alias("persistence"))
    trend = decisions.sqrt_forecast(past, soh, months).select("vin", "h", F.col("p50").alias("trend"))
    all_steps = blended.select("vin", "h", F.col("p50").alias("trajectory"), "p10", "p90").join(steps.drop("raw"), ["vin", "h"]).join(flat, ["vin", "h"]).join(trend, ["vin", "h"])
    actual = marked.where(~F.col("past")).select("vin", "month", F.col("age_months").alias("age"), F.col(soh).alias("actual")).join(at.select("vin", F.col("age_months").alias("start")), "vin")
    return joins.rounded_step_join(all_steps, actual, "age", "start").select("vin", "h", "actual", *FORECASTERS, "p10", "p90")


def scores(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """forecaster, degrader (null: all), rmse, mae, bias, n of :func:`backtest`'s rows; ``kinds``: vin, degrader."""
    long = rows.join(kinds.select("vin", "degrader"), "vin").unpivot(["vin", "actual", "degrader"], list(FORECASTERS), "forecaster", "predicted")
    return stats.errors(long, "predicted", "actual", ("forecaster",)).withColumn("degrader", F.lit(None).cast("boolean")).unionByName(stats.errors(long, "predicted", "actual", ("forecaster", "degrader")))
