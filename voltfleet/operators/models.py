"""Degradation models with MLlib, and forecasts from them as DataFrames.

MLlib vectors take neither null nor NaN, so nullable features are imputed beside a flag (``samples.imputed``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from . import ensembles, joins, samples, trajectory
from . import series as sr

STRESS = ["temp_max", "km_month", "frac_soc_high", "dod_mean"]
TRAJECTORY = ["horizon", "age_months", "soh", "recent_loss", *[f"recent_{c}" for c in STRESS]]


def fit_boosted(rows: DataFrame, features: list[str], label: str, weight: str | None = None, loss: str = "squared", trees: int = 12, depth: int = 4, seed: int = 0) -> PipelineModel:
    """Boosted trees; ``loss`` absolute fits the median."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", maxIter=trees, maxDepth=depth, lossType=loss, seed=seed, stepSize=0.2)
    if weight:
        gbt = gbt.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), gbt]).fit(rows)


def predict(model: PipelineModel | trajectory.Trees, rows: DataFrame, name: str = "prediction") -> DataFrame:
    out = model.transform(rows).drop("features")
    return out if name == "prediction" else out.withColumnRenamed("prediction", name)


def fit_rate(rows: DataFrame, features: list[str]) -> tuple[PipelineModel, float]:
    """Monthly-loss model, weighted towards real losses, and the bias that centres it on the mean loss."""
    model = fit_boosted(rows, features, "loss", "weight")
    bias = predict(model, rows).agg(F.avg(F.col("loss") - F.greatest("prediction", F.lit(0.0))).alias("b")).first()["b"]
    return model, float(bias or 0.0)


def quantile_forest(train: DataFrame, asked: DataFrame, features: list[str], label: str, quantiles: tuple[float, ...] = (0.1, 0.5, 0.9), trees: int = 10, depth: int = 5, seed: int = 0) -> DataFrame:
    """``asked`` rows (with a key column id) with q: quantiles of the training labels that share leaves, each leaf weighing one.

    A leaf's labels are kept as counts by label rounded to a hundredth. Those, at most leaves times labels in hundredths however many
    the rows, are broadcast, and a row's leaves are added up where it is: no row meets its leaves' labels in a join. A row with a
    null among its features has no q (null).
    """
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    model = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), forest]).fit(train)
    flat = ensembles.flatten(model.stages[-1])
    shares = ensembles.Shares.of(ensembles.leaf_labels(train, flat, features, F.col(label)), flat)
    shared = asked.sparkSession.sparkContext.broadcast((flat, shares))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, shares = shared.value
        for batch in batches:
            x = ensembles.matrix(batch, features)
            found = shares.quantiles(flat.leaves(x), quantiles)
            blank = np.isnan(x).any(axis=1) | np.isnan(found).any(axis=1)
            q = pa.array([None if b else row for b, row in zip(blank, found.tolist(), strict=True)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, q], names=[*batch.schema.names, "q"])

    return asked.mapInArrow(predict, StructType([*asked.schema.fields, StructField("q", ArrayType(DoubleType()))]))


def anchors(df: DataFrame, soh: str = "soh") -> DataFrame:
    """Each vehicle's last row as forecast anchor, with recent stress and loss."""
    df = df.withColumn("recent_loss", sr.recent_loss_rate(df, soh)).withColumns({f"recent_{c}": sr.trailing_median(c, 6) for c in STRESS})
    df = df.withColumn("history_drop", F.first(soh).over(sr.so_far()) - F.col(soh))
    return joins.latest(df).withColumn("soh", F.col(soh))


def trajectory_rows(df: DataFrame, soh: str = "soh", most: int | None = None) -> DataFrame:
    rows = samples.trajectory_samples(df, STRESS, soh, most=most)
    return rows if soh == "soh" else rows.withColumn("soh", F.col(soh))


def trajectory_histories(df: DataFrame, soh: str = "soh", least: int = 4) -> DataFrame:
    """vin, horizon (the longest of its pairs; null without any) and months, in order, of each vehicle: :func:`trajectory_rows` not yet
    made into pairs."""
    df = df.withColumn("recent_loss", sr.recent_loss_rate(df, soh)).withColumns({f"recent_{c}": sr.trailing_median(c, 6) for c in STRESS}).withColumn("soh", F.col(soh))
    row = F.struct("month", *[F.col(c).cast("double").alias(c) for c in TRAJECTORY[1:]])
    rows = df.where(F.col("vin").isNotNull()).groupBy("vin").agg(F.array_sort(F.collect_list(row)).alias("months"))
    span = F.element_at("months", -1)["age_months"] - F.try_element_at("months", F.lit(least))["age_months"]
    return rows.select("vin", F.when(F.size("months") > least, span).alias("horizon"), F.transform("months", lambda m: m.dropFields("month")).alias("months"))


def fit_trajectory(rows: DataFrame, trees: int = 12) -> trajectory.Trees:
    """Cumulative loss by horizon, of :func:`trajectory_histories`: median loss, later and larger losses weigh more."""
    return trajectory.fit(rows, TRAJECTORY, trees)


def fit_trajectories(rows: DataFrame, sets: dict, trees: int = 12) -> dict:
    """:func:`fit_trajectory` of the vehicles that meet each of the conditions, by the same passes over all of them."""
    return dict(zip(sets, trajectory.fit_each(rows, TRAJECTORY, list(sets.values()), trees), strict=True))


def forecast(model: PipelineModel | trajectory.Trees, at: DataFrame, months: int = 36, band: tuple[float, float] = (1.5, 1.5), flat_drop: float = 1.0) -> DataFrame:
    """vin, h, age_months, p10, p50, p90: all vehicles and steps in one pass.

    Predicted loss never falls with the horizon; it is blended with the vehicle's own recent slope, the more so the faster it
    falls. Vehicles near 100, or that lost next to nothing, just keep their slope in half as wide a band. The band grows with the
    root of the horizon, its lower edge never rises and its upper one stays at or below the present value.
    """
    if isinstance(model, trajectory.Trees):
        return blended(model.ahead(at.select(*dict.fromkeys(["vin", "soh", "age_months", "recent_loss", "history_drop", *model.features[1:]])), months), band, flat_drop)
    steps = at.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(months)))).withColumn("horizon", F.col("h").cast("double"))
    return blended(predict(model, steps, "raw"), band, flat_drop)


def blended(steps: DataFrame, band: tuple[float, float] = (1.5, 1.5), flat_drop: float = 1.0) -> DataFrame:
    """The forecast of :func:`forecast` from anchors exploded by h and horizon, with the model's loss as raw."""
    steps = sr.accumulate_steps(steps.withColumn("loss", F.greatest("raw", F.lit(0.0))), "loss")
    own = F.col("recent_loss") * F.col("horizon")
    share = F.least(F.greatest(F.col("recent_loss") / 0.4, F.lit(0.0)), F.lit(0.7))
    is_flat = (F.col("soh") >= 99.5) | ((F.col("history_drop") < flat_drop) & (F.col("recent_loss") < 0.05))
    steps = steps.withColumn("center", F.col("soh") - F.when(is_flat, own).otherwise((1 - share) * F.col("loss") + share * own)).withColumn("width", F.sqrt("h") * F.when(is_flat, 0.5).otherwise(1.0))
    bounded = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(100.0))
    steps = steps.withColumn("p10", bounded(F.col("center") - band[0] * F.col("width")))
    steps = sr.accumulate_steps(steps, "p10", largest=False)
    return steps.select("vin", "h", (F.col("age_months") + F.col("h")).alias("age_months"), "p10", bounded(F.col("center")).alias("p50"), bounded(F.least(F.col("center") + band[1] * F.col("width"), F.col("soh"))).alias("p90"))


def roll_forward(model: PipelineModel, bias: float, at: DataFrame, features: list[str], months: int = 24, most: float = 1.2, gate: tuple[float, float] | None = None) -> DataFrame:
    """vin, h, p50: the monthly model applied to its own output, recent stress frozen. A step loses between 0 and ``most``.

    With ``gate`` (low, high observed loss) flat vehicles lose 0.35 of the prediction, fast ones at least 1.25 of what was
    observed, others a blend. The model's trees are broadcast as arrays, and a task takes its vehicles through all steps: the
    plan is the same whatever the horizon. A vehicle with a null among its features has no forecast (null).
    """
    shared = at.sparkSession.sparkContext.broadcast(ensembles.flatten(model.stages[-1]))
    state = at.select("vin", *dict.fromkeys(["soh", "age_months", "recent_loss", *features]))
    kind = dict(at.dtypes)["vin"]
    return state.mapInArrow(ensembles.rolled(shared, bias, features, months, most, gate), f"vin {kind}, h int, p50 double")


def free_run(model: PipelineModel, bias: float, df: DataFrame, features: list[str], start: int = 4) -> DataFrame:
    """vin, month, p50 over the observed months after the first ``start``, with the stress that was actual.

    Predicted monthly losses do not depend on the state here, so the run is a running sum.
    """
    rows = df.withColumn("rn", F.row_number().over(sr.by_month())).withColumn("gap", F.coalesce(F.col("age_months") - F.lag("age_months").over(sr.by_month()), F.lit(0.0)))
    rows = predict(model, rows).withColumn("step", F.when(F.col("rn") > start, F.greatest(F.col("prediction") + bias, F.lit(0.0)) * F.col("gap")).otherwise(0.0))
    base = F.max(F.when(F.col("rn") == start, F.col("soh"))).over(sr.own())
    return rows.withColumn("p50", base - F.sum("step").over(sr.so_far())).where(F.col("rn") > start).select("vin", "month", "age_months", "soh", "p50")


def reanchored(forecasts: DataFrame, now: DataFrame) -> DataFrame:
    """Forecast shifted so that it starts at each vehicle's raw value. ``now``: vin, soh (model's), raw."""
    return forecasts.join(now.select("vin", (F.col("raw") - F.col("soh")).alias("shift")), "vin").withColumns({c: F.col(c) + F.col("shift") for c in ("p10", "p50", "p90")}).drop("shift")


def importance(spark: SparkSession, model: PipelineModel | trajectory.Trees, features: list[str]) -> DataFrame:
    """feature, importance, place: a row for each feature."""
    values = (model.importances() if isinstance(model, trajectory.Trees) else model.stages[-1].featureImportances.toArray()).tolist()
    rows = sorted(zip(features, values, strict=True), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, place int")


def score_fleet(forecasts: DataFrame, at: DataFrame, deadline: DataFrame, eol: Column | float = 80.0) -> tuple[DataFrame, DataFrame]:
    """(vehicle rows, month rows) of a batch of forecasts."""
    from . import decisions as de

    rows = at.select("vin", F.col("age_months").alias("asof_age_months"), F.col("soh").alias("current_soh")).join(de.remaining_months(forecasts, eol), "vin", "left").join(de.at_risk(forecasts, deadline, eol), "vin", "left")
    return rows, forecasts.withColumnRenamed("age_months", "forecast_age_months")


def with_defaults(df: DataFrame) -> DataFrame:
    """Histories of several vehicles made complete: month from the age where missing, stress 0 where missing."""
    df = df.withColumn("month", F.coalesce("month", F.add_months(F.lit("2020-01-01"), F.bround("age_months").cast("int")).cast("timestamp")))
    return df.fillna(0.0, [c for c in STRESS if c in df.columns])


def register(spark: SparkSession, model: PipelineModel | trajectory.Trees, root: str, source: str, metrics: dict[str, float]) -> str:
    """Save a model under the next version of a source, and append a row to the runs table; the version's path."""
    runs = f"{root}/runs"
    try:
        version = spark.read.parquet(runs).where(F.col("source") == source).agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"] + 1
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        version = 1
    path = f"{root}/{source}/{version}"
    if isinstance(model, trajectory.Trees):
        path += "/trees"
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)
    spark.createDataFrame([(source, version, path, metrics)], "source string, version int, path string, metrics map<string,double>").write.mode("append").parquet(runs)
    return path


def load_latest(spark: SparkSession, root: str, source: str) -> PipelineModel | trajectory.Trees:
    row = spark.read.parquet(f"{root}/runs").where(F.col("source") == source).orderBy(F.desc("version")).first()
    return trajectory.Trees.load(spark, row["path"]) if row["path"].endswith("/trees") else PipelineModel.load(row["path"])
