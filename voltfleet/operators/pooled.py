"""Partially pooled fade: each vehicle's health is 100 + slope * age plus noise, slopes vary around what behaviour predicts.

Fitted by expectation-maximisation on per-vehicle sufficient statistics, so an iteration reads one short row per vehicle and
gathers one small matrix, whatever the number of observations.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Pooled(NamedTuple):
    """beta: effects on the slope (first the intercept); cov: their covariance; slope_var: variance of slopes; noise_var: of health."""

    names: list[str]
    beta: np.ndarray
    cov: np.ndarray
    slope_var: float
    noise_var: float


def robust_km_month(df: DataFrame, odo: str = "odo_max", bounds: tuple[float, float] = (10.0, 8000.0)) -> DataFrame:
    """vin, km_month between the ends of the odometer, else from its extremes; null out of range."""
    per = df.where(F.col(odo) > 0).groupBy("vin").agg(F.min_by(odo, "age_months").alias("a"), F.max_by(odo, "age_months").alias("b"), F.min(odo).alias("lo"), F.max(odo).alias("hi"), (F.max("age_months") - F.min("age_months")).alias("span"))
    ends, wide = F.try_divide(F.col("b") - F.col("a"), F.col("span")), F.try_divide(F.col("hi") - F.col("lo"), F.col("span"))
    good = lambda c: F.when(c.between(*bounds), c)
    return per.select("vin", F.coalesce(good(ends), good(wide)).alias("km_month"))


def sufficient_statistics(observations: DataFrame) -> DataFrame:
    """vin, n, saa (sum of squared age), say (sum of age times health less 100), syy."""
    y = F.col("soh") - 100
    return observations.groupBy("vin").agg(F.count("*").cast("double").alias("n"), F.sum(F.col("age_months") * F.col("age_months")).alias("saa"), F.sum(F.col("age_months") * y).alias("say"), F.sum(y * y).alias("syy"))


def _predicted(names: list[str], beta: np.ndarray) -> Column:
    return reduce(lambda a, b: a + b, [float(w) * F.col(n) for n, w in zip(names, beta, strict=True)])


def fit(stats: DataFrame, names: list[str], rounds: int = 30) -> Pooled:
    """Estimate from rows with n, saa, say, syy and the design columns ``names`` (a constant among them)."""
    stats = stats.select("n", "saa", "say", "syy", *names).persist()
    k = len(names)
    beta, slope_var, noise_var = np.zeros(k), 0.1, 4.0
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = np.eye(k)
    for _ in range(rounds):
        mu = _predicted(names, beta)
        v = 1 / (F.col("saa") / noise_var + 1 / slope_var)
        b = v * (F.col("say") / noise_var + mu / slope_var)
        rows = stats.withColumn("v", v).withColumn("b", b)
        error = F.col("syy") - 2 * F.col("b") * F.col("say") + (F.col("b") * F.col("b") + F.col("v")) * F.col("saa")
        sums = rows.agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"x{i}_{j}") for i, j in pairs], *[F.sum(F.col(names[i]) * F.col("b")).alias(f"y{i}") for i in range(k)], F.sum(error).alias("error"), F.sum("n").alias("n"), F.count("*").alias("vehicles"), F.sum(F.col("b") * F.col("b") + F.col("v")).alias("bb")).first()
        xx = np.zeros((k, k))
        for i, j in pairs:
            xx[i, j] = xx[j, i] = sums[f"x{i}_{j}"]
        xy = np.array([sums[f"y{i}"] for i in range(k)])
        beta = np.linalg.solve(xx + 1e-9 * np.eye(k), xy)
        slope_var = max((sums["bb"] - 2 * beta @ xy + beta @ xx @ beta) / sums["vehicles"], 1e-6)
        noise_var = max(sums["error"] / sums["n"], 1e-6)
        cov = np.linalg.inv(xx + 1e-9 * np.eye(k)) * slope_var
    stats.unpersist()
    return Pooled(names, beta, cov, float(slope_var), float(noise_var))


def slopes(stats: DataFrame, model: Pooled) -> DataFrame:
    """Each vehicle's slope given its data and the model, and the slope that behaviour alone predicts."""
    mu = _predicted(model.names, model.beta)
    v = 1 / (F.col("saa") / model.noise_var + 1 / model.slope_var)
    return stats.withColumn("predicted", mu).withColumn("slope", v * (F.col("say") / model.noise_var + F.col("predicted") / model.slope_var))


def predictive_curve(vehicles: DataFrame, model: Pooled, ages: list[float]) -> DataFrame:
    """vin, age, p10, p50, p90 of health in closed form, parameter and vehicle variance apart."""
    mu = _predicted(model.names, model.beta)
    spread = reduce(lambda a, b: a + b, [float(model.cov[i, j]) * F.col(a) * F.col(b) for i, a in enumerate(model.names) for j, b in enumerate(model.names)])
    rows = vehicles.select("vin", mu.alias("mu"), spread.alias("parameter_var"), F.explode(F.array(*map(F.lit, ages))).alias("age"))
    sd = F.col("age") * F.sqrt(F.col("parameter_var") + model.slope_var)
    rows = rows.withColumns({"p50": 100 + F.col("mu") * F.col("age"), "sd": sd, "parameter_sd": F.col("age") * F.sqrt("parameter_var"), "vehicle_sd": F.col("age") * float(model.slope_var) ** 0.5})
    return rows.withColumns({"p10": F.col("p50") - 1.2815515655446004 * F.col("sd"), "p90": F.col("p50") + 1.2815515655446004 * F.col("sd")}).drop("mu", "parameter_var", "sd")


def effects(spark, model: Pooled) -> DataFrame:  # noqa: ANN001
    """name, effect and 95 % interval on the monthly slope: a row for each design column."""
    sd = np.sqrt(np.diag(model.cov))
    rows = [(n, float(b), float(b - 1.96 * s), float(b + 1.96 * s)) for n, b, s in zip(model.names, model.beta, sd, strict=True)]
    return spark.createDataFrame(rows, "name string, effect double, low double, high double")


def truncate_at_age(curve: DataFrame, ages: DataFrame, anchor: DataFrame) -> DataFrame:
    """Curve rows up to each vehicle's current age, with their month."""
    rows = curve.join(ages, "vin").where(F.col("age") <= F.col("age_months")).join(anchor, "vin")
    return rows.withColumn("month", F.add_months("anchor", F.bround("age").cast("int"))).drop("age_months", "anchor")
