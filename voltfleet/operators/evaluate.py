"""Backtests, summaries, acceptance gates and comparisons of forecasts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..sources.shared import cut_once
from . import decisions, joins, models, samples
from . import series as sr


def holdout(train: DataFrame, test: DataFrame, tail: float = 0.4, months: int = 48, soh: str = "soh") -> DataFrame:
    """vin, h, actual, model, persistence, trend for the held-out months of test vehicles; features see history only."""
    model = models.fit_trajectory(models.trajectory_histories(train, soh))
    marked = samples.history(test, tail)
    past, future = marked.where("past"), marked.where(~F.col("past"))
    at = models.anchors(past, soh)
    steps = models.forecast(model, at, months).select("vin", "h", F.col("p50").alias("model"), "p10", "p90")
    flat = decisions.persistence(past, soh, months).select("vin", "h", F.col("p50").alias("persistence"))
    trend = decisions.sqrt_forecast(past, soh, months).select("vin", "h", F.col("p50").alias("trend"))
    actual = future.select("vin", "month", F.col("age_months").alias("age"), F.col(soh).alias("actual")).join(at.select("vin", F.col("age_months").alias("start")), "vin")
    rows = joins.rounded_step_join(steps, actual, "age", "start")
    return rows.join(flat, ["vin", "h"]).join(trend, ["vin", "h"])


def folds_backtest(df: DataFrame, k: int = 3, **options) -> DataFrame:  # noqa: ANN003
    """Holdout rows of all vehicles, each predicted by a model that saw none of its fold. One fit per fold; with as many folds as
    vehicles it leaves one out."""
    fold = samples.fold_of(F.col("vin"), k)
    out = None
    for i in range(k):
        part = holdout(df.where(fold != i), df.where(fold == i), **options).withColumn("fold", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


def summary(rows: DataFrame, kinds: DataFrame, names: tuple[str, ...] = ("model", "persistence", "trend")) -> DataFrame:
    """name, degrader (null: all), rmse, mae, bias, n: grouping sets over forecaster and cohort."""
    long = rows.join(kinds.select("vin", "degrader"), "vin").unpivot(["vin", "actual", "degrader"], list(names), "name", "predicted")
    off = F.col("predicted") - F.col("actual")
    long = long.withColumn("off", off)
    return long.groupingSets([["name"], ["name", "degrader"]], "name", "degrader").agg(F.sqrt(F.avg(F.col("off") * F.col("off"))).alias("rmse"), F.avg(F.abs("off")).alias("mae"), F.avg("off").alias("bias"), F.count("*").alias("n"))


def coverage(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """degrader, share of actual values inside the band, n."""
    inside = F.col("actual").between(F.col("p10"), F.col("p90"))
    return rows.join(kinds.select("vin", "degrader"), "vin").groupBy("degrader").agg(F.avg(inside.cast("double")).alias("coverage"), F.count("*").alias("n"))


def split_diagnostics(rows: DataFrame, parts: DataFrame, features: list[str], label: str = "loss") -> DataFrame:
    """part, rmse, n of a rate model trained on the part train."""
    joined = rows.join(parts.select("vin", "part"), "vin")
    model, bias = models.fit_rate(joined.where("part = 'train'"), features)
    return stats.errors(models.predict(model, joined).withColumn("prediction", F.col("prediction") + bias), "prediction", label, ("part",))


def gate(candidate: DataFrame, production: DataFrame, truth: DataFrame, kinds: DataFrame, rmse_slack: float = 0.25, bias_slack: float = 0.5) -> DataFrame:
    """One row: errors of two forecasts (vin, age_months, p50) against independent truth (vin, age_months, soh) on decliners,
    interpolated at the truth's ages, and PASS or FAIL."""

    def at_truth(forecasts: DataFrame, name: str) -> DataFrame:
        ages = forecasts.groupBy("vin").agg(F.min("age_months").alias("a"), F.max("age_months").alias("b"))
        asked = truth.join(ages, "vin").where(F.col("age_months").between(F.col("a"), F.col("b"))).select("vin", "age_months", "soh")
        return joins.interpolate(forecasts.select("vin", "age_months", "p50"), asked, "age_months", "p50").join(kinds.where("degrader").select("vin"), "vin", "left_semi").agg(
            F.sqrt(F.avg(F.pow(F.col("p50") - F.col("soh"), F.lit(2.0)))).alias(f"rmse_{name}"), F.avg(F.col("p50") - F.col("soh")).alias(f"bias_{name}"), F.count("*").alias(f"n_{name}")
        )

    both = at_truth(candidate, "new").crossJoin(at_truth(production, "old"))
    good = (F.col("rmse_new") <= F.col("rmse_old") + rmse_slack) & (F.col("bias_new") <= F.col("bias_old") + bias_slack)
    return both.withColumn("verdict", F.when(good, "PASS").otherwise("FAIL"))


def compare_training(df: DataFrame, kinds: DataFrame, sets: dict[str, Column], part: Column, k: int = 2, tail: float = 0.4, months: int = 48, soh: str = "soh") -> DataFrame:
    """training, rmse, mae, bias, n for each way to train (a condition on ``kinds``, which has a row for each vin): the held-out months
    of each of the ``k`` parts of the vehicles are judged by what the other parts trained.

    All models are fitted by the same passes, and anchors and truth, which they share, are made once.
    """
    own = {(name, i): one & (part != i) for name, one in sets.items() for i in range(k)}
    fits = models.fit_trajectories(models.trajectory_histories(df, soh).join(kinds, "vin"), own)
    marked = samples.history(df, tail)
    good = F.col(soh).isNotNull() & ~F.isnan(F.col(soh).cast("double")) & F.col("age_months").isNotNull()
    known = marked.where("past").withColumn("known", F.count_if(good).over(sr.own())).where("known > 0")  # as holdout's trend asks for
    at = cut_once(models.anchors(known, soh))
    future = marked.where(~F.col("past")).select("vin", F.col("age_months").alias("age"), F.col(soh).alias("actual"))
    actual = cut_once(future.join(at.select("vin", F.col("age_months").alias("start")), "vin"))
    out = None
    for name in sets:
        rows = None
        for i in range(k):
            steps = models.forecast(fits[name, i], at.where(part == i), months).select("vin", "h", F.col("p50").alias("model"))
            judged = joins.rounded_step_join(steps, actual, "age", "start")
            rows = judged if rows is None else rows.unionByName(judged)
        errors = stats.errors(rows, "model", "actual").withColumn("training", F.lit(name))
        out = errors if out is None else out.unionByName(errors)
    return out


def envelope_comparison(df: DataFrame, truth: str, envelopes: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """envelope, mae, flat_share: how far each envelope is from a truth without one, and how often it stands still."""
    out = None
    for name, build in envelopes.items():
        rows = build(df).withColumn("still", (F.abs(F.col("soh") - F.lag("soh").over(sr.by_month())) < 0.05).cast("double"))
        part = rows.agg(F.avg(F.abs(F.col("soh") - F.col(truth))).alias("mae"), F.avg("still").alias("flat_share")).withColumn("envelope", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def transfer_matrix(sources: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """trained_on, tested_on, mae and the yardstick of no change, from free runs of rate models."""
    out = None
    for name, train in sources.items():
        model, bias = models.fit_rate(samples.transitions(train), features)
        for other, test in sources.items():
            run = models.free_run(model, bias, test, features).withColumn("start", F.max("soh").over(sr.own()))
            part = run.agg(F.avg(F.abs(F.col("p50") - F.col("soh"))).alias("mae"), F.avg(F.abs(F.col("start") - F.col("soh"))).alias("mae_persistence"), F.count("*").alias("n")).withColumns({"trained_on": F.lit(name), "tested_on": F.lit(other)})
            out = part if out is None else out.unionByName(part)
    return out


def learning_curve(df: DataFrame, history_months: tuple[int, ...], evaluate_from: int, k: int = 3, soh: str = "soh") -> DataFrame:
    """history, mae, n: the same late months predicted from shorter and longer histories, each vehicle by a model that saw none of its fold.

    All folds' models are fitted by the same passes; anchors and the late months, which their forecasts share, are made once.
    """
    rows = df.withColumn("rn", F.row_number().over(sr.by_month()))
    fold = samples.fold_of(F.col("vin"), k)
    fits = models.fit_trajectories(models.trajectory_histories(df, soh), {i: fold != i for i in range(k)})
    actual = cut_once(rows.where(F.col("rn") > evaluate_from).select("vin", F.col("age_months").alias("age"), F.col(soh).alias("actual")))
    at = [models.anchors(rows.where(F.col("rn") <= months).drop("rn"), soh).withColumn("history", F.lit(months)) for months in history_months]
    at = cut_once(functools.reduce(DataFrame.unionByName, at).withColumn("vin", F.struct("vin", "history")))  # so that a history is a vehicle of its own
    asked = actual.join(at.select(F.col("vin").alias("of"), F.col("vin.vin").alias("vin"), F.col("age_months").alias("start")), "vin").withColumn("vin", F.col("of"))
    out = None
    for i in range(k):
        steps = models.forecast(fits[i], at.where(samples.fold_of(F.col("vin.vin"), k) == i), 90).select("vin", "h", "p50")
        part = joins.rounded_step_join(steps, asked, "age", "start").select("vin.history", F.abs(F.col("p50") - F.col("actual")).alias("off"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("history").agg(F.avg("off").alias("mae"), F.count("*").alias("n"))


def ablation(rows: DataFrame, parts: DataFrame, sets: dict[str, list[str]], seeds: tuple[int, ...] = (0, 1)) -> DataFrame:
    """features, seed, rmse on the test part for each feature set and seed."""
    joined = rows.join(parts.select("vin", "part"), "vin")
    out = None
    for name, features in sets.items():
        for seed in seeds:
            model = models.fit_boosted(joined.where("part = 'train'"), features, "loss", "weight", seed=seed, trees=8)
            part = stats.errors(models.predict(model, joined.where("part = 'test'")), "prediction", "loss").withColumns({"features": F.lit(name), "seed": F.lit(seed)})
            out = part if out is None else out.unionByName(part)
    return out
