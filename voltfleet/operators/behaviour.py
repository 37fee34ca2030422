"""Fleet behaviour: per-vehicle habits, ranked drivers, segments, scores and levers."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import selection
from . import series as sr


def loss_rate(df: DataFrame, soh: str = "soh", most_gap: float = 3.0, least: int = 2) -> DataFrame:
    """vin, loss_rate: mean monthly loss (at least 0 each) over short gaps, with enough of them."""
    gap = F.col("age_months") - F.lag("age_months").over(sr.by_month())
    rows = df.withColumns({"gap": gap, "loss": F.greatest((F.lag(soh).over(sr.by_month()) - F.col(soh)) / gap, F.lit(0.0))}).where((F.col("gap") > 0) & (F.col("gap") <= most_gap))
    return rows.groupBy("vin").agg(F.avg("loss").alias("loss_rate"), F.count("*").alias("k")).where(F.col("k") >= least).drop("k")


#: Decimals at which values meet bounds and each other, where the rounding of means is not to decide.
DIGITS = 9


def behaviour_table(df: DataFrame, metrics: dict[str, tuple[float, float]], soh: str = "soh", digits: int | None = None) -> DataFrame:
    """vin, lifetime mean of each metric within its plausible range (which it meets rounded to ``digits``, if given), and loss_rate."""
    met = lambda m: F.col(m) if digits is None else F.round(m, digits)
    means = df.groupBy("vin").agg(*[F.avg(F.when(met(m).between(lo, hi), F.col(m))).alias(m) for m, (lo, hi) in metrics.items()])
    return means.join(loss_rate(df, soh), "vin", "left")


def _long(table: DataFrame, metrics: list[str], keep: list[str]) -> DataFrame:
    return table.unpivot(["vin", *keep], metrics, "metric", "value")


def distributions(table: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, n, mean and deciles."""
    rows = _long(table, metrics, []).where("value is not null")
    out = rows.groupBy("metric").agg(F.avg("value").alias("mean")).join(F.broadcast(selection.exact_quantiles(rows, "value", (0.1, 0.5, 0.9), "metric")), "metric")
    return out.select("metric", "n", "mean", F.col("q")[0].alias("p10"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p90"))


def ranked_drivers(table: DataFrame, metrics: list[str], least: int = 10, distinct: int = 3) -> DataFrame:
    """metric, rho, n: rank correlation with the loss rate, of metrics with enough vehicles and values. Values equal to nine decimals tie."""
    rows = _long(table, metrics, ["loss_rate"]).where("value is not null and loss_rate is not null").withColumns({c: F.round(c, DIGITS) for c in ("value", "loss_rate")})
    rank = F.col("below") + (F.col("ties") + 1) / 2  # ties share their mean rank
    ranked = sr.with_ranks(rows, "value", ["metric"]).withColumn("rx", rank).drop("below", "ties", "of")
    ranked = sr.with_ranks(ranked, "loss_rate", ["metric"]).withColumn("ry", rank)
    return ranked.groupBy("metric").agg(F.corr("rx", "ry").alias("rho"), F.count("*").alias("n"), F.count_distinct("value").alias("kinds")).where((F.col("n") >= least) & (F.col("kinds") > distinct)).drop("kinds")


def percentiles(table: DataFrame, metrics: list[str]) -> DataFrame:
    """vin, metric, value, pct (share of vehicles strictly below, at nine decimals), z, verdict."""
    rows = _long(table, metrics, []).where("value is not null")
    moments = rows.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    z = F.coalesce(F.try_divide(F.col("value") - F.col("mean"), F.col("sd")), F.lit(0.0))
    rows = sr.with_ranks(rows.withColumn("met", F.round("value", DIGITS)), "met", ["metric"]).withColumn("pct", F.col("below") / F.col("of") * 100).drop("met", "below", "ties", "of")
    rows = rows.join(F.broadcast(moments), "metric").withColumn("z", z).drop("mean", "sd")  # a row for each metric
    return rows.withColumn("verdict", F.when(F.col("pct") >= 80, "harsh").when(F.col("pct") >= 60, "above average").when(F.col("pct") >= 40, "typical").otherwise("gentle"))


def care_scores(pct: DataFrame) -> DataFrame:
    """vin, score (mean gentleness in %), grade."""
    from ..functions.scalars import care_grade

    out = pct.groupBy("vin").agg(F.avg(100 - F.col("pct")).alias("score"))
    return out.withColumn("grade", care_grade(F.round("score", DIGITS)))


def levers(pct: DataFrame, drivers: DataFrame, k: int = 3, least: float = 60.0) -> DataFrame:
    """The k harshest habits of each vehicle, weighted by how much they go with loss: a top-k report."""
    rows = pct.where(F.col("pct") >= least).join(drivers.select("metric", "rho"), "metric")
    rows = rows.withColumn("severity", (F.col("pct") - 50) / 50 * (0.3 + F.abs(F.coalesce("rho", F.lit(0.0)))))
    place = F.row_number().over(Window.partitionBy("vin").orderBy(F.desc(F.round("severity", DIGITS)), "metric"))
    return rows.withColumn("place", place).where(F.col("place") <= k).select("vin", "place", "metric", "severity")


def segments(table: DataFrame, metrics: list[str], k: int = 3, seed: int = 0) -> DataFrame:
    """vin, segment (0 gentlest): k-means on standardised metrics, clusters ordered by mean standardised level."""
    rows = table.na.drop(subset=metrics)
    rows = VectorAssembler(inputCols=metrics, outputCol="raw").transform(rows)
    rows = StandardScaler(inputCol="raw", outputCol="features", withMean=True).fit(rows).transform(rows)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    order = sorted(range(k), key=lambda i: sum(model.clusterCenters()[i]))
    place = F.element_at(F.array(*[F.lit(order.index(i)) for i in range(k)]), F.col("cluster") + 1)
    return model.transform(rows).withColumn("segment", place).select("vin", "segment", *metrics)


def segment_profiles(segmented: DataFrame, metrics: list[str], standout: float = 0.5) -> DataFrame:
    """segment, n, label and standout traits: metrics whose segment mean is far from the fleet's in fleet deviations."""
    fleet = segmented.agg(*[f(m).alias(f"{n}_{m}") for m in metrics for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    per = segmented.groupBy("segment").agg(F.count("*").alias("n"), *[F.avg(m).alias(m) for m in metrics]).crossJoin(F.broadcast(fleet))
    traits = F.array(*[F.struct(F.lit(m).alias("metric"), F.coalesce(F.try_divide(F.col(m) - F.col(f"m_{m}"), F.col(f"s_{m}")), F.lit(0.0)).alias("z")) for m in metrics])
    named = F.transform(F.filter(traits, lambda t: F.abs(t["z"]) >= standout), lambda t: F.concat(F.when(t["z"] > 0, F.lit("high ")).otherwise(F.lit("low ")), t["metric"]))
    label = F.when(F.col("segment") == 0, "gentle").when(F.col("segment") == 1, "typical").otherwise("harsh")
    return per.select("segment", "n", label.alias("label"), F.array_join(named, "; ").alias("traits"))


def findings(table: DataFrame, metric: str, limit: float) -> DataFrame:
    """One row: loss rate of the harshest decile over the rest, and the share of vehicles above a limit."""
    cut = table.agg(F.percentile(metric, 0.9).alias("cut"))
    rows = table.crossJoin(F.broadcast(cut))
    worst = F.col(metric) >= F.col("cut")
    return rows.agg(F.try_divide(F.avg(F.when(worst, F.col("loss_rate"))), F.avg(F.when(~worst, F.col("loss_rate")))).alias("ratio"), F.avg((F.col(metric) > limit).cast("double")).alias("share_above"))


def verdict_text(ratio: Column) -> Column:
    return F.format_string("the harshest tenth loses %.2f times as fast", ratio)
