"""Training rows: transitions, trajectory samples, splits and design matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins
from . import series as sr


def transitions(df: DataFrame, soh: str = "soh", most_gap: float = 3.0, glitch: float | None = None) -> DataFrame:
    """A row for each month and the next: loss per month (at least 0), gap and weight; with ``glitch`` steps beyond it lose at most 4."""
    nxt = df.withColumns({"next_soh": F.lead(soh).over(sr.by_month()), "gap": (F.lead("age_months").over(sr.by_month()) - F.col("age_months"))})
    rows = nxt.where((F.col("gap") > 0) & (F.col("gap") <= most_gap))
    loss = F.greatest((F.col(soh) - F.col("next_soh")) / F.col("gap"), F.lit(0.0))
    if glitch is not None:
        loss = F.when(F.abs(F.col(soh) - F.col("next_soh")) > glitch, F.least(loss, F.lit(4.0))).otherwise(loss)
    return rows.withColumn("loss", loss).withColumn("weight", 1 + F.least("loss", F.lit(5.0)))


def trajectory_samples(df: DataFrame, features: list[str], soh: str = "soh", min_history: int = 4, most: int | None = None) -> DataFrame:
    """A row for each anchor month and each later month: horizon, cumulative loss, and recent medians of features and loss rate at
    the anchor, which see nothing after it."""
    df = df.withColumn("recent_loss", sr.recent_loss_rate(df, soh)).withColumns({f"recent_{c}": sr.trailing_median(c, 6) for c in features})
    pairs = joins.later_pairs(df, "month", most=most).where(F.col("rn") >= min_history)
    pairs = pairs.withColumns({"horizon": F.col("later_age_months") - F.col("age_months"), "cum_loss": F.greatest(F.col(soh) - F.col(f"later_{soh}"), F.lit(0.0))})
    return pairs.where("horizon > 0").withColumn("weight", 1 + 0.15 * F.col("cum_loss"))


def hash_order(vin: Column, seed: int) -> Column:
    """A fixed shuffle that any engine can repeat."""
    return F.md5(F.concat_ws(":", vin.cast("string"), F.lit(seed).cast("string")))


def split(vehicles: DataFrame, by: str = "kind", seed: int = 0, train: float = 0.6, val: float = 0.2, forced: DataFrame | None = None) -> DataFrame:
    """vin, by, part: stratified split by vehicle into train, val and test; ``forced`` vehicles train."""
    rest = vehicles if forced is None else vehicles.join(forced.select("vin"), "vin", "left_anti")
    own = Window.partitionBy(by)
    rank = (F.row_number().over(own.orderBy(hash_order(F.col("vin"), seed), "vin")) - 1) / F.count(F.lit(1)).over(own)
    out = rest.withColumn("part", F.when(rank < train, "train").when(rank < train + val, "val").otherwise("test"))
    return out if forced is None else out.unionByName(vehicles.join(forced.select("vin"), "vin", "left_semi").withColumn("part", F.lit("train")))


def populations(df: DataFrame, soh: str = "soh", drop: float = 2.0, eol: float = 80.0) -> DataFrame:
    """vin, degrader, safe: what training populations are picked by."""
    per = df.groupBy("vin").agg(F.min_by(soh, "month").alias("first"), F.max_by(soh, "month").alias("last"), F.min(soh).alias("low"))
    return per.select("vin", (F.col("first") - F.col("last") >= drop).alias("degrader"), (F.col("low") > eol).alias("safe"))


def tail_vehicles(df: DataFrame, share: float = 0.2) -> DataFrame:
    """The last share of vehicles in order of vin, as a held-out set. Ranks run over the distinct vins, a small dimension."""
    vins = df.select("vin").distinct()
    n = vins.count()
    return vins.orderBy(F.desc("vin")).limit(n - int(n * (1 - share)))


def history(df: DataFrame, tail: float = 0.4, least: int = 4) -> DataFrame:
    """Adds past: whether a month is history, the rest being the held-out tail; vehicles too short for both go."""
    df = df.withColumns({"rn": F.row_number().over(sr.by_month()), "months": F.count(F.lit(1)).over(sr.own())})
    cut = F.greatest(F.floor(F.col("months") * (1 - tail)), F.lit(least))
    return df.withColumn("cut", cut).where("months > cut").withColumn("past", F.col("rn") <= F.col("cut")).drop("rn", "months", "cut")


def fold_of(vin: Column, k: int, seed: int = 0) -> Column:
    """Fold number of a vehicle; all its rows are in one."""
    return F.conv(F.substring(hash_order(vin, seed), 1, 8), 16, 10).cast("long") % k


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds z_ columns by the whole table's mean and standard deviation; 0 where a column does not vary."""
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    rows = df.crossJoin(F.broadcast(stats))
    rows = rows.withColumns({f"z_{c}": F.when(F.col(f"sd_{c}") > 0, (F.col(c) - F.col(f"mean_{c}")) / F.col(f"sd_{c}")).otherwise(0.0) for c in columns})
    return rows.drop(*[f"{n}_{c}" for c in columns for n in ("mean", "sd")])


def source_dummies(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    return df.withColumns({f"is_{x.lower().replace(' ', '_')}": (F.col(column) == x).cast("double") for x in levels})


def imputed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """Nulls become the column's median, beside a flag; MLlib vectors take neither null nor NaN."""
    medians = df.agg(*[F.coalesce(F.median(c), F.lit(0.0)).alias(f"mid_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(medians)).withColumns({f"{c}_missing": F.col(c).isNull().cast("double") for c in columns})
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"mid_{c}")) for c in columns}).drop(*[f"mid_{c}" for c in columns])
    return out, [*columns, *[f"{c}_missing" for c in columns]]
