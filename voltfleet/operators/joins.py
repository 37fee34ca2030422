"""Joins beyond equality: interpolation, nearest point, keyword, band and pair search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import dominance
from .series import with_ranks


def interpolate(knots: DataFrame, probes: DataFrame, x: str, y: str, by: str = "vin") -> DataFrame:
    """Probe rows with y: linear between the neighbouring knots, constant beyond the ends; null without knots.

    Knots and probes are one sorted run per group, so each row sees its last and next knot without a range join.
    """
    both = knots.select(by, F.col(x).cast("double").alias("px"), F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).alias("knot"), F.lit(0).alias("probe"), F.lit(None).cast("struct<" + ",".join(f"`{n}`:{t}" for n, t in probes.dtypes) + ">").alias("row"))
    asked = probes.select(by, F.col(x).cast("double").alias("px"), F.lit(None).cast("struct<x:double,y:double>").alias("knot"), F.lit(1).alias("probe"), F.struct(*probes.columns).alias("row"))
    w = Window.partitionBy(by).orderBy("px", "probe")
    back = F.last("knot", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("knot", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    rows = both.unionByName(asked).withColumns({"a": back, "b": ahead}).where("probe = 1")
    at = F.col("a.y") + (F.col("b.y") - F.col("a.y")) * (F.col("px") - F.col("a.x")) / (F.col("b.x") - F.col("a.x"))
    value = F.when(F.col("a").isNull(), F.col("b.y")).when(F.col("b").isNull() | (F.col("a.x") == F.col("px")), F.col("a.y")).otherwise(at)
    return rows.select("row.*", value.alias(y))


def nearest(rows: DataFrame, probes: DataFrame, x: str, at: str, values: list[str], by: str = "vin") -> DataFrame:
    """For each probe the row of its group with x nearest to ``at``; of two as near the smaller x. Probes of groups without rows go.

    Rows and probes are one sorted run per group, as in :func:`interpolate`, so no probe meets all rows.
    """
    point = F.struct(F.col(x).alias("x"), F.struct(x, *values).alias("row"))
    none = rows.select(point.alias("p")).schema["p"].dataType
    kinds = "struct<" + ",".join(f"`{n}`:{t}" for n, t in probes.dtypes) + ">"
    both = rows.where(F.col(x).isNotNull()).select(by, F.col(x).cast("double").alias("px"), point.alias("point"), F.lit(None).cast(kinds).alias("asked"))
    asked = probes.select(by, F.col(at).cast("double").alias("px"), F.lit(None).cast(none).alias("point"), F.struct(*probes.columns).alias("asked"))
    w = Window.partitionBy(by).orderBy("px", F.col("asked").isNotNull())
    back = F.last("point", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("point", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    met = both.unionByName(asked).withColumns({"a": back, "b": ahead}).where("asked is not null and (a is not null or b is not null)")
    nearer = F.when(F.col("b").isNull() | (F.col("px") - F.col("a.x") <= F.col("b.x") - F.col("px")), F.col("a.row")).otherwise(F.col("b.row"))
    return met.select("asked.*", nearer.alias("best")).select(*probes.columns, "best.*")


def later_pairs(df: DataFrame, order: str, by: str = "vin", most: int | None = None) -> DataFrame:
    """Each row as anchor with every later row of its group (columns later_*), at most ``most`` rows ahead.

    With ``most`` a row carries the rows ahead of it, so work is rows times ``most``; without it, all pairs are the result.
    """
    rn = df.withColumn("rn", F.row_number().over(Window.partitionBy(by).orderBy(order)))
    own = [c for c in rn.columns if c != by]
    later = [F.col(c).alias(f"later_{c}") for c in own]
    if most is None:
        return rn.join(rn.select(by, *later), by).where("later_rn > rn")
    ahead = F.collect_list(F.struct(*later)).over(Window.partitionBy(by).orderBy("rn").rowsBetween(1, most))
    return rn.where(F.col(by).isNotNull()).select(by, *own, ahead.alias("ahead")).select(by, *own, F.explode("ahead").alias("one")).select(by, *own, "one.*")


def rounded_step_join(steps: DataFrame, rows: DataFrame, age: str, start: str, h: str = "h") -> DataFrame:
    """Rows with the forecast step that their age, less the start, rounds to (halves to even)."""
    return rows.withColumn(h, F.bround(F.col(age) - F.col(start)).cast("int")).join(steps, ["vin", h])


def keyword(rows: DataFrame, text: Column, rules: DataFrame, default: Column) -> DataFrame:
    """Rows with rule: the value of the first rule (by priority) whose keyword the text contains, else the default.

    ``rules`` (priority, keyword, value) is a small dimension; each row meets each rule once, without a shuffle of the rows.
    """
    found = rules.agg(F.array_sort(F.collect_list(F.struct("priority", "keyword", "value"))).alias("rules"))
    hit = F.filter("rules", lambda r: F.contains(F.lower(text), r["keyword"]))
    return rows.crossJoin(F.broadcast(found)).withColumn("rule", F.coalesce(F.try_element_at(hit, F.lit(1))["value"], default)).drop("rules")


def fuzzy_spec(rows: DataFrame, name: str, specs: DataFrame) -> DataFrame:
    """Rows with spec_id: a spec whose model the name contains, else one of the same first word, else the source's first.

    ``specs``: source, model, spec_id; ``rows``: source, ``name``. Models inside a name are found by equality with the name's parts of
    models' lengths, so no name meets all models of its source.
    """
    names = rows.where("source is not null").select("source", F.col(name).alias("spec_name")).distinct()  # a dimension, however many rows carry the names
    names = names.withColumn("low", F.lower("spec_name"))
    best, word = F.min("hit"), lambda c: F.split_part(c, F.lit(" "), F.lit(1))
    kinds = specs.groupBy("source", F.lower("model").alias("model")).agg(F.min(F.struct("spec_id")).alias("hit"))
    lengths = kinds.agg(F.collect_set(F.length("model")).alias("lengths"))  # one row, as long as the longest model at most
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.length("low") - n + 1), lambda i: F.substr("low", i, n))
    parts = F.array_distinct(F.flatten(F.transform(F.filter("lengths", lambda n: n <= F.length("low")), cut)))
    inside = names.crossJoin(F.broadcast(lengths)).select("source", "spec_name", F.explode(parts).alias("model")).join(kinds, ["source", "model"]).groupBy("source", "spec_name").agg(best.alias("inside"))
    alike = kinds.groupBy("source", word(F.col("model")).alias("word")).agg(best.alias("alike"))
    first = kinds.groupBy("source").agg(best.alias("first"))
    found = names.withColumn("word", word(F.col("low"))).join(first, "source").join(alike, ["source", "word"], "left").join(inside, ["source", "spec_name"], "left")
    found = found.select(F.col("source").alias("spec_source"), "spec_name", F.coalesce("inside", "alike", "first")["spec_id"].alias("spec_id"))
    return rows.join(found, F.col("source").eqNullSafe(F.col("spec_source")) & F.col(name).eqNullSafe(F.col("spec_name")), "left").drop("spec_source", "spec_name")


def peer_rank(df: DataFrame, value: str, age: str = "age_months", by: str = "oem", band: float = 6.0, least: int = 10) -> DataFrame:
    """Share in % of same-source vehicles of about the same age with a lower value; of the whole source with too few peers.

    One row of ``df`` for each vehicle; ones without a value, an age or a source have no rank and no row. Peers are counted, not
    met: :func:`dominance.band_counts`.
    """
    counts = dominance.band_counts(df.select("vin", by, age, value), "vin", age, value, by, band).withColumnRenamed("within", "peers")
    fleet = with_ranks(df, value, [by]).withColumn("fleet", F.col("below") / F.col("of") * 100).drop("below", "ties", "of")
    share = F.col("lower") / F.col("peers") * 100
    return fleet.join(counts, "vin").withColumn("rank", F.when(F.col("peers") >= least, share).otherwise(F.col("fleet"))).drop("lower", "fleet")


def contrasting_pair(df: DataFrame, near: str, far: str, tolerance: float, by: str) -> DataFrame:
    """Per group the two vehicles with ``near`` within a tolerance of each other and the most different ``far``.

    Only a vehicle's extreme partners can be in that pair, so no pairs are listed. Values are cut into cells of the tolerance's
    width: all of a cell are within it of each other, which makes the partners there the cell's extremes, and of the next cell
    those up to the tolerance are a beginning, whose extremes run along as the cell's rows and the askers are gone through in
    order. Of equally different pairs the one with the smallest vehicles is taken.
    """
    value = F.struct(F.col("far"), F.col("vin"))
    rows = df.select(by, "vin", F.col(near).cast("double").alias("near"), F.col(far).cast("double").alias("far")).dropna(subset=["near", "far"]).withColumn("cell", F.floor(F.col("near") / tolerance))
    low, high = F.min(value), F.max(F.struct(F.col("far"), (-F.col("vin")).alias("minus")))  # the smallest vehicle of equal values in both
    own = Window.partitionBy(by, "cell")
    same = rows.select(by, "vin", "far", low.over(own).alias("low"), high.over(own).alias("high"))
    asks = rows.select(by, "vin", "near", "far", (F.col("near") + tolerance).alias("at"), (F.col("cell") + 1).alias("cell"), F.lit(1).alias("asks"))
    line = rows.select(by, "vin", "near", "far", F.col("near").alias("at"), "cell", F.lit(0).alias("asks")).unionByName(asks)
    so_far = Window.partitionBy(by, "cell").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    there = F.when(F.col("asks") == 0, value), F.when(F.col("asks") == 0, F.struct(F.col("far"), (-F.col("vin")).alias("minus")))
    later = line.select(by, "vin", "far", "asks", F.min(there[0]).over(so_far).alias("low"), F.max(there[1]).over(so_far).alias("high")).where("asks = 1").drop("asks")
    partners = F.explode(F.array(F.struct(F.col("low.far").alias("far"), F.col("low.vin").alias("vin")), F.struct(F.col("high.far").alias("far"), (-F.col("high.minus")).alias("vin"))))
    pairs = same.unionByName(later).select(by, "vin", "far", partners.alias("other")).where("other.vin <> vin")
    pairs = pairs.select(by, F.least("vin", "other.vin").alias("vin_a"), F.greatest("vin", "other.vin").alias("vin_b"), F.abs(F.col("far") - F.col("other.far")).alias("apart"))
    best = F.max_by(F.struct("vin_a", "vin_b", "apart"), F.struct("apart", -F.col("vin_a"), -F.col("vin_b")))
    return pairs.groupBy(by).agg(best.alias("best")).select(by, "best.*")


def overlap(a: DataFrame, b: DataFrame, least: int = 3) -> DataFrame:
    """Months that both feeds have, of vehicles with at least ``least`` such months."""
    both = a.join(b, ["vin", "month"])
    counts = both.groupBy("vin").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    return both.join(counts, "vin")


def latest(df: DataFrame, order: str = "month", by: str = "vin") -> DataFrame:
    """Each group's last row."""
    rest = [c for c in df.columns if c != by]
    return df.groupBy(by).agg(F.max_by(F.struct(*rest), order).alias("row")).select(by, "row.*")


def top_per_group(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group in a stated order: a top-k report."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= k)


def first_of(df: DataFrame, by: str, order: list[Column]) -> DataFrame:
    """One row of each key, by a stated order."""
    return top_per_group(df, by, order, 1).drop("place")
