"""Data quality, artifact audit and training curation of vehicle-month series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import folds, selection, stats
from . import series as sr


def manifest(df: DataFrame, soh: str = "soh", min_months: int = 6, min_span: float = 4.0, exempt_drop: float = 8.0, degrader_drop: float = 2.0, eol: float = 80.0, density: str = "n") -> DataFrame:
    """One row per vehicle: months, span, density, first and last health, class, and a verdict with its reasons.

    A proven degrader, by a large drop or by having reached end of life, trains whatever else is thin.
    """
    per = df.groupBy("vin").agg(
        F.count("*").alias("months"),
        (F.max("age_months") - F.min("age_months")).alias("span_months"),
        F.min("age_months").alias("first_age_mo"),
        F.max("age_months").alias("current_age_mo"),
        F.min_by(soh, "month").alias("soh_first"),
        F.max_by(soh, "month").alias("soh_last"),
        F.median(density).alias("obs_per_month"),
    )
    per = per.withColumn("soh_drop", F.col("soh_first") - F.col("soh_last"))
    thin = F.concat_ws(";", F.when(F.col("months") < min_months, f"<{min_months}_valid_months"), F.when(F.col("span_months") < min_span, f"<{min_span:.0f}mo_span"))
    proven = (F.col("soh_drop") >= exempt_drop) | (F.col("soh_last") <= eol)
    per = per.withColumns({"thin": thin, "vehicle_class": F.when(F.col("soh_drop") >= degrader_drop, "degrader").otherwise("flat")})
    reasons = F.when((F.col("thin") != "") & proven, F.concat(F.lit("proven-degrader(overrides:"), "thin", F.lit(")"))).otherwise(F.col("thin"))
    return per.withColumns({"reasons": reasons, "quality": F.when((F.col("thin") == "") | proven, "trainable").otherwise("thin")}).drop("thin")


def trainable(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of vehicles that are not flagged thin; unknown vehicles stay."""
    return df.join(verdicts.where("quality = 'thin'").select("vin"), "vin", "left_anti")


def excluded(verdicts: DataFrame) -> DataFrame:
    """The exclusion log."""
    return verdicts.where("quality = 'thin'").select("vin", "reasons")


def thick_months(df: DataFrame, sessions: str = "n_sessions", min_months: int = 3) -> DataFrame:
    """Months with sessions, of vehicles that have enough of them."""
    return sr.group_at_least(df.where(F.col(sessions) > 0), min_months)


def audit(df: DataFrame, soh: str = "soh", raw: str = "soh_raw", eol: float = 80.0, cliff: float = 6.0, stuck: int = 5) -> DataFrame:
    """Artifact flags per vehicle: a cliff, a stuck floor after a real drop, a floor far below the raw values, and their union."""
    steps = df.withColumn("step", F.lag(soh).over(sr.by_month()) - F.col(soh))
    per = steps.groupBy("vin").agg(F.max("step").alias("worst"), F.max(F.col(raw) - F.col(soh)).alias("gap"), F.min(soh).alias("low"), F.min_by(soh, "month").alias("first"), F.max_by(soh, "month").alias("last"), F.count("*").alias("n")).where("n >= 2")
    per = per.join(sr.trailing_run(df, soh), "vin")
    yes = lambda c: F.coalesce(c, F.lit(False))
    per = per.withColumns({"is_cliff": yes(F.col("worst") >= cliff), "is_stuck": (F.col("run") >= stuck) & (F.col("last") == F.col("low")) & (F.col("first") - F.col("last") >= 3), "is_floor": yes(F.col("gap") >= 2)})
    return per.withColumns({"tainted": F.col("is_cliff") | F.col("is_stuck") | F.col("is_floor"), "aged": F.col("low") <= eol})


def audit_summary(audited: DataFrame) -> DataFrame:
    """Counts of each flag."""
    flags = ["is_cliff", "is_stuck", "is_floor", "tainted", "aged"]
    return audited.agg(F.count("*").alias("vehicles"), *[F.count_if(F.col(f)).alias(f) for f in flags], F.count_if(F.col("tainted") & F.col("aged")).alias("tainted_aged"))


def curate(df: DataFrame, soh: str = "soh", eol: float = 80.0, warranty_months: float = 60.0, min_months: int = 6, min_span: float = 6.0, near_share: float = 0.6, min_decline: float = 3.0, flat_decline: float = 2.0) -> DataFrame:
    """Bucket per vehicle from a robust trend on the root of age, never rising, read at the warranty's end.

    Of those projected to survive it, aged or nearly aged ones that declined are GRACEFUL, those that hardly did FLAT, the rest
    PROBABLE_OOR; the others are AT_RISK, and those seen too little EXCLUDED.
    """
    df = df.withColumn("root", F.sqrt(F.greatest("age_months", F.lit(0.0))))
    per = df.groupBy("vin").agg(F.count("*").alias("months"), F.min("age_months").alias("age0"), F.max("age_months").alias("age"), F.min(soh).alias("low"), F.median(soh).alias("middle"))
    per = per.join(stats.theil_sen(df, "root", soh).drop("n"), "vin")
    rises = F.col("slope") > 0
    per = per.withColumns({"b": F.when(rises, 0.0).otherwise(F.col("slope")), "c": F.when(rises, F.col("middle")).otherwise(F.col("intercept"))})
    at = lambda age: F.col("c") + F.col("b") * F.sqrt(age)
    per = per.withColumns({"projected": at(F.lit(warranty_months)), "decline": at(F.col("age0")) - at(F.col("age")), "close": (F.col("low") <= eol) | (F.col("age") >= near_share * warranty_months)})
    survives = F.col("projected") >= eol
    bucket = F.when((F.col("months") < min_months) | (F.col("age") - F.col("age0") < min_span), "EXCLUDED").when(survives & F.col("close") & (F.col("decline") >= min_decline), "GRACEFUL")
    bucket = bucket.when(survives & (F.col("decline") < flat_decline), "FLAT").when(survives, "PROBABLE_OOR").otherwise("AT_RISK")
    return per.select("vin", "projected", "decline", bucket.alias("bucket"))


def recovery_inliers(df: DataFrame, soh: str = "soh_raw", margin: float = 3.5, most_per_year: float = 10.0) -> DataFrame:
    """Adds inlier: not a dip that later months recover from (but for the last two months), nor a fade from 100 steeper than
    plausible."""
    df = selection.later_medians(df, soh, "later").withColumns({"left": F.row_number().over(Window.partitionBy("vin").orderBy(F.desc("month")))})
    dip = (F.col("left") > 2) & (F.col("later") > F.col(soh) + margin)
    fast = (100 - F.col(soh)) / F.greatest(F.col("age_months") / 12, F.lit(0.25)) > most_per_year
    return df.withColumn("inlier", ~F.coalesce(dip, F.lit(False)) & ~fast).drop("later", "left")


def clean_label(df: DataFrame, soh: str = "soh_raw") -> DataFrame:
    """Adds soh: non-increasing fit of the inliers, read at all ages (linear between, constant beyond); raw with fewer than three."""
    marked = recovery_inliers(df, soh)
    picked = F.filter("p", lambda x: x["inlier"])
    rows = marked.groupBy("vin").agg(F.array_sort(F.collect_list(F.struct("age_months", F.col(soh).alias("y"), "inlier", "month"))).alias("p"))
    rows = rows.withColumn("k", picked).withColumn("fit", folds.isotonic(F.transform("k", lambda x: x["y"]))).withColumn("knots", F.arrays_zip(F.transform("k", lambda x: x["age_months"]).alias("a"), F.col("fit").alias("f")))
    flat = rows.select("vin", F.size("k").alias("kept"), "knots", F.explode("p").alias("row"))
    x = F.col("row.age_months")
    below = F.try_element_at(F.filter("knots", lambda q: q["a"] <= x), F.lit(-1))
    above = F.try_element_at(F.filter("knots", lambda q: q["a"] > x), F.lit(1))
    flat = flat.withColumns({"lo": below, "hi": above})
    inner = F.col("lo.f") + (F.col("hi.f") - F.col("lo.f")) * (x - F.col("lo.a")) / (F.col("hi.a") - F.col("lo.a"))
    value = F.when(F.col("kept") < 3, F.col("row.y")).otherwise(F.coalesce(inner, F.col("lo.f"), F.col("hi.f")))
    return flat.select("vin", F.col("row.month").alias("month"), F.col("row.inlier").alias("inlier"), value.alias("soh"))


def confirmed_decliners(coulomb: DataFrame, other: DataFrame, third: DataFrame, least: float = 3.0) -> DataFrame:
    """vin of vehicles whose coulomb trend, or both other trends, fall by at least ``least`` points a year. Inputs: vin, ppy."""
    named = [t.select("vin", F.col("ppy").alias(n)) for t, n in ((coulomb, "a"), (other, "b"), (third, "c"))]
    all_ = named[0].join(named[1], "vin", "full").join(named[2], "vin", "full")
    return all_.where((F.col("a") >= least) | ((F.col("b") >= least) & (F.col("c") >= least))).select("vin")


def flatness(df: DataFrame, soh: str = "soh", same: float = 0.05, share: float = 0.8) -> DataFrame:
    """Per vehicle the share of months that barely change, and whether it is over ``share``."""
    steps = df.withColumn("same", (F.abs(F.col(soh) - F.lag(soh).over(sr.by_month())) < same).cast("double"))
    return steps.groupBy("vin").agg(F.avg("same").alias("flat_share")).withColumn("flat", F.coalesce(F.col("flat_share") > share, F.lit(False)))


def diagnose(df: DataFrame, soh: str = "soh", pinned: float = 99.5, flat: float = 1.5) -> DataFrame:
    """One row: share of flat vehicles, of vehicles pinned near 100, and of capped months."""
    per = df.groupBy("vin").agg((F.max(soh) - F.min(soh)).alias("range"), F.min(soh).alias("low"))
    whole = per.agg(F.avg((F.col("range") < flat).cast("double")).alias("flat_share"), F.avg((F.col("low") >= pinned).cast("double")).alias("pinned_share"))
    return whole.crossJoin(df.agg(F.avg((F.col(soh) >= 100).cast("double")).alias("capped_share")))


def quality_tier(df: DataFrame, value: str = "soh_raw") -> DataFrame:
    """HIGH, MED or LOW per vehicle from months, readings, noise and garbage."""
    per = df.groupBy("vin").agg(F.count("*").alias("months"), F.avg("n").alias("support"), stats.cv(value).alias("noise"), F.avg("garbage").alias("garbage"))
    high = (F.col("months") >= 12) & (F.col("support") >= 7) & (F.col("noise") < 8) & (F.col("garbage") < 0.05)
    medium = (F.col("months") >= 6) & (F.col("support") >= 4) & (F.col("garbage") < 0.2)
    return per.withColumn("tier", F.when(high, "HIGH").when(medium, "MED").otherwise("LOW"))


def impute_age(df: DataFrame, registration: DataFrame) -> DataFrame:
    """age_months from the registration; vehicles without one start at the cohort's median age at first sight."""
    first = df.groupBy("vin").agg(F.min("month").alias("first_month")).join(registration.select("vin", "regd_date"), "vin", "left")
    first = first.withColumn("gap", F.datediff("first_month", "regd_date") / 30.4)
    cohort = first.agg(F.coalesce(F.median("gap"), F.lit(0.0)).alias("cohort_gap"))
    first = first.crossJoin(F.broadcast(cohort))
    return df.drop("age_months").join(first, "vin").withColumn("age_months", F.datediff("month", "first_month") / 30.4 + F.coalesce("gap", "cohort_gap")).withColumn("imputed", F.col("gap").isNull()).drop("gap", "cohort_gap", "first_month", "regd_date")


def registration_from_age(df: DataFrame) -> DataFrame:
    """vin, regd_date: the first month less its rounded age."""
    first = df.groupBy("vin").agg(F.min_by(F.struct("month", "age_months"), "month").alias("f"))
    return first.select("vin", F.add_months("f.month", -F.bround("f.age_months").cast("int")).alias("regd_date"))


def swap_target(df: DataFrame, label: DataFrame, column: str, least: int = 3) -> DataFrame:
    """Rows with soh replaced by a label, of vehicles with enough labelled months."""
    return sr.group_at_least(df.drop("soh").join(label.select("vin", "month", F.col(column).alias("soh")).where("soh is not null"), ["vin", "month"]), least)


def stability_index(base: DataFrame, now: DataFrame, column: str, low: float, high: float, bins: int = 10) -> DataFrame:
    """One row: population stability index of a column against a baseline, over equal buckets (halves of a row where empty)."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.where(F.col(column).isNotNull()).groupBy(F.width_bucket(column, F.lit(low), F.lit(high), F.lit(bins)).alias("bucket")).agg(F.count("*").alias("k"))
        return counts.crossJoin(F.broadcast(counts.agg(F.sum("k").alias("all")))).select("bucket", (F.col("k") / F.col("all")).alias(name), (0.5 / F.col("all")).alias(f"{name}_least"))

    both = shares(base, "a").join(shares(now, "b"), "bucket", "full")
    least = both.agg(F.max("a_least").alias("al"), F.max("b_least").alias("bl"))
    a, b = F.coalesce("a", "al"), F.coalesce("b", "bl")
    return both.crossJoin(F.broadcast(least)).agg(F.sum((b - a) * F.ln(b / a)).alias("psi"), F.count("*").alias("buckets"))


