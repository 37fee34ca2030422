"""Folds over short ordered arrays, for series whose next value depends on the last result. JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCKS = "array<struct<s:double,n:double>>"


def isotonic(values: Column) -> Column:
    """Least-squares non-increasing fit of an array: neighbouring blocks whose means rise are pooled until none do."""
    none = F.array().cast(_BLOCKS)

    def push(blocks: Column, x: Column) -> Column:
        start = F.struct(none.alias("kept"), x.cast("double").alias("s"), F.lit(1.0).alias("n"), F.lit(False).alias("stop"))

        def pool(st: Column, b: Column) -> Column:
            rest = F.struct(F.concat(F.array(b), st["kept"]).alias("kept"), st["s"].alias("s"), st["n"].alias("n"), F.lit(True).alias("stop"))
            merged = F.struct(st["kept"].alias("kept"), (st["s"] + b["s"]).alias("s"), (st["n"] + b["n"]).alias("n"), F.lit(False).alias("stop"))
            return F.when(st["stop"] | (b["s"] / b["n"] >= st["s"] / st["n"]), rest).otherwise(merged)

        return F.aggregate(F.reverse(blocks), start, pool, lambda st: F.concat(st["kept"], F.array(F.struct(st["s"].alias("s"), st["n"].alias("n")))))

    blocks = F.aggregate(values, none, push)
    return F.flatten(F.transform(blocks, lambda b: F.array_repeat(b["s"] / b["n"], b["n"].cast("int"))))


def limited_descent(values: Column, gaps: Column, max_drop: float, top: float = 100.0) -> Column:
    """Never rising, and falling at most ``max_drop`` for each unit of gap; starts at most at ``top``."""

    def step(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        new = F.greatest(F.least(p["x"], last), last - max_drop * F.greatest(p["gap"], F.lit(1e-9)))
        return F.concat(done, F.array(new))

    pairs = F.zip_with(values, gaps, lambda x, g: F.struct(x.cast("double").alias("x"), g.cast("double").alias("gap")))
    first = F.array(F.least(F.element_at(values, 1), F.lit(top)).cast("double"))
    return F.aggregate(F.slice(pairs, 2, F.size(pairs)), first, step)


def per_vehicle(df: DataFrame, order: str, columns: list[str], new: dict[str, Column], by: str = "vin") -> DataFrame:
    """Collect each vehicle's short series in order, add array columns, and give rows back.

    ``new`` maps a name to an array expression over the arrays ``columns``; arrays keep the rows' order and length.
    """
    rows = df.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in df.columns if c not in (by, order)]))).alias("rows"))
    rows = rows.withColumns({c: F.col(f"rows.{c}") for c in columns})
    for name, expression in new.items():
        rows = rows.withColumn(name, expression)
    flat = rows.select(by, F.posexplode("rows").alias("at", "row"), *new)
    return flat.select(by, "row.*", *[F.element_at(n, F.col("at") + 1).alias(n) for n in new])
