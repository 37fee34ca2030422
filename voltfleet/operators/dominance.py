"""How many rows of a group lie in a band of x and under a value, without meeting any of them in pairs.

A group is cut into strips along x and, apart from that, along the value, with about as many rows each. A row asks at the two ends
of its band; what is up to such an end and under its value is: whole strips before (sums of cells, carried to the strip of the
end), the part of that strip, and, for strips before, the part of the value's own strip. Each part is counted in one strip by a
sorted pass (``counting.smaller_before``). A row goes to two strips, its questions to four, so shuffles grow with the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import counting
from ..sources.shared import cut

#: Rows of a strip, wanted; strips of a group, at most; questions that a strip answers in one task.
STRIP, STRIPS, ASKED = 65_536, 1024, 131_072

_OUT = "id {id}, within long, lower long"


def _cell(value: Column, edges: Column, ties: Column | None = None) -> Column:
    """Number of edges under the value; of a value that repeats as an edge, its rows are dealt over the cells that it spans."""
    under = F.size(F.filter(edges, lambda e: e < value))
    if ties is None:
        return F.coalesce(F.when(edges.isNotNull(), under), F.lit(0))
    span = F.size(F.filter(edges, lambda e: e == value)) + 1
    return F.coalesce(F.when(edges.isNotNull(), under + F.pmod(ties, span).cast("int")), F.lit(0))


def band_counts(df: DataFrame, key: str, x: str, value: str, by: str, band: float, strip: int = STRIP, asked: int = ASKED) -> DataFrame:
    """key, within (rows of its group with x from own x - band to own x + band, itself included), lower (those of a smaller value).

    ``key`` is unique. Rows without a group or x take no part. A null or NaN value is under none, and has no lower (null), but its
    row is within others' bands. Ties in x or value may be of any size.
    """
    kinds = dict(df.dtypes)
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in (x, value)}
    rows = df.select(F.col(key).alias("id"), F.col(by).alias("g"), number[x].alias("x"), number[value].alias("v")).where("g is not null and x is not null")
    sizes = rows.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > strip)
    # edges of the groups over a strip's size only, of which there are at most rows / strip, and as many edges
    shares = [i / STRIPS for i in range(1, STRIPS)]
    quantiles = rows.join(F.broadcast(sizes), "g").groupBy("g", "n").agg(*[F.percentile_approx(c, shares, 10 * STRIPS).alias(c) for c in ("x", "v")])
    every = F.ceil(F.lit(float(STRIPS)) / F.least(F.ceil(F.col("n") / strip), F.lit(STRIPS))).cast("int")
    thinned = [F.filter(c, lambda _, i: (i + 1) % every == 0).alias(f"{c}_edges") for c in ("x", "v")]
    edges = quantiles.select("g", *thinned)
    tie, top = F.xxhash64("id"), F.col("x") + band
    cells = {
        "cx": _cell(F.col("x"), F.col("x_edges"), tie),
        "cv": _cell(F.col("v"), F.col("v_edges"), tie),
        "cuts": F.coalesce(F.when(F.col("x_edges").isNotNull(), F.size("x_edges")), F.lit(0)),
        "c_low": _cell(F.col("x") - band, F.col("x_edges")),
        "c_top": _cell(top, F.col("x_edges")) + F.coalesce(F.when(F.col("x_edges").isNotNull(), F.size(F.filter("x_edges", lambda e: e == top))), F.lit(0)),
        "c_own": _cell(F.col("v"), F.col("v_edges")),
    }
    # read six times below
    placed = cut(rows.join(F.broadcast(edges), "g", "left").select(*rows.columns, *[c.cast("int").alias(n) for n, c in cells.items()]))
    none = F.lit(None)

    # a question's turn among rows of its x: before them (0) or after (2); rows have 1
    low = F.struct(F.lit(-1).alias("sign"), (F.col("x") - band).alias("at"), F.lit(0).alias("turn"), F.col("c_low").alias("c"))
    high = F.struct(F.lit(1).alias("sign"), top.alias("at"), F.lit(2).alias("turn"), F.col("c_top").alias("c"))
    questions = placed.select("id", "g", "v", F.col("c_own").alias("cv"), "cuts", F.explode(F.array(low, high)).alias("e"))
    columns = ["g", "axis", "cell", "id", "sign", "at", "turn", "v", "column"]
    line = lambda axis, cell, at, turn, sign, column: [F.lit(axis).alias("axis"), cell.cast("int").alias("cell"), F.col("id"), sign.cast("int").alias("sign"), at.cast("double").alias("at"), turn.cast("int").alias("turn"), F.col("v"), column.cast("int").alias("column")]
    zero = F.lit(0)
    points = placed.select("g", *line(0, F.col("cx"), F.col("x"), F.lit(1), zero, none)).unionByName(
        placed.where("cuts > 0 and v is not null").select("g", *line(1, F.col("cv"), F.col("cx"), F.lit(1), zero, none))
    )
    asks = questions.select("g", *line(0, F.col("e.c"), F.col("e.at"), F.col("e.turn"), F.col("e.sign"), F.col("cv"))).unionByName(
        questions.where("cuts > 0 and v is not null").select("g", *line(1, F.col("cv"), F.col("e.c"), zero, F.col("e.sign"), none))
    )

    # strips that are asked too often for one task: their rows are copied for each part of the questions
    busy = asks.groupBy("g", "axis", "cell").agg(F.count("*").alias("k")).where(F.col("k") > asked).select("g", "axis", "cell", F.ceil(F.col("k") / asked).cast("int").alias("parts"))
    strips = ["g", "axis", "cell"]
    parts = F.coalesce("parts", F.lit(1))
    points = points.join(F.broadcast(busy), strips, "left").withColumn("part", F.explode(F.sequence(zero, parts - 1))).select(*columns, "part")
    asks = asks.join(F.broadcast(busy), strips, "left").withColumn("part", F.pmod(F.xxhash64("id", "sign"), parts).cast("int")).select(*columns, "part")

    # sums over the strips before, by strip of the value, with all values last
    grid = placed.where("cuts > 0").groupBy("g", "cx", "cv", F.col("v").isNotNull().alias("has"), "cuts").agg(F.count("*").alias("n"))

    def summed(table: pa.Table) -> pa.Table:
        cx, cv, has, n = (table.column(c).to_numpy() for c in ("cx", "cv", "has", "n"))
        last = table.column("cuts")[0].as_py() + 1
        known, whole = np.zeros((last + 1, last + 1), dtype=np.int64), np.zeros(last + 1, dtype=np.int64)
        np.add.at(known, (cx + 1, cv + 1), np.where(has, n, 0))
        np.add.at(whole, cx + 1, n)
        known, whole = known.cumsum(axis=0).cumsum(axis=1), whole.cumsum()
        sums = [[*known[c].tolist(), int(whole[c])] for c in range(last)]
        return pa.table({"g": pa.array([table.column("g")[0].as_py()] * last, type=table.schema.field("g").type), "cell": pa.array(range(last), type=pa.int32()), "sums": pa.array(sums, type=pa.list_(pa.int64()))})

    carried = grid.groupBy("g").applyInArrow(summed, f"g {kinds[by]}, cell int, sums array<bigint>")
    carried = carried.withColumn("axis", zero).join(F.broadcast(busy), strips, "left").withColumn("part", F.explode(F.sequence(zero, parts - 1)))
    lines = points.unionByName(asks).withColumn("sums", F.lit(None).cast("array<bigint>")).unionByName(carried.select(*strips, "part", "sums"), allowMissingColumns=True)

    def count(table: pa.Table) -> pa.Table:
        along_value = table.column("axis")[0].as_py() == 1
        carry = table.column("sums").drop_null()
        before = np.array(carry[0].as_py(), dtype=np.int64) if len(carry) else None
        table = table.filter(pc.is_null(table.column("sums")))
        at, v = (table.column(c).to_numpy() for c in ("at", "v"))
        turn, sign = (table.column(c).to_numpy() for c in ("turn", "sign"))
        is_row, known = sign == 0, ~np.isnan(v)
        order = np.lexsort((turn, at))
        rank = np.empty(len(v), dtype=np.int64)
        rank[np.lexsort((is_row, v))] = np.arange(len(v))  # a question comes before rows of its value
        lower, within = np.empty(len(v), dtype=np.int64), np.empty(len(v), dtype=np.int64)
        lower[order] = counting.smaller_before(rank[order], (is_row & known)[order])
        within[order] = np.cumsum(is_row[order])
        asking = np.flatnonzero(sign != 0)
        lower, within = lower[asking], within[asking]
        if along_value:
            within[:] = 0
        elif before is not None:
            within += before[-1]
            lower += before[table.column("column").to_numpy()[asking].astype(np.int64)]
        known = known[asking]
        return pa.table({"id": table.column("id").take(pa.array(asking)), "within": pa.array(sign[asking] * within, type=pa.int64()), "lower": pa.array(sign[asking] * lower, mask=~known, type=pa.int64())})

    counted = lines.groupBy(*strips, "part").applyInArrow(count, _OUT.format(id=kinds[key]))
    return counted.groupBy(F.col("id").alias(key)).agg(F.sum("within").alias("within"), F.sum("lower").alias("lower"))
