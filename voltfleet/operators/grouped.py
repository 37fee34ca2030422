"""Per-vehicle reductions as aggregates; lookups as joins; builders by source, and rows made of rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Build = Callable[[DataFrame], DataFrame]


def net_change(value: str, order: str) -> Column:
    """Aggregate: the value that comes first in order less the one that comes last."""
    return F.min_by(value, order) - F.max_by(value, order)


def variation(value: str) -> Column:
    """Aggregate: coefficient of variation in %; null where the mean is zero or a group has one row."""
    return F.when(F.avg(value) != 0, F.stddev_samp(value) / F.avg(value) * 100)


def looked_up(df: DataFrame, key: str, table: DataFrame, value: str, default: float) -> DataFrame:
    """``df`` with ``value`` of the one row that its key has in ``table``, or the default; Spark broadcasts a table small enough."""
    return df.join(table.select(key, value), key, "left").fillna(default, [value])


def by_source(df: DataFrame, source: str, builders: dict[str, Build], default: Build) -> DataFrame:
    """Each source's rows through its own builder, others through the default; results by name, missing columns null."""
    parts = [build(df.where(F.col(source) == name)) for name, build in builders.items()]
    parts.append(default(df.where(~F.coalesce(F.col(source).isin(*builders), F.lit(False)))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def expanded_months(df: DataFrame, months: int, h: str = "h") -> DataFrame:
    """Each row once for every month ahead."""
    return df.withColumn(h, F.explode(F.sequence(F.lit(1), F.lit(months))))
