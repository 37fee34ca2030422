"""Connected components over link tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number of each of n nodes' component, given links a-b."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


#: A node with more links than this and than a thousandth of all links is a hub; there are at most two thousand hubs.
HUB = 512
#: Links of a partition, about, and the fewest partitions.
PART_LINKS, LEAST_PARTS = 1 << 20, 8


def _pulled(rows: DataFrame, least: DataFrame, hubs: list[int], parts: int) -> DataFrame:
    """Rows (a, b) with the m of a; hubs' m are broadcast, so that no task gets all links of a hub."""
    if not hubs:
        return rows.repartition(parts, "a").join(least.repartition(parts, "a"), "a")
    hub = F.col("a").isin(hubs)
    return rows.where(~hub).repartition(parts, "a").join(least.where(~hub).repartition(parts, "a"), "a").unionByName(rows.where(hub).join(F.broadcast(least.where(hub)), "a"))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node that a link (a long, b long) to another node touches; root is the component's smallest node.

    Alternating star contractions: each round links every node's larger neighbours to the smallest one, then its smaller
    ones; the number of rounds grows with the logarithm of a component's size. A round is one checkpointed table, in as many
    partitions as its links need.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    most = edges.count()
    parts = max(LEAST_PARTS, most // PART_LINKS)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nodes = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")))
        hub = F.when(F.col("n") > max(HUB, most // 1000), F.col("a"))
        middle, hubs = nodes.agg(F.count_if((F.col("m") < F.col("a")) & (F.col("n") > 1)), F.collect_list(hub)).first()
        if not middle:  # each node is a root or has its root as its only neighbour
            return nodes.select(F.col("a").alias("node"), F.col("m").alias("root"))
        large = _pulled(both.where("b > a"), nodes.select("a", "m"), hubs, parts).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.repartition(parts, "a", "b").dropDuplicates())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _pulled(large, low, hubs, parts).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.unionByName(low.select("a", F.col("m").alias("b"))).repartition(parts, "a", "b").dropDuplicates())
