"""Connected components of a link table, and a small in-task version for arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import land

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is its component's smallest node.

    Alternating large-star and small-star steps over the link table. Each step
    is a grouped minimum (combined before the shuffle) joined back to the
    links, so a node with very many links is split by the skew join. Every
    round is written to the shared folder and read again. The number of links
    never grows; the loop ends when a round changes nothing.
    """
    state = land(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links"
    )

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(state)
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = land(large, "large_star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        state = land(small, "small_star")
        now = mark(state)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component for links (a[i], b[i]) among ``n`` nodes."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label
