"""Connected components by alternating large-star and small-star steps.

Each step moves edges towards the smallest node known; a fixed point is a set
of stars whose centres are the components' smallest nodes. Minima are taken
by a hash aggregate (partial first) and joined back; every round is written to
the shared folder. A hub's edges stream through one task of that join, two
numbers each; callers keep hubs small by handing in forests, not all links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import materialize


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of its component for every node that
    occurs in an edge between two different nodes. Nulls, loops and repeated
    edges are ignored."""
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct()
    e = materialize(e, "components")
    last = None
    while (now := _print_of(e)) != last:
        last = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = materialize(large.distinct(), "components")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select("a", F.col("m").alias("b")))
        e = materialize(small.distinct(), "components")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each of n nodes' component under edges a - b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
