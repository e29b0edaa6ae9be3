"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and joins on the edge table; its result goes to
reliable storage through checkpoint(). Edges never reach the driver: only their
number and a checksum do, to see when nothing changes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long, undirected -> (node, root): every node of an edge with the
    smallest node of its component. Loops and repeats are allowed."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct().checkpoint()
    state = None
    for _ in range(ROUNDS):
        new = _small_star(_large_star(e)).checkpoint()
        now = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        e, stable, state = new, now == state, now
        if stable:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    least = materialise(least, "components-least")  # apart from its aggregate, so that Spark can split a hub's rows
    out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    pairs = e.join(least, "u")
    out = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions, by vectorised
    minimum labels and pointer jumping."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        keep = la != lb
        if not keep.any():
            break
        a, b, la, lb = a[keep], b[keep], la[keep], lb[keep]
        low = np.minimum(la, lb)
        np.minimum.at(label, np.maximum(la, lb), low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label
