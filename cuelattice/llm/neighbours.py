"""Approximate nearest neighbours with balanced posting lists.

Centroids come from balanced k-means on a bounded sample: one list for LIST vectors of
the table, CENTROIDS lists at most, fitted on FIT vectors a list and SAMPLE at least. Every vector joins its nearest list, and lists whose distance is
within BOUNDARY of that, REPLICAS at most. Centroids are held in memory as a
neighbour graph and found by best-first search, a block of vectors at a time; a query visits the lists within
PRUNE of its nearest one, PROBES at most, but at least LEAST lists, and further
ones until they hold ENOUGH rows. A query that still finds fewer than NEAREST
while there are more candidates visits all lists. Lists live in Spark: (list, slice) is a shuffle key, a list
longer than SLICE vectors is cut in slices, so no list, however many copies of a
vector it holds, meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, partitions

SAMPLE, FIT, CENTROIDS, LIST = 20_000, 8, 16_384, 256
BOUNDARY, REPLICAS, PRUNE, PROBES = 1.3, 6, 1.4, 64
SLICE, DEGREE, BEAM = 2_000, 24, 96
#: Vectors searched together; each takes a byte for every centroid.
BLOCK = 256
QUERY_EVERY, NEAREST = 100, 10
#: A vector is in REPLICAS lists at most, so ENOUGH rows hold twice the vectors needed.
LEAST, ENOUGH = 8, 2 * REPLICAS * (NEAREST + 1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>): vectors that are not null, empty or zero and
    hold only finite numbers, with a non-null id."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & good).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 8, weight: float = 1.0) -> np.ndarray:
    """k-means whose distances carry a penalty for crowded clusters."""
    rng = np.random.default_rng(7)
    c = x[np.sort(rng.permutation(len(x))[:k])].copy()
    load = np.zeros(len(c))
    for _ in range(rounds):
        own = np.empty(len(x), np.int64)
        for lo in range(0, len(x), 2_000):
            d = squares(x[lo : lo + 2_000], c)
            own[lo : lo + 2_000] = (d + weight * d.mean() * 0.05 * load[None]).argmin(1)
        n = np.bincount(own, minlength=len(c))
        load = n / max(1.0, len(x) / len(c)) - 1
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), len(c))])
    return np.unique(c, axis=0)


class CentroidGraph:
    """Centroids joined to their DEGREE nearest, searched best-first from a few
    entry points; links also lead back, so that no centroid is cut off."""

    def __init__(self, c: np.ndarray):
        self.c = c
        self.held = np.zeros(len(c), np.int64)  # rows of each list, once known
        links: list[set[int]] = [set() for _ in c]
        for lo in range(0, len(c), 1_000):
            d = squares(c[lo : lo + 1_000], c)
            near = np.argsort(d, axis=1, kind="stable")[:, 1 : DEGREE + 1]
            for i, row in enumerate(near.tolist()):
                links[lo + i].update(row)
        for i in range(len(c)):
            for j in list(links[i])[: DEGREE // 2]:
                links[j].add(i)
            links[i].add((i + 1) % len(c))
        self.links = np.full((len(c), max(1, max(len(s - {i}) for i, s in enumerate(links)))), -1, np.int32)
        for i, s in enumerate(links):
            near = sorted(s - {i})
            self.links[i, : len(near)] = near
        self.entries = np.arange(0, len(c), max(1, len(c) // 16))

    def search(self, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """For each row of q the beam nearest centroids found, ascending: positions and
        distances. All rows advance together: each opens its nearest unopened centroid and
        keeps the best `beam` of what it held and what that one is joined to."""
        far = lambda at, rows: ((self.c[at] - q[rows][:, None]) ** 2).sum(2)
        beam, n = min(beam, len(self.c)), len(q)
        seen = np.zeros((n, len(self.c)), bool)
        seen[:, self.entries] = True
        at = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        d = far(at, np.arange(n))
        more = max(0, beam - at.shape[1])
        at, d = np.pad(at, ((0, 0), (0, more))), np.pad(d, ((0, 0), (0, more)), constant_values=np.inf)
        opened = ~np.isfinite(d)
        while True:
            left = np.where(opened, np.inf, d)
            pick = left.argmin(1)
            rows = np.flatnonzero(np.isfinite(left[np.arange(n), pick]))
            if not len(rows):
                break
            opened[rows, pick[rows]] = True
            new = self.links[at[rows, pick[rows]]]
            fresh = (new >= 0) & ~seen[rows[:, None], new]
            who, where = np.nonzero(fresh)
            seen[rows[who], new[who, where]] = True
            dn = np.full(new.shape, np.inf)
            dn[who, where] = ((self.c[new[who, where]] - q[rows[who]]) ** 2).sum(1)
            d_all, at_all, opened_all = np.hstack([d[rows], dn]), np.hstack([at[rows], new]), np.hstack([opened[rows], ~fresh])
            best = np.argpartition(d_all, d.shape[1] - 1, axis=1)[:, : d.shape[1]]
            d[rows], at[rows], opened[rows] = (np.take_along_axis(x, best, 1) for x in (d_all, at_all, opened_all))
        order = np.lexsort((at, d), axis=1)[:, :beam]
        return np.take_along_axis(at, order, 1), np.sqrt(np.take_along_axis(d, order, 1))


def lists_for(graph: CentroidGraph, v: np.ndarray) -> list[np.ndarray]:
    """Lists that each vector joins: nearest first, boundary replicas after."""
    at, d = graph.search(v, beam=32)
    at, d = at[:, :REPLICAS], d[:, :REPLICAS]
    return [a[k] for a, k in zip(at, d <= BOUNDARY * d[:, :1] + 1e-12, strict=True)]


def probes_for(graph: CentroidGraph, v: np.ndarray) -> list[np.ndarray]:
    at, d = graph.search(v)
    near = (d[:, :PROBES] <= PRUNE * d[:, :1] + 1e-12).sum(1)
    full = (np.cumsum(graph.held[at], axis=1) < ENOUGH).sum(1) + 1
    return [a[:n] for a, n in zip(at, np.maximum(np.maximum(near, full), LEAST), strict=True)]


def _assign(sent, choose):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), BLOCK):
                part = pdf.iloc[lo : lo + BLOCK]
                v = part["v"].tolist()
                chosen = choose(sent.value, np.stack([np.asarray(x, np.float64) for x in v]))
                rep = [len(c) for c in chosen]
                yield pd.DataFrame({"vec_id": np.repeat(part["vec_id"].to_numpy(), rep), "v": [x for x, n in zip(v, rep, strict=True) for _ in range(n)], "list": np.concatenate(chosen).astype(np.int64)})

    return run


def _scan(key, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Best NEAREST of one slice of a list for each query that visits it."""
    found = []
    if len(own) and len(asked):
        ids, x = own["vec_id"].to_numpy(), np.stack(own["v"].to_numpy())
        for lo in range(0, len(asked), 64):
            part = asked.iloc[lo : lo + 64]
            q, qid = np.stack(part["v"].to_numpy()), part["vec_id"].to_numpy()
            d = squares(q, x)
            for k in range(len(qid)):
                other = np.flatnonzero(ids != qid[k])
                near = other
                if len(other) > NEAREST:
                    edge = np.partition(d[k][other], NEAREST - 1)[NEAREST - 1]
                    near = other[d[k][other] <= edge + 1e-9 * (1 + edge)]
                exact = np.sqrt(((x[near] - q[k]) ** 2).sum(1))
                top = np.lexsort((ids[near], exact))[:NEAREST]
                found.append(pd.DataFrame({"query_id": qid[k], "vec_id": ids[near][top], "score": exact[top]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(vectors: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest vectors found for every query.

    Queries are vectors whose id is divisible by `every`; their own id is no
    candidate. Unusable vectors (see `usable`) take no part. Distances need one
    length: vectors of another than the commonest (of equally common ones the shortest)
    take no part either.
    Repeated ids count once per candidate list; equal distances go to the smaller
    id; an empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    all_ = materialise(usable(vectors), "vectors")
    first = all_.select(F.size("v").alias("n")).groupBy("n").count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if first is None:
        return spark.createDataFrame([], empty)
    all_ = all_.filter(F.size("v") == first["n"])
    k = int(np.clip(first["count"] / LIST, 1, CENTROIDS))
    sample = all_.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(max(SAMPLE, FIT * k)).select("v").toPandas()
    x = np.unique(np.stack(sample["v"].to_numpy()), axis=0)
    k = min(k, max(1, len(x) // FIT))
    graph = CentroidGraph(balanced_kmeans(x, k))
    sent = spark.sparkContext.broadcast(graph)
    n = partitions(spark)
    schema = "vec_id long, v array<double>, list long"
    posted = materialise(all_.repartition(2 * n).mapInPandas(_assign(sent, lists_for), schema), "postings")
    rows = materialise(posted.groupBy("list").agg(F.count(F.lit(1)).alias("rows")), "list-sizes")
    for r in rows.collect():
        graph.held[r["list"]] = r["rows"]
    size = rows.select("list", F.ceil(F.col("rows") / SLICE).cast("int").alias("slices"))
    posted = posted.join(size, "list").withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.col("slices")).cast("int"))
    queries = all_.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).repartition(2 * n)
    cut = ["list", "slice"]

    def nearest(asked: DataFrame) -> DataFrame:
        """Of queries (vec_id, v, list, slices), the nearest in those lists."""
        asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        found = posted.select("vec_id", "v", *cut).groupBy(*cut).cogroup(asked.select("vec_id", "v", *cut).groupBy(*cut)).applyInPandas(_scan, "query_id long, vec_id long, score double")
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")

    sizes = spark.sparkContext.broadcast(graph)
    probed = queries.mapInPandas(_assign(sizes, probes_for), schema)
    found = materialise(nearest(probed.join(size, "list")), "neighbours")
    want = min(NEAREST, all_.select("vec_id").distinct().count() - 1)
    filled = found.groupBy(F.col("query_id").alias("vec_id")).count().filter(F.col("count") >= want)
    short = materialise(queries.join(filled, "vec_id", "left_anti"), "neighbours-short")
    if want < 1 or short.isEmpty():
        return found
    rest = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(found.columns)
    every_list = short.select("vec_id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(graph.c) - 1).cast("long"))).alias("list"))
    return rest.unionByName(nearest(every_list.join(size, "list")))
