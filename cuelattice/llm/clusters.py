"""Centroid clustering by a bisector tournament.

Vectors become integers, floor(scale * x). For each pair of centroids i < j the plane
half way between them is kept as an integer normal and threshold: j is nearer than i
where 2 x.(cj - ci) > |cj|^2 - |ci|^2. A vector goes through k - 1 such tests, the nearer
of each pair meeting the next centroid; a test of exactly zero keeps the smaller number.
Only the last one's distance is computed.

A round is one scan of the table: each task adds up its vectors by centroid and sends
k * (dims + 2) sums, however many vectors it has; the sums of all tasks are added in
Spark, and k * dims numbers come to the driver. Arithmetic is exact: in doubles where
every sum stays below 2^53, in Python's integers otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Integers beyond this don't fit the decimals that carry sums; such vectors take no part.
LARGEST = 2.0**80
COUNT, INERTIA = -1, -2
RESULT = StructType(
    [
        StructField("cluster", IntegerType()), StructField("distance", LongType()), StructField("cluster_inertia", LongType()), StructField("inertia", LongType()), StructField("centroid_sha256", StringType()),
    ]
)


def whole(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and their integers as doubles, one row each."""
    keep = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False) == dims, bool)
    flat = column.filter(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
        fit = (np.abs(flat) < LARGEST).all(1)
    keep[keep] = fit
    return keep, flat[fit]


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


class Tournament:
    """Normals and thresholds of all pairs of centroids, given as lists of integers."""

    def __init__(self, centroids: list[list[int]]):
        self.c = np.array(centroids, dtype=object)
        squares = (self.c * self.c).sum(1)
        self.normals = [2 * (self.c[j] - self.c[:j]) for j in range(len(centroids))]
        self.thresholds = [squares[j] - squares[:j] for j in range(len(centroids))]
        self.widest = max((int(abs(c)) for row in centroids for c in row), default=0)

    def exact_in_doubles(self, x: np.ndarray) -> bool:
        """No sum of a test or a distance of these vectors passes 2^53."""
        most = max(float(np.abs(x).max(initial=0.0)), float(self.widest))
        return 4 * x.shape[1] * most * most < 2.0**53

    def play(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Integers (as doubles) -> the vectors, winners and squared distances, the first
        and last in the arithmetic that is exact for them."""
        kind = np.float64 if self.exact_in_doubles(x) else object
        x = x if kind is np.float64 else _integers(x)
        won = np.zeros(len(x), np.int64)
        for j in range(1, len(self.c)):
            normals, thresholds = self.normals[j].astype(kind), self.thresholds[j].astype(kind)
            for i in np.unique(won):
                at = np.flatnonzero(won == i)
                won[at[(x[at] @ normals[i] - thresholds[i]) > 0]] = j
        apart = x - self.c.astype(kind)[won]
        return x, won, (apart * apart).sum(1)


def _sums(vector: str, centroids: list[list[int]], dims: int, scale: int):
    """Task of a round: (cluster, pos, total) over all its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        players, total = Tournament(centroids), {}
        for batch in batches:
            _, x = whole(batch.column(batch.schema.get_field_index(vector)), dims, scale)
            for lo in range(0, len(x), 4096):
                part, won, far = players.play(x[lo : lo + 4096])
                for c in np.unique(won).tolist():
                    here = won == c
                    new = [*part[here].sum(0).tolist(), int(here.sum()), far[here].sum()]
                    total[c] = [a + int(b) for a, b in zip(total.get(c, [0] * (dims + 2)), new, strict=True)]
        # A sum of distances that passes a long is null in the end, so it needn't be carried whole.
        rows = [(c, p, Decimal(min(v, 2**63) if p == INERTIA else v)) for c, vs in total.items() for p, v in zip([*range(dims), COUNT, INERTIA], vs, strict=True)]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.decimal128(38, 0))], ["cluster", "pos", "total"])

    return run


def _first(vectors: DataFrame, ident: str, vector: str, k: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = whole(batch.column(batch.schema.get_field_index(vector)), dims, scale)
            ids = batch.column(batch.schema.get_field_index(ident)).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(np.arange(0, x.size + 1, dims, dtype=np.int32), pa.array(x.ravel()))], [ident, "_whole"])

    schema = StructType([vectors.schema[ident], StructField("_whole", ArrayType(DoubleType()))])
    rows = vectors.mapInArrow(kept, schema).withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string")), 256))
    return [[int(v) for v in r["_whole"]] for r in rows.orderBy(F.asc_nulls_last("_hash"), "_whole").limit(k).collect()]


def _round(vectors: DataFrame, vector: str, centroids: list[list[int]], dims: int, scale: int) -> dict[int, dict[int, int]]:
    """cluster -> pos -> sum over the table; at most k * (dims + 2) numbers."""
    sums = vectors.mapInArrow(_sums(vector, centroids, dims, scale), "cluster int, pos int, total decimal(38,0)").groupBy("cluster", "pos").agg(F.sum("total").alias("total"))
    out: dict[int, dict[int, int]] = {}
    for r in sums.collect():
        out.setdefault(r["cluster"], {})[r["pos"]] = int(r["total"])
    return out


def _long(n: int) -> int | None:
    return n if abs(n) < 2**63 else None


def cluster(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(ident, vector, ...) -> ident, cluster, distance (squared), cluster_inertia,
    inertia, centroid_sha256; one row for each vector that takes part: those with exactly
    `dims` components, none null or non-finite, and no integer of 2^80 or more.

    The first centroids are the k vectors with the smallest sha256 of `seed:ident`, null
    idents last, equal ones by their integers; with fewer vectors there are fewer
    clusters. Equal distances go to the smaller number; a centroid without vectors stays
    where it is. Repeated rows each count. A distance or sum that passes a long is null.
    An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    rows = vectors.select(ident, vector)
    schema = StructType([rows.schema[ident], *RESULT.fields])
    centroids = _first(rows, ident, vector, k, dims, scale, seed)
    if not centroids:
        return rows.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        for c, s in _round(rows, vector, centroids, dims, scale).items():
            centroids[c] = [s[p] // s[COUNT] for p in range(dims)]
    last = {c: s[INERTIA] for c, s in _round(rows, vector, centroids, dims, scale).items()}
    inertia, every = [_long(last.get(c, 0)) for c in range(len(centroids))], _long(sum(last.values()))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        players = Tournament(centroids)
        for batch in batches:
            keep, x = whole(batch.column(batch.schema.get_field_index(vector)), dims, scale)
            _, won, far = players.play(x)
            won = won.tolist()
            columns = [
                batch.column(batch.schema.get_field_index(ident)).filter(pa.array(keep)), pa.array(won, pa.int32()), pa.array([_long(int(d)) for d in far.tolist()], pa.int64()),
                pa.array([inertia[c] for c in won], pa.int64()), pa.array([every] * len(won), pa.int64()), pa.array([digests[c] for c in won], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(assign, schema)
