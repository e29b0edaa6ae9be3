"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many ordered buckets are planned; each costs one row of splits.
MAX_BUCKETS = 10_000
#: At most so many keys are broadcast (32 MB).
BROADCAST = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where
    that is unset in local mode (tests), a temporary folder of this session. On a
    cluster it has to be set."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cuelattice-"))
        found = sc._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def materialise(df: DataFrame, tag: str, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Cut the lineage: write Parquet to the shared folder and read it back. by: a column
    to write folders by; its rows are taken to be large, so few of them make a row group."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by).option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 1) if by else df.write
    (writer.option("compression", codec) if codec else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(*written: DataFrame) -> None:
    """Delete what `materialise` wrote, once nothing that is still to run reads it."""
    for df in written:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def narrowed(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join with a column of 8-byte keys: up to BROADCAST of them are
    counted and sent to all executors, so that df stays where it is; more are shuffled."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST else ids, key, how)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_views(batch: pa.RecordBatch, column: str = "text") -> list[memoryview | None]:
    """UTF-8 bytes of a string or binary column, without decoding; None for null."""
    col = batch.column(batch.schema.get_field_index(column))
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    _, offs, data = col.buffers()
    if data is None:
        return [None if n else memoryview(b"") for n in col.is_null().to_pylist()]
    offs = np.frombuffer(offs, dtype=np.int64)[col.offset : col.offset + len(col) + 1].tolist()
    view = memoryview(data)
    nulls = col.is_null().to_pylist() if col.null_count else None
    return [None if nulls and nulls[i] else view[offs[i] : offs[i + 1]] for i in range(len(col))]


def by_bytes(items: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about `limit` bytes; a longer item is alone."""
    start = total = 0
    for i, x in enumerate(items):
        n = len(x) if x is not None else 0
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(items):
        yield start, len(items)


def split_points(df: DataFrame, key: str, n: int) -> list:
    """At most n-1 ascending approximate quantiles of a numeric column."""
    if n < 2:
        return []
    steps = F.array(*[F.lit(i / n) for i in range(1, n)])
    got = df.agg(F.percentile_approx(key, steps, 10 * n).alias("q")).first()["q"]
    return sorted(set(got or []))


def bucket_of(key: Column, splits: list) -> Column:
    """Number of splits at or below the key; null keys go after all others.
    Two short searches instead of one over all splits."""
    if not splits:
        return F.lit(0)
    width = max(1, int(len(splits) ** 0.5))
    runs = [splits[i : i + width] for i in range(0, len(splits), width)]
    heads = F.array(*[F.lit(r[0]) for r in runs])
    below = lambda a: F.size(F.filter(a, lambda x: x <= key))
    coarse = below(heads)
    inner = F.element_at(F.array(*[F.array(*[F.lit(x) for x in r]) for r in runs]), coarse)
    fine = F.when(coarse == 0, 0).otherwise((coarse - 1) * width + below(inner))
    return F.when(key.isNull(), len(splits)).otherwise(fine).cast("int")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def let_go() -> None:
    """Forget what an earlier operator kept in this Python worker, and give the memory
    back to the system, where the C library can."""
    if _HELD:
        _HELD.clear()
        give_back()


def give_back() -> None:
    """Give what is free in this Python worker, Arrow's memory too, back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_HELD: dict = {}


def held(key: tuple, make):
    """What a Python worker keeps from task to task: one thing at a time, so that
    the caches of several operators never add up."""
    if key not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[key] = make()
    return _HELD[key]
