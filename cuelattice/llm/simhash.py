"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

1. Each text's fingerprint: XXH64 (seed 42) of its four-word shingles, bit by bit
   the majority. Only (doc_id, fingerprint) goes on.
2. Distinct fingerprints are dealt to groups that agree in two of six blocks of
   bits: two fingerprints that differ in at most four bits leave at least two
   blocks untouched, so every link is inside a group. Groups over LIMIT are dealt
   again by one of five blocks (one of which four differences must spare), and
   what is still over LIMIT is cut into tiles, one task per pair of tiles.
3. Inside every group, GrayIndex finds the links, many groups at once; a group
   sends on a spanning forest of its links, never all pairs.
4. Components over fingerprints, then the smallest doc_id of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import copies
from .common import by_bytes, materialise, narrowed, partitions, text_views
from .components import connected_components, local_components

WORDS, SEED, NEAR = 4, 42, 4
LIMIT, WORK = 4_000, 4_000_000
#: (shift, width) of the blocks.
SIX = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
FIVE = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of every run of `words` words, repeats included; of the whole
    sequence if there are fewer; none for no word. A-Z are lower-cased."""
    w = text.lower().split()
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return [h(b" ".join(w), seed)] if w else []
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return [h(joined[s:e], seed) for s, e in zip(starts[: len(w) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list: a bit is 1 if set in over half; 0 for none."""
    sizes = np.array([len(x) for x in hashes], dtype=np.int64)
    count = np.zeros((len(sizes), 64), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.array([x for h in hashes for x in h], dtype=np.uint64)
    for lo in range(0, len(flat), 65_536):
        own = owner[lo : lo + 65_536]
        bits = np.unpackbits(flat[lo : lo + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        count[own[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    return np.packbits(2 * count > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        views = text_views(batch)
        out = np.zeros(len(views), np.uint64)
        for lo, hi in by_bytes(views, 4_000_000):
            out[lo:hi] = majority([shingle_hashes(bytes(v or b"")) for v in views[lo:hi]])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed integer)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


class GrayIndex:
    """Fingerprints of many groups in order of Gray rank, one tree of FAN children a
    node for each group; the trees' levels lie side by side in the same arrays.

    A node holds the bits that all below it share and that no node above it
    already holds. Down a path, differences in shared bits add up; a node whose
    sum exceeds the radius is dropped with all below it, and at a leaf the sum is
    the distance."""

    FAN = 8

    def __init__(self, fps: np.ndarray, group: np.ndarray | None = None):
        """group: numbers 0, 1, ... without a gap; without it all are one group."""
        group = np.zeros(len(fps), np.int64) if group is None else group
        rank = fps.copy()
        for s in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(s)
        self.order = np.lexsort((rank, group))
        value, mask, of = fps[self.order], np.full(len(fps), 2**64 - 1, np.uint64), group[self.order]
        self.levels = []
        while True:
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            if len(first) == len(of):  # each group has come to its root
                break
            place = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
            child = np.flatnonzero(place % self.FAN == 0)
            count = np.diff(np.r_[child, len(of)])
            ones, zeros = np.bitwise_and.reduceat(value & mask, child), np.bitwise_and.reduceat(~value & mask, child)
            shared = ones | zeros
            self.levels.append((value, mask & ~np.repeat(shared, count), child, count))
            value, mask, of = ones, shared, of[child]
        self.top = (value, mask)

    def links(self, queries: np.ndarray, radius: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, fingerprint) of all pairs of one group within the radius."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64) if group is None else group
        value, own = self.top
        sum_ = np.bitwise_count((queries ^ value[node]) & own[node])
        for value, own, child, count in reversed(self.levels):
            near = sum_ <= radius
            q, node, sum_ = q[near], node[near], sum_[near]
            n = count[node]
            end = np.cumsum(n)
            node = np.arange(end[-1] if len(end) else 0) + np.repeat(child[node] - end + n, n)
            q, sum_ = np.repeat(q, n), np.repeat(sum_, n)
            sum_ = sum_ + np.bitwise_count((queries[q] ^ value[node]) & own[node])
        near = sum_ <= radius
        return q[near], self.order[node[near]]


def forest(fps: np.ndarray, group: np.ndarray, radius: int = NEAR) -> np.ndarray:
    """Smallest position linked, directly or not, to each fingerprint inside its
    group. Queries go through the index in blocks of about WORK pairs at most."""
    label = np.arange(len(fps))
    index = GrayIndex(fps, group)
    work = np.cumsum(np.bincount(group)[group])
    lo = 0
    while lo < len(fps):
        hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + WORK)))
        q, x = index.links(fps[lo:hi], radius, group[lo:hi])
        a, b = label[q + lo], label[x]
        apart = a != b
        label = local_components(len(fps), a[apart], b[apart])[label]
        lo = hi
    return label


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (g, fp) sorted by g -> edges (a, b), a spanning forest per group."""

    def edges(g, fp):
        fp, group = fp.view(np.uint64), np.cumsum(np.r_[False, g[1:] != g[:-1]])
        root = forest(fp, group)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[root[moved]].view(np.int64)})

    held_g, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for pdf in batches:
        g, f = np.r_[held_g, pdf["g"].to_numpy()], np.r_[held_f, pdf["fp"].to_numpy()]
        cut = int(np.searchsorted(g, g[-1])) if len(g) else 0
        held_g, held_f = g[cut:], f[cut:]
        if cut:
            yield edges(g[:cut], f[:cut])
    if len(held_g):
        yield edges(held_g, held_f)


def _bits(shift: int, width: int):
    return F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds `n`, the rows of the group g; groups of one go."""
    return rows.join(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "g")


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b) that connect exactly those
    reachable by steps of at most NEAR differing bits."""
    n = partitions(fps.sparkSession)
    keys = [F.lit(k << 32).bitwiseOR(F.shiftleft(_bits(*SIX[i]), 16)).bitwiseOR(_bits(*SIX[j])) for k, (i, j) in enumerate(combinations(range(6), 2))]
    first = _grouped(fps.select("fp", F.explode(F.array(*keys)).alias("g")))
    small = first.filter(F.col("n") <= LIMIT).select("g", "fp")
    again = [F.xxhash64("g", F.lit(k), _bits(*b)) for k, b in enumerate(FIVE)]
    second = _grouped(first.filter(F.col("n") > LIMIT).select("fp", F.explode(F.array(*again)).alias("g")))
    tiles = F.ceil(F.col("n") / LIMIT).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    with_tile = second.select("g", "fp", own.alias("t"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("s"))
    large = with_tile.select(F.xxhash64("g", F.least("t", "s"), F.greatest("t", "s")).alias("g"), "fp")
    groups = small.unionByName(large).repartition(4 * n, "g").sortWithinPartitions("g", "fp")
    return groups.mapInPandas(_groups, "a long, b long")


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> doc_id, fp, component_id; one row per input row.

    Null and empty texts, and texts without words, have fingerprint zero and are
    linked like any other. component_id is the smallest doc_id reachable, null
    ids apart; it is null only where all ids are. Rows may repeat; an empty table
    gives an empty result; other columns are ignored."""
    prints = materialise(with_fingerprints(docs), "simhash")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = connected_components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents of `docs` without near-duplicates (see `copies`: candidates from this
    index, then from a prefix filter those beyond its radius; decided by five words and
    similarity 0.8), with the columns of `docs`, whatever their names.

    Of each component one row stays whole, that with the smallest id, null ids last; of
    repeated ids and rows one. Rows are told apart by a number of their own, so null
    and repeated ids do no harm. Null and empty texts and texts without words are alike;
    an empty table gives an empty result."""
    cols = docs.columns
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_doc")), "simhash-rows")
    of = copies.components(rows.select("_row", F.col("_doc.text").alias("text")))
    id_ = F.col("doc_id").cast("long")
    first = rows.select("_row", F.col("_doc.doc_id").alias("doc_id")).join(of, "_row").groupBy("component")
    kept = materialise(first.agg(F.min(F.struct(id_.isNull().alias("none"), id_.alias("id"), "_row")).alias("m")).select("m._row"), "simhash-kept")
    gone = materialise(of.select("_row").join(kept, "_row", "left_anti"), "simhash-gone")
    return narrowed(rows, gone, "_row", "left_anti").select(*[F.col(f"_doc.`{c}`") for c in cols])
