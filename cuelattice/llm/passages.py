"""Suffix-array deduplication of repeated passages.

A byte is redundant if a string of LENGTH bytes over it also starts elsewhere, in
any document. `keep="none"` removes every copy, `keep="first"` all but the first in
reading order. The suffix array of a whole corpus fits no task, so it is built in
pieces that together decide every window of LENGTH bytes exactly:

1. Anchors. Inside each window the GRAM-byte string with the smallest hash is its
   anchor, so equal windows have equal anchors. Consecutive windows with one
   anchor form a span; there is about one span in 70 bytes.
2. Spans whose anchor occurs once hold no repeat. The others are pieces: equal spans
   (by 128 bits of hashes) are one piece, read first and last at known places.
3. Each piece is cut out of its text once and sent to its anchor's group. Groups of
   more than HOT pieces are split: each piece's windows hold either more text left of
   the anchor or more right of it, so two longer anchors stand in for one, until groups
   are small or the anchor is the whole window.
4. A task puts the suffixes of its groups in order to depth LENGTH, and finds each one's
   longest previous factor from the previous and the next smaller reading position in
   that order. A window repeats an earlier one if its factor has LENGTH bytes; for
   `keep="none"` larger reading positions count too. What is found at the last reading
   of a piece holds for all readings between.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, give_back, held, materialise, mix64, partitions, shared_dir, text_views

LENGTH, GRAM = 200, 64
REACH = LENGTH - GRAM + 1
HOT = 3_000
#: Window starts that are hashed at once, and bytes that are put in order at once; below
#: 2**20 with what overlaps.
BLOCK = 500_000
_BASE = 0x9E3779B97F4A7C15 | 1
_LOW = np.uint64((1 << 21) - 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, and a word per byte."""
    up = np.full(n, _BASE, np.uint64)
    up[0] = 1
    down = np.full(n, pow(_BASE, -1, 2**64), np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down), mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values, from running minima of blocks of w."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of the texts data[starts:ends]: first and last window start, anchor
    position, hash of the anchor, hash of the span."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    up, down, word = held(("powers",), lambda: _powers(1 << 20))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word[data] * up[:n], out=total[1:])
    gram = mix64((total[GRAM:] - total[: n - GRAM + 1]) * down[: n - GRAM + 1])
    order = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
    anchor = (sliding_min(order, REACH) & _LOW).astype(np.int64)
    change = np.zeros(n + 1, np.int32)
    long_ = ends - starts >= LENGTH
    np.add.at(change, starts[long_], 1)
    np.add.at(change, ends[long_] - LENGTH + 1, -1)
    valid = np.cumsum(change[: len(anchor)]) > 0
    first = np.zeros(n + 1, bool)
    first[starts] = True
    new = valid & np.r_[True, (anchor[1:] != anchor[:-1]) | ~valid[:-1] | first[1 : len(anchor)]]
    a = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.r_[new[1:] | ~valid[1:], True])
    p, e = anchor[a], stop + LENGTH
    span = (total[e] - total[a]) * down[a] + (((stop - a) << 8) | (p - a)).astype(np.uint64) * np.uint64(_BASE)
    return a, stop, p, gram[p], mix64(span)


def _anchors(only_gram: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, views = batch.column(0).to_numpy(), text_views(batch)
            for lo, hi in by_bytes(views, BLOCK // 2):
                part = [np.frombuffer(v, np.uint8) if v is not None and len(v) >= LENGTH else np.zeros(0, np.uint8) for v in views[lo:hi]]
                cuts = range(0, max(1, len(part[0]) - LENGTH + 1), BLOCK) if len(part) == 1 else [0]
                for cut in cuts:
                    some = [part[0][cut : cut + BLOCK + LENGTH - 1]] if len(part) == 1 else part
                    ends = np.cumsum([len(x) for x in some])
                    starts = np.r_[0, ends[:-1]]
                    a, stop, p, gram, span = spans(np.concatenate(some), starts, ends)
                    if not len(a):
                        continue
                    if only_gram:
                        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64))], names=["gram"])
                        continue
                    doc = np.searchsorted(ends, a, side="right")
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rids[lo:hi][doc], a - starts[doc] + cut, (stop - a).astype(np.int16), (p - a).astype(np.int16), gram.view(np.int64), span.view(np.int64))], names=["rid", "a", "more", "off", "gram", "span"])
        give_back()

    return run


def prefix_ranks(data: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(depth, rank of every position by its first `depth` bytes), from packed 8-byte
    words, three ranks at a time, up to below LENGTH; lexicographic, zeros after the
    end."""
    n = len(data)
    padded = np.zeros(n + LENGTH + 8, np.uint64)
    padded[:n] = data
    word = np.zeros(n + LENGTH, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + n + LENGTH]
    out = [(8, np.unique(word, return_inverse=True)[1])]
    while 3 * out[-1][0] < LENGTH:
        depth, rank = out[-1]
        out.append((3 * depth, np.unique(_joined_ranks(rank, np.arange(len(rank) - 2 * depth), depth, 2 * depth), return_inverse=True)[1]))
    return out


def _joined_ranks(rank: np.ndarray, at: np.ndarray, first: int, second: int) -> np.ndarray:
    """Ranks at three places of each position as one number."""
    bits = max(1, int(rank.max()).bit_length())
    return ((rank[at] << bits | rank[at + first]) << bits) | rank[at + second]


def nearest_smaller(x: np.ndarray) -> np.ndarray:
    """Position of the nearest smaller value before each value, -1 if there is none.
    A position that is larger hands on its own candidate, so steps double."""
    at = np.arange(len(x)) - 1
    open_ = np.flatnonzero(at >= 0)
    open_ = open_[x[at[open_]] > x[open_]]
    while len(open_):
        at[open_] = at[at[open_]]
        open_ = open_[at[open_] >= 0]
        open_ = open_[x[at[open_]] > x[open_]]
    return at


def common_prefix(data: np.ndarray, ranks: list[tuple[int, np.ndarray]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bytes, up to LENGTH, that the suffixes at i and at j begin with alike."""
    size = np.zeros(len(i), np.int64)
    for depth, rank in reversed(ranks):
        for _ in range(2):
            x, y = (np.minimum(p + size, len(rank) - 1) for p in (i, j))
            size += depth * (rank[x] == rank[y])
    for _ in range(7):  # below the shallowest rank, byte by byte
        x, y = (np.minimum(p + size, len(data) - 1) for p in (i, j))
        size += (data[x] == data[y]) & (size < LENGTH)
    return np.minimum(size, LENGTH)


def longest_factors(data: np.ndarray, at: np.ndarray, when: np.ndarray, both: bool = False) -> np.ndarray:
    """Longest previous factor of each suffix (starting at `at`, LENGTH bytes long or
    more; `when`: distinct reading positions), up to LENGTH: how much of it also begins
    at an earlier reading position. In suffix order the previous and the next smaller
    reading position are the two earlier suffixes most like it. both: where that is below
    LENGTH, later reading positions count as well."""
    ranks = prefix_ranks(data)
    depth, deepest = ranks[-1]
    whole = np.unique(_joined_ranks(deepest, at, min(depth, (LENGTH - depth) // 2), LENGTH - depth), return_inverse=True)[1]
    order = np.lexsort((when, whole))
    n, whole, at = len(order), whole[order], at[order]
    factor = np.zeros(n, np.int64)
    for place in (when[order], -when[order])[: 1 + both]:
        for near in (nearest_smaller(place), n - 1 - nearest_smaller(place[::-1])[::-1]):
            ok = np.flatnonzero((near >= 0) & (near < n) & (factor < LENGTH))
            same = whole[ok] == whole[near[ok]]
            factor[ok[same]] = LENGTH
            ok = ok[~same]
            factor[ok] = np.maximum(factor[ok], common_prefix(data, ranks, at[ok], at[near[ok]]))
    out = np.empty(n, np.int64)
    out[order] = factor
    return out


def _shard(keep: str):
    """Rows (key, ctx, lo, hi, rid, a, c, last_rid, last_a, gram, span), sorted by key ->
    what repeats. Whole groups are gathered to about BLOCK bytes. A piece that occurs
    several times stands in the order of suffixes twice, where it is read first and
    where it is read last. Output: rid, s, e, ranges of first occurrences whose windows
    have a factor of LENGTH bytes; and gram, span with s, e from the piece's start, of
    the others."""

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        data = np.frombuffer(b"".join(rows["ctx"]), np.uint8)
        size = rows["ctx"].map(len).to_numpy()
        base = np.cumsum(size) - size
        again = np.flatnonzero(rows["c"].to_numpy() > 1)
        piece = np.r_[np.arange(len(rows)), again]  # a row of its own for the last occurrence
        copy = np.arange(len(piece)) >= len(rows)
        lo, per = rows["lo"].to_numpy()[piece], (rows["hi"] - rows["lo"] + 1).to_numpy()[piece]
        rid = np.where(copy, rows["last_rid"].to_numpy()[piece], rows["rid"].to_numpy()[piece])
        a = np.where(copy, rows["last_a"].to_numpy()[piece], rows["a"].to_numpy()[piece])
        row = np.repeat(np.arange(len(piece)), per)
        off = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + lo[row]
        at, when = base[piece][row] + off, np.unique(rid, return_inverse=True)[1][row] * (1 << 40) + a[row] + off
        hit = np.flatnonzero(longest_factors(data, at, when, both=keep != "first") >= LENGTH)
        new = np.r_[True, (np.diff(hit) > 1) | (np.diff(row[hit]) != 0)] if len(hit) else np.zeros(0, bool)
        s, e = hit[new], hit[np.r_[new[1:], True]] if len(hit) else hit
        of, other = row[s], copy[row[s]]
        begin = np.where(other, 0, a[of])
        return pd.DataFrame({"rid": np.where(other, -1, rid[of]), "s": begin + off[s], "e": begin + off[e] + LENGTH, **{c: rows[k].to_numpy()[piece[of]] for c, k in (("gram", "gram"), ("span", "span"), ("first_rid", "rid"), ("first_a", "a"))}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        size, last = 0, None
        for pdf in batches:
            key, upto = pdf["key"].to_numpy(), np.r_[0, np.cumsum(pdf["ctx"].map(len).to_numpy())]
            begin = 0
            for k in np.flatnonzero(np.r_[len(key) > 0 and key[0] != last, key[1:] != key[:-1]]).tolist():
                if size + upto[k] - upto[begin] > BLOCK:
                    yield decide(pd.concat([*parts, pdf.iloc[begin:k]], ignore_index=True))
                    parts, size, begin = [], 0, k
            if len(key):
                parts.append(pdf.iloc[begin:])
                size, last = size + int(upto[-1] - upto[begin]), key[-1]
        if parts:
            yield decide(pd.concat(parts, ignore_index=True))
            parts.clear()
        give_back()

    return run


def _split(items: DataFrame) -> DataFrame:
    """Each item (key, ctx, lo, hi, core, n_core, ...) as two with longer anchors:
    windows with at least `left` bytes before the anchor, and the others."""
    rest = LENGTH - F.col("n_core")
    left = F.ceil(rest / 2).cast("int")
    edge = F.col("core") - left
    a = F.struct(F.col("lo").alias("lo"), F.least("hi", edge).alias("hi"), edge.alias("core"), (F.col("n_core") + left).alias("n_core"))
    b = F.struct(F.greatest(F.col("lo"), edge + 1).alias("lo"), F.col("hi").alias("hi"), F.col("core").alias("core"), (F.col("n_core") + rest - left + 1).alias("n_core"))
    parts = items.withColumn("_p", F.explode(F.array(a, b))).filter("_p.lo <= _p.hi")
    for c in ("lo", "hi", "core", "n_core"):
        parts = parts.withColumn(c, F.col(f"_p.{c}"))
    text = F.expr("substring(ctx, core + 1, n_core)")
    return parts.drop("_p").withColumn("key", F.xxhash64("key", "n_core", text))


def _store(docs: DataFrame) -> DataFrame:
    """Texts under a row number, bucketed by it, so that later joins move no text."""
    spark = docs.sparkSession
    name, n = f"texts_{uuid.uuid4().hex}", partitions(spark)
    rows = docs.withColumn("rid", F.monotonically_increasing_id()).repartition(n, "rid")
    rows.write.format("parquet").option("path", f"{shared_dir(spark)}/{name}").bucketBy(n, "rid").saveAsTable(name)
    return spark.table(name)


def repeated_ranges(texts: DataFrame, keep: str = "none") -> DataFrame:
    """(rid, text) -> rid, cuts: array of (s, e) byte ranges to remove, unmerged."""
    spark = texts.sparkSession
    n = partitions(spark)
    body = texts.select("rid", "text")
    again = body.mapInArrow(_anchors(True), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gram")
    again = materialise(again, "passages-again")  # apart from its aggregate, so that Spark can split a frequent anchor's rows
    seen = body.mapInArrow(_anchors(False), "rid long, a long, more short, off short, gram long, span long").join(again, "gram")
    seen = materialise(seen, "passages-seen")
    at = F.struct("rid", "a")
    kinds = seen.groupBy("gram", "span").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("rid", "a", "more", "off")).alias("first"), F.max(at).alias("last"))
    kinds = materialise(kinds.select("gram", "span", "c", "first.*", F.col("last.rid").alias("last_rid"), F.col("last.a").alias("last_a")), "passages-kinds")

    cut = F.expr("substring(cast(text as binary), cast(a + 1 as int), more + 200)")
    whose = ["rid", "a", "c", "last_rid", "last_a", "gram", "span"]

    def items(some: DataFrame) -> DataFrame:
        return body.join(some.hint("shuffle_hash"), "rid").select(
            F.col("gram").alias("key"), cut.alias("ctx"), F.lit(0).alias("lo"), F.col("more").cast("int").alias("hi"),
            F.col("off").cast("int").alias("core"), F.lit(GRAM).alias("n_core"), *whose)

    schema = "rid long, s long, e long, gram long, span long, first_rid long, first_a long"
    frequent = materialise(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("gram"), "passages-frequent")
    found = []
    if frequent.isEmpty():
        ready = items(kinds)
    else:
        ready, hot = items(kinds.join(frequent, "gram", "left_anti")), items(kinds.join(frequent, "gram"))
        while True:
            parts = _split(hot)
            sizes = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("all"), F.min(F.struct("rid", F.col("a") + F.col("lo"))).alias("low"))
            parts = materialise(parts.join(sizes.filter(F.col("all") > 1), "key"), "passages-hot")
            whole = parts.filter(F.col("n_core") >= LENGTH)  # one window: all of a group are equal
            mine = ~F.struct(F.col("rid"), F.col("a") + F.col("lo")).eqNullSafe(F.col("low")) if keep == "first" else F.lit(True)
            of = [F.col("gram"), F.col("span"), F.col("rid").alias("first_rid"), F.col("a").alias("first_a")]
            found.append(whole.filter(mine).select("rid", (F.col("a") + F.col("lo")).alias("s"), (F.col("a") + F.col("hi") + LENGTH).alias("e"), *of))
            found.append(whole.filter("c > 1").select(F.lit(-1).cast("long").alias("rid"), F.col("lo").cast("long").alias("s"), (F.col("hi") + LENGTH).cast("long").alias("e"), *of))
            parts = parts.filter(F.col("n_core") < LENGTH)
            ready = ready.unionByName(parts.filter(F.col("n") <= HOT).select(ready.columns))
            hot = parts.filter(F.col("n") > HOT).select(ready.columns)
            if hot.isEmpty():
                break
    shards = ready.repartition(4 * n, "key").sortWithinPartitions("key", "rid", "a")
    found.append(shards.mapInPandas(_shard(keep), schema))
    decided = materialise(functools.reduce(DataFrame.unionByName, found), "passages-decided")
    rest = decided.filter("rid < 0").select("gram", "span", "s", "e", "first_rid", "first_a")
    others = seen.select("gram", "span", "rid", "a").join(rest, ["gram", "span"])
    if keep == "first":
        others = others.filter(~((F.col("rid") == F.col("first_rid")) & (F.col("a") == F.col("first_a"))))
    others = others.select("rid", (F.col("a") + F.col("s")).alias("s"), (F.col("a") + F.col("e")).alias("e"))
    ranges = decided.filter("rid >= 0").select("rid", "s", "e").unionByName(others)
    return ranges.groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))


def merged(cuts: np.ndarray) -> np.ndarray:
    """Maximal removed runs of unmerged (s, e) ranges, as rows."""
    if not len(cuts):
        return np.zeros((0, 2), np.int64)
    cuts = cuts[np.argsort(cuts[:, 0], kind="stable")]
    end = np.maximum.accumulate(cuts[:, 1])
    first = np.r_[True, cuts[1:, 0] > end[:-1]]
    return np.stack([cuts[first, 0], end[np.r_[np.flatnonzero(first)[1:] - 1, len(cuts) - 1]]], 1)


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    """Remaining bytes and removed runs of each row of (text, cuts)."""
    col = batch.column(batch.schema.get_field_index("cuts"))
    offs, flat = col.offsets.to_numpy(), col.values
    pairs = np.stack([flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)], 1) if len(flat) else np.zeros((0, 2), np.int64)
    for k, v in enumerate(text_views(batch)):
        text, gone = bytes(v or b""), merged(pairs[offs[k] : offs[k + 1]])
        if len(gone):
            keep = np.r_[0, gone.ravel(), len(text)].reshape(-1, 2).tolist()
            text = b"".join(text[s:e] for s, e in keep)
        yield text, gone


def _joined(docs: DataFrame, keep: str) -> DataFrame:
    texts = _store(docs)
    none = F.array().cast("array<struct<s:long,e:long>>")
    out = texts.join(repeated_ranges(texts, keep).hint("shuffle_hash"), "rid", "left")
    return out.withColumn("cuts", F.coalesce("cuts", none))


def digest_repeats(docs: DataFrame, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of (doc_id,
    text). Null texts are empty; texts under LENGTH bytes lose nothing; equal rows
    are copies of one another; an empty table gives an empty result; other columns
    are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [len(v or b"") for v in text_views(batch)]
            left = [(hashlib.sha256(t).hexdigest(), len(t), len(g)) for t, g in _cut(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array([s - x[1] for s, x in zip(size, left, strict=True)], pa.int64()), pa.array([x[2] for x in left], pa.int64()), pa.array([x[0] for x in left], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), keep)
    return rows.select("doc_id", "text", "cuts").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, keep: str = "first") -> DataFrame:
    """The documents with their repeated passages cut out of `text`, other columns as
    they were, whatever their names. A code point that a cut goes through is dropped with
    it. With keep="first" the copy that is read first stays, rows in the order of the
    input's partitions. Null texts stay null, texts under LENGTH bytes as they are; null
    and repeated ids do no harm, equal rows are copies of one another; an empty table
    gives an empty result."""
    cols = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") if c != "text" else F.col(c) for k, c in enumerate(cols)])
    names = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nulls = batch.column(names.index("text")).is_null().to_pylist()
            text = pa.array([None if z else t.decode("utf-8", "ignore") for z, (t, _) in zip(nulls, _cut(batch), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([text if c == "text" else batch.column(k) for k, c in enumerate(names)], names=names)
            del text, batch
        give_back()

    out = _joined(plain, keep).select(*names, "cuts").mapInArrow(run, plain.schema)
    return out.toDF(*cols)
