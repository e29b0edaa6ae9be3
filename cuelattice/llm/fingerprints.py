"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text is the multiset of its lines ("paragraphs"). Each paragraph is hashed to
a wide vector and a document's fingerprint is the lane-wise sum:

* 4 lanes modulo 2**64, drawn from a 128-bit hash of the whole paragraph: equal sums
  mean equal multisets of paragraphs, in any order;
* 256 lanes modulo 2**32: every run of eight words of the paragraph, overlapping ones
  too (the whole of a shorter paragraph), adds +1 or -1 to one lane that its hash
  chooses. The squared length of the difference of two such sums estimates how many
  runs two documents do not share, which gives a likeness; its standard deviation is
  at most about 0.09.

Both parts are sums, so a paragraph is inserted or deleted by adding or
subtracting its own fingerprint (`combine`), without the rest of the text.
Defined results: null text counts as empty; the empty text is one empty
paragraph, so its fingerprint is that of ''.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MAX_BUCKETS, bucket_of, by_bytes, held, mix64, partitions, split_points

EXACT, LANES, RUN = 4, 256, 8
_BASE = 0x9E3779B97F4A7C15 | 1
_EXACT_SALT = mix64(np.arange(1, EXACT + 1, dtype=np.uint64) * np.uint64(_BASE))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
#: Texts are hashed in slices of about so many characters, to bound memory.
SLICE = 1_000_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""

    def make(size=1 << max(22, n.bit_length())):
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)

    got = held(("fingerprint powers",), make)
    return got if len(got[0]) >= n else make()


def _exact(paragraphs: list[list[str]]) -> np.ndarray:
    """Per document, the sum of the 4 lanes of its paragraphs."""
    size = np.array([len(p) for p in paragraphs])
    raw = b"".join(xxhash.xxh3_128_digest(x) for p in paragraphs for x in p)
    half = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)
    low, high = half[:, :1], half[:, 1:]
    lanes = mix64(mix64(low ^ _EXACT_SALT[None]) + high * (_EXACT_SALT[None] | np.uint64(1)))
    total = np.zeros((len(lanes) + 1, EXACT), np.uint64)
    np.cumsum(lanes, axis=0, out=total[1:])
    ends = np.cumsum(size)
    return total[ends] - total[ends - size]


def _lanes(paragraphs: list[list[str]]) -> np.ndarray:
    """Per document, the sum of its runs of words. Hashes of runs are differences of
    running sums over the bytes of all texts, words parted by one space."""
    texts = ["\n".join(" ".join(x.split()) for x in p).encode() for p in paragraphs]
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    out = np.zeros((len(texts), LANES), np.uint32)
    parting = (data == 32) | (data == 10)
    first = np.flatnonzero(~parting & np.r_[True, parting[:-1]])
    if not len(first):
        return out
    last = np.flatnonzero(~parting & np.r_[parting[1:], True]) + 1
    line = np.cumsum(data == 10)[first]
    leads = np.r_[True, line[1:] != line[:-1]]
    final = np.r_[np.flatnonzero(leads)[1:] - 1, len(first) - 1][np.cumsum(leads) - 1]  # last word of the line
    at = np.arange(len(first))
    run = np.flatnonzero(leads | (at + RUN - 1 <= final))
    begin, end = first[run], last[np.minimum(run + RUN - 1, final[run])]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    h = mix64((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(_BASE))
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, side="right")
    cell = doc * LANES + (h >> np.uint64(56)).astype(np.int64)
    sign = np.where(h & np.uint64(1), 1.0, -1.0)
    return np.bincount(cell, weights=sign, minlength=out.size).reshape(out.shape).astype(np.int64).astype(np.uint32)


def fingerprint_arrays(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n, 4) uint64 and (n, 256) uint32 for the given texts."""
    exact, lanes = [np.zeros((0, EXACT), np.uint64)], [np.zeros((0, LANES), np.uint32)]
    for lo, hi in by_bytes(texts, SLICE):
        paragraphs = [t.split("\n") for t in texts[lo:hi]]
        exact.append(_exact(paragraphs))
        lanes.append(_lanes(paragraphs))
    return np.concatenate(exact), np.concatenate(lanes)


def to_hex(exact: np.ndarray, lanes: np.ndarray) -> list[str]:
    """Big-endian lanes in hexadecimal: 64 + 2048 digits."""
    raw = np.concatenate([exact.astype(">u8").view(np.uint8), lanes.astype(">u4").view(np.uint8)], axis=1)
    return [r.tobytes().hex() for r in raw]


def from_hex(fp: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fp)
    return np.frombuffer(raw[: 8 * EXACT], ">u8").astype(np.uint64), np.frombuffer(raw[8 * EXACT :], ">u4").astype(np.uint32)


def combine(a: str, b: str, sign: int = 1) -> str:
    """Fingerprint of a's multiset with b's added (sign=1) or removed (sign=-1)."""
    (ea, la), (eb, lb) = from_hex(a), from_hex(b)
    return to_hex(*((x + y if sign > 0 else x - y)[None] for x, y in ((ea, eb), (la, lb))))[0]


def likeness(exact_a, lanes_a, exact_b, lanes_b) -> np.ndarray:
    """1 for equal fingerprints; otherwise one less the ratio of the squared
    length of the difference to the sum of both squared lengths, within 0 and 1."""
    a, b = lanes_a.view(np.int32).astype(np.float64), lanes_b.view(np.int32).astype(np.float64)
    d = (lanes_a - lanes_b).view(np.int32).astype(np.float64)
    both = (a * a).sum(1) + (b * b).sum(1)
    near = 1.0 - (d * d).sum(1) / np.where(both > 0, both, 1.0)
    same = (exact_a == exact_b).all(1) & (lanes_a == lanes_b).all(1)
    return np.where(same, 1.0, np.where(both > 0, np.clip(near, 0.0, 1.0), 0.0))


def fingerprint(text: Column) -> Column:
    """Column form: the fingerprint of each text."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(to_hex(*fingerprint_arrays([t or "" for t in texts])))

    return F.pandas_udf(run, "string")(text)


def with_next(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """Deal documents into buckets of ascending doc_id so that each bucket also
    holds, marked `_guest`, the first document of the bucket that follows (of the
    first bucket, for the last one), sorted within partitions. Texts move once;
    the driver sees one id per bucket (at most MAX_BUCKETS)."""
    n = min(MAX_BUCKETS, partitions(docs.sparkSession) * per_partition)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    splits = split_points(ids, "doc_id", n)
    bucket = bucket_of(F.col("doc_id"), splits)
    firsts = sorted((r[0], r[1]) for r in ids.groupBy(bucket.alias("b")).agg(F.min("doc_id")).collect())
    before = {b: firsts[i - 1][0] for i, (b, _) in enumerate(firsts)}
    n_b = len(splits) + 1
    first_of = F.array(*[F.lit(dict(firsts).get(b)).cast("long") for b in range(n_b)])
    home = F.array(*[F.lit(before.get(b, b)) for b in range(n_b)])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", bucket.alias("_b"))
    leads = F.col("doc_id").eqNullSafe(F.element_at(first_of, F.col("_b") + 1))
    here = F.struct(F.col("_b").alias("b"), F.lit(False).alias("guest"))
    there = F.struct(F.element_at(home, F.col("_b") + 1).alias("b"), F.lit(True).alias("guest"))
    rows = rows.withColumn("_at", F.explode(F.when(leads, F.array(here, there)).otherwise(F.array(here))))
    rows = rows.select("doc_id", "text", F.col("_at.b").alias("_bucket"), F.col("_at.guest").alias("_guest"))
    return rows.repartition(n, "_bucket").sortWithinPartitions("_bucket", "_guest", F.asc_nulls_last("doc_id"), F.asc_nulls_first("text"))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def out(ids, texts):
        """texts has one more than ids: the text after the last."""
        for lo, hi in by_bytes(texts[:-1], SLICE):
            own, nxt = texts[lo:hi], texts[lo + 1 : hi + 1]
            new = [edited(a, b) for a, b in zip(own, nxt, strict=True)]
            e, l = fingerprint_arrays(own + [texts[hi]])
            ee, el = fingerprint_arrays(new)
            yield pd.DataFrame({
                "doc_id": pd.array(ids[lo:hi], dtype="Int64"), "n_chars": [len(t) for t in own],
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in new],
                "fingerprint": to_hex(e[:-1], l[:-1]), "edited_fingerprint": to_hex(ee, el),
                "near_edited": likeness(e[:-1], l[:-1], ee, el), "near_next": likeness(e[:-1], l[:-1], e[1:], l[1:]),
            })

    bucket, ids, texts, done = None, [], [], False
    for pdf in batches:
        for b, guest, i, t in zip(pdf["_bucket"].tolist(), pdf["_guest"].tolist(), pdf["doc_id"].astype("Int64").tolist(), pdf["text"].tolist(), strict=True):
            if b != bucket:
                bucket, ids, texts, done = b, [], [], False
            if done:  # another document with the id of the guest
                continue
            texts.append(t or "")
            if guest:
                yield from out(ids, texts)
                done = True
            else:
                ids.append(None if i is pd.NA else i)
        if not done and len(texts) > 1:
            yield from out(ids[:-1], texts)
            ids, texts = ids[-1:], texts[-1:]


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> SCHEMA, one row per input row: the document's
    fingerprint, that of its edited text, and likenesses.

    Documents are in ascending doc_id, null ids last, equal ids by text; a single
    document is followed by itself; an empty table gives an empty result; other
    columns are ignored.
    """
    return with_next(docs).mapInPandas(_run, SCHEMA)
