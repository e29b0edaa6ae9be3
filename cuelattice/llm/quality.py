"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of numeric features, computed once for the whole table
and kept as a narrow table. The model is the sum of one lookup table per feature
and one per chosen pair of features, all learned by cyclic boosting: round after
round each table in turn gets a shallow tree (up to three splits on a feature; one
split on either feature of a pair) fitted to the gradient of the logistic loss, times a
small rate. Scoring adds up table cells by bin number.

Bound: the model is fitted on at most FIT_ROWS labelled rows, chosen by the hash
of their id. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_views

FIT_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 12, 10
ROUNDS, PAIR_ROUNDS, RATE, PAIR_RATE = 120, 60, 0.15, 0.1

FEATURES = [
    "log_bytes", "log_words", "mean_word", "upper", "lower", "digit", "high", "stop", "comma", "bang", "pipe", "symbol", "quote", "bracket",
    "dash", "other", "lines", "distinct_words", "distinct_lines", "top_line", "short_words", "long_words", "mean_line", "capital_words", "end_marks", "repeats",
]

_CLASS = np.full(256, 9)
for _k, _chars in enumerate(["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "", ".", ",;:", "!?", "|/\\_", "#$%&*@+=<>^~", "\"'`", "()[]{}", "-", " \t\n\r\x0b\x0c"]):
    for _c in _chars:
        _CLASS[ord(_c)] = _k if _k < 9 else _k + 1
_CLASS[128:] = 3
_N_CLASS = 14


def text_features(text: bytes) -> list[float]:
    """FEATURES of one UTF-8 text; the empty text has zeros throughout."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    share = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(text, np.uint8), minlength=256), minlength=_N_CLASS) / n
    words, lines = text.split(), text.split(b"\n")
    w, m = max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    seen = set(words)
    counts: dict[bytes, int] = {}
    for x in lines:
        counts[x] = counts.get(x, 0) + 1
    caps = sum(x[:1].isupper() for x in words)
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines)
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        np.log1p(n), np.log1p(len(words)), sizes.mean() if len(words) else 0.0, share[0], share[1], share[2], share[3], share[4], share[5], share[6],
        share[7], share[8], share[10], share[11], share[12], share[9], m / n * 1000, len(seen) / w, len(counts) / m, max(counts.values()) / m,
        (sizes <= 3).sum() / w, (sizes >= 12).sum() / w, np.log1p(n / m), caps / w, ends / m, repeats / w,
    ]


def features(docs: DataFrame) -> DataFrame:
    """doc_id and FEATURES (float) of every text, null as empty."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_features(bytes(v or b"")) for v in text_views(batch)], dtype=np.float32).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in np.ascontiguousarray(x.T))], names=["doc_id", *FEATURES])

    schema = "doc_id long, " + ", ".join(f"{f} float" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


class AdditiveModel:
    """Bias, bin edges, a table per feature, and tables for pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        d = x.shape[1]
        self.edges = [_edges(x[:, j], BINS) for j in range(d)]
        self.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(d)]
        self.tables, self.pairs = np.zeros((d, BINS)), []
        rate = (y.sum() + 1) / (len(y) + 2)
        self.bias = float(np.log(rate / (1 - rate)))
        b, margin = self._bins(x, self.edges), np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            for j in range(d):
                g, h = _gradient(margin, y)
                step = RATE * _stump(np.bincount(b[j], g, BINS), np.bincount(b[j], h, BINS))
                self.tables[j] += step
                margin += step[b[j]]
        c = self._bins(x, self.coarse)
        g, h = _gradient(margin, y)
        gain = {(i, j): _corner(*_square(c, i, j, g, h))[1] for i in range(d) for j in range(i)}
        for i, j in sorted(gain, key=gain.get)[-PAIRS:][::-1]:
            self.pairs.append((i, j, np.zeros((PAIR_BINS, PAIR_BINS))))
        for _ in range(PAIR_ROUNDS):
            for i, j, t in self.pairs:
                g, h = _gradient(margin, y)
                step = PAIR_RATE * _corner(*_square(c, i, j, g, h))[0]
                t += step
                margin += step[c[i], c[j]]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: vectorised additions of table cells."""
        margin = np.full(len(x), self.bias)
        for t, b in zip(self.tables, self._bins(x, self.edges), strict=True):
            margin += t[b]
        c = self._bins(x, self.coarse) if self.pairs else []
        for i, j, t in self.pairs:
            margin += t[c[i], c[j]]
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _gradient(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))
    return y - p, p * (1 - p) + 1e-6


def _value(g, h):
    return g / (h + 5.0)


def _stump(g: np.ndarray, h: np.ndarray, splits: int = 3) -> np.ndarray:
    """Leaf values by bin of a shallow tree: the best split, then that of each side."""
    out = np.zeros(len(g))

    def grow(lo, hi, depth):
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        left = cg[:-1] ** 2 / (ch[:-1] + 5.0) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 5.0)
        if depth and len(left) and left.max() > cg[-1] ** 2 / (ch[-1] + 5.0) + 1e-9:
            at = lo + 1 + int(left.argmax())
            grow(lo, at, depth - 1)
            grow(at, hi, depth - 1)
        else:
            out[lo:hi] = _value(cg[-1], ch[-1])

    grow(0, len(g), 2 if splits > 1 else 1)
    return out


def _square(c, i, j, g, h):
    cell = c[i] * PAIR_BINS + c[j]
    n = PAIR_BINS**2
    return np.bincount(cell, g, n).reshape(PAIR_BINS, -1), np.bincount(cell, h, n).reshape(PAIR_BINS, -1)


def _corner(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Best cut of the square into four by one split on each feature: values by
    cell, and the gain over no cut."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b, t = G[:-1, :-1], H[:-1, :-1], (G[-1, -1], H[-1, -1])
    right, low = (G[:-1, -1:] - a, H[:-1, -1:] - b), (G[-1:, :-1] - a, H[-1:, :-1] - b)
    rest = (t[0] - a - right[0] - low[0], t[1] - b - right[1] - low[1])
    quads = [(a, b), right, low, rest]
    gain = sum(x**2 / (y + 5.0) for x, y in quads) - t[0] ** 2 / (t[1] + 5.0)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.empty_like(g)
    for (x, y), rows, cols in zip(quads, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None)) * 2, strict=True):
        out[rows, cols] = _value(x[i, j], y[i, j])
    return out, float(gain[i, j])


def train(feats: DataFrame, labels: DataFrame, column: str = "quality") -> AdditiveModel:
    """Fit on rows that have a label 0 or 1 and are not held out. Several labels
    of a document count as that many rows. Without any row the model is constant."""
    usable = labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("_y"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(FIT_ROWS)
    rows = feats.join(sample, "doc_id").orderBy(F.xxhash64("doc_id", *FEATURES), "doc_id", "_y").limit(2 * FIT_ROWS)  # more only where ids repeat
    rows = rows.toPandas().sort_values(["doc_id", "_y", *FEATURES])
    return AdditiveModel(rows[FEATURES].to_numpy(np.float32), rows["_y"].to_numpy(float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of (doc_id, text).

    Null texts count as empty; rows may repeat; without labels every score is 0.5;
    an empty table gives an empty result; other columns are ignored."""
    feats = materialise(features(docs), "quality-features")
    sent = docs.sparkSession.sparkContext.broadcast(train(feats, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": sent.value.score(pdf[FEATURES].to_numpy(np.float32))})

    out = feats.mapInPandas(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
