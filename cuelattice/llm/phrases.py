"""Phrase collocation mining by dynamic itemset counting.

The table is dealt into SHARDS shards, scanned in turn, over and over. Words are counted
from the first scan on. As soon as both parts of a phrase (all but its last, all but its
first word) have been seen LEAST times, the phrase is active from the next scan, and it is
counted for exactly one cycle, so that its count is whole wherever it began. Lengths thus
interleave: while late words are still counted, early phrases of three words are too.

What tasks must know is when a phrase became active, which follows from when its parts
reached the threshold. That is kept in a table of one byte for each slot, a phrase's hash
naming its slot; a slot keeps the step that was first put into it. Phrases that share a
slot may make one active that needn't be, or sooner, but consistently so: it is counted for
one whole cycle all the same, and the threshold decides. So the table's size bounds memory
and changes work, never results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, mix64, release, text_views

LEAST, LONGEST, TOP, PERCENT = 100, 5, 2_000, 100
SHARDS = 2
#: A chunk ends with the text that fills it to so many bytes; those open in a task hold so many together.
CHUNK, OPEN = 2 << 20, 16 << 20
#: Slots of the table of steps: SPREAD for each phrase there can be, within these bounds.
LEAST_SLOTS, MOST_SLOTS, SPREAD = 1 << 16, 1 << 24, 1
#: Keys that are put together at once.
KEYS = 250_000
#: Deletes a step's shuffle files once the step is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A language's last ranking takes the best of so many parts.
RANK_PARTS = 64

_BREAK, _NONE = b"\n", b""
_FOLD = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_CHUNKS = "lang string, shard int, n_words long, words array<string>, ids binary"
#: A counted phrase is one text, so that little is shuffled: the step since when it is active
#: as a character from FIRST on, the language, a tab, the words joined by spaces.
_COUNTS, FIRST = "key string, a long", 33


def _number(n_words: int) -> str:
    """Type of a chunk's numbers: two bytes each where they are enough."""
    return "<u2" if n_words < 1 << 16 else "<i4"


class _Chunk:
    """Texts of one language as word numbers: 0 ends a piece, words count from 1, in their
    order once the chunk is closed."""

    def __init__(self):
        numbers = count()
        self.number = defaultdict(numbers.__next__)
        self.number[_BREAK], self.number[_NONE]
        self.parts, self.bytes = [], 0

    def add(self, text: memoryview) -> None:
        tokens = bytes(text).lower().translate(_FOLD).replace(_BREAK, b" \n ").split(b" ")
        ids = np.fromiter(map(self.number.__getitem__, tokens), np.int32, len(tokens))
        ids = ids[ids != 1]
        self.parts += [np.maximum(ids - 1, 0), np.zeros(1, np.int32)]
        self.bytes += len(text)

    def row(self, lang: str, shard: int) -> tuple:
        words = list(self.number)[2:]
        order = sorted(range(len(words)), key=words.__getitem__)
        place = np.zeros(len(words) + 1, "<i4")
        place[np.array(order, np.int64) + 1] = np.arange(1, len(words) + 1)
        ids = place[np.concatenate(self.parts)]
        return lang, shard, int(np.count_nonzero(ids)), [words[i] for i in order], ids.astype(_number(len(words))).tobytes()


def _chunks(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, open_, held = count(TaskContext.get().partitionId()), {}, 0

        def close(lang: str) -> pa.RecordBatch:
            lang, shard, n, words, ids = open_.pop(lang).row(lang, next(turn) % shards)
            words = pa.array(words, pa.binary()).cast(pa.string())
            words = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([shard], pa.int32()), pa.array([n], pa.int64()), words, pa.array([ids], pa.binary())], ["lang", "shard", "n_words", "words", "ids"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, text_views(batch), strict=True):
                if text is not None and len(text):
                    chunk = open_.setdefault(lang, _Chunk())
                    chunk.add(text)
                    held += len(text)
                    if chunk.bytes < CHUNK and held > OPEN:
                        lang, chunk = max(open_.items(), key=lambda x: x[1].bytes)
                    if chunk.bytes >= CHUNK or held > OPEN:
                        held -= chunk.bytes
                        yield close(lang)
        for lang in list(open_):
            yield close(lang)

    return run


def cut_in_chunks(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Texts in lower case (A-Z only), in chunks of one language, dealt into shards."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    return texts.mapInArrow(_chunks(shards), _CHUNKS)


def _began() -> Column:
    return F.ascii("key") - FIRST


def _phrase() -> Column:
    return F.substring_index("key", "\t", -1)


def _lang() -> Column:
    return F.expr("substring(key, 2, length(key) - length(substring_index(key, '\\t', -1)) - 2)")


def _n_words() -> Column:
    return F.size(F.split(_phrase(), " "))


def _slots(mask: int):
    """The slot of each phrase of (lang, phrase), by the hash that chunks use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch), np.uint64)
            for i, (lang, phrase) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                seed = xxhash.xxh64_intdigest(lang)
                h = np.array([xxhash.xxh64_intdigest(w, seed) for w in phrase.split(" ")], np.uint64)
                out[i] = reduce(_joined, (h[k : k + 1] for k in range(len(h))))[0]
            yield pa.RecordBatch.from_arrays([pa.array((out & np.uint64(mask)).astype(np.int64))], ["slot"])

    return run


def _joined(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word, and the last word's."""
    return mix64(h * np.uint64(0x9E3779B97F4A7C15) + last)


def _active(words: list[str], ids: np.ndarray, lang: str, steps: np.ndarray, step: int, shards: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Phrases of a chunk that are counted in this step: for each length, where each distinct
    one first stands, since when it is active, its count."""
    seed, mask = xxhash.xxh64_intdigest(lang), np.uint64(len(steps) - 1)
    hashes = np.array([0, *[xxhash.xxh64_intdigest(w, seed) for w in words]], np.uint64)
    if step < shards:
        n = np.bincount(ids, minlength=len(hashes))
        first = np.empty(len(hashes), np.int64)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
        yield 1, first[1:], np.zeros(len(words), np.int32), n[1:]
    # Step since when longer phrases may hold the word; a break, like a word below the threshold, holds none.
    since = steps[(hashes & mask).astype(np.int64)]
    since[0] = 0
    since = since[ids]
    at = np.flatnonzero((since[:-1] > 0) & (since[1:] > 0))
    began = np.maximum(since[at], since[at + 1])
    h = _joined(hashes[ids[at]], hashes[ids[at + 1]])
    for length in range(2, longest + 1):
        now = np.flatnonzero(step - began.astype(np.int32) < shards)
        if len(now):
            _, where, n = np.unique(h[now], return_index=True, return_counts=True)
            yield length, at[now[where]], began[now[where]].astype(np.int32), n
        if length == longest or not len(at):
            return
        since = steps[(h & mask).astype(np.int64)]
        # A slot may be older than the phrase is active; it holds longer ones only since both.
        since = np.where(since > 0, np.maximum(since, began), since)
        pair = np.flatnonzero((at[1:] == at[:-1] + 1) & (since[:-1] > 0) & (since[1:] > 0))
        began = np.maximum(since[pair], since[pair + 1])
        at, h = at[pair], _joined(h[pair], hashes[ids[at[pair] + length]])


def _keys(words: pa.Array, ids: np.ndarray, lang: str, length: int, first: np.ndarray, began: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keys and counts of a chunk's phrases, in order of their first three words as far as 64
    bits tell them: what begins alike lies together, so that shuffle files are small."""
    place = began.astype(np.uint64)
    for k in range(3):
        place = place * np.uint64(len(words) + 1) + (ids[first + k].astype(np.uint64) if k < length else np.uint64(0))
    order = np.argsort(place, kind="stable")
    join = pa.compute.binary_join_element_wise
    for lo in range(0, len(order), KEYS):
        some = order[lo : lo + KEYS]
        steps, of = np.unique(began[some], return_inverse=True)
        heads = pa.array([f"{chr(FIRST + b)}{lang}\t" for b in steps.tolist()], pa.string())
        said = [words.take(pa.array(ids[first[some] + k] - 1)) for k in range(length)]
        keys = join(join(heads.take(pa.array(of)), said[0], ""), *said[1:], " ") if length > 1 else join(heads.take(pa.array(of)), said[0], "")
        yield pa.RecordBatch.from_arrays([keys, pa.array(n[some], pa.int64())], ["key", "a"])


def _scan(steps, step: int, shards: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in zip(batch.drop_columns("words").to_pylist(), batch.column("words"), strict=True):
                words, ids = words.values, np.frombuffer(row["ids"], _number(len(words.values))).astype(np.int32)
                for length, first, began, n in _active(words.to_pylist(), ids, row["lang"], steps.value, step, shards, longest):
                    yield from _keys(words, ids, row["lang"], length, first, began, n)

    return run


def frequent(chunks: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """chunks, as a written table, -> lang, words, phrase, a of every phrase of up to
    `longest` words that stands `least` times or more, with its whole count, written too.
    Counting ends one cycle after the last phrase that a longer one could hold reached the
    threshold, so after `longest` cycles at most. A step's shuffle files go when it is written."""
    if longest * shards > 90:
        raise ValueError("longest * shards must be 90 at most")
    spark = chunks.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return _frequent(chunks, least, longest, shards)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _frequent(chunks: DataFrame, least: int, longest: int, shards: int) -> DataFrame:
    spark = chunks.sparkSession
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    slots = 1 << (min(max(longest * (total // least + 1) * SPREAD, LEAST_SLOTS), MOST_SLOTS) - 1).bit_length()
    steps, tables, step, last = np.zeros(slots, np.uint8), [], 0, shards - 1
    while step <= last:
        known = spark.sparkContext.broadcast(steps)
        found = chunks.filter(F.col("shard") == step % shards).mapInArrow(_scan(known, step, shards, longest), _COUNTS)
        if tables:
            found = found.unionByName(tables[-1].filter(_began() > step - shards))
        found = found.groupBy("key").agg(F.sum("a").alias("a"))
        # What has been counted for a cycle and stays below the threshold goes.
        tables.append(materialise(found.filter((_began() > step + 1 - shards) | (F.col("a") >= least)), "phrase-counts", codec="zstd"))
        known.destroy()
        # Slots of what reached the threshold before are set already, and stay as they are.
        reached = tables[-1].filter((F.col("a") >= least) & (_n_words() < longest)).select(_lang().alias("lang"), _phrase().alias("phrase"))
        slot = reached.mapInArrow(_slots(slots - 1), "slot long").distinct().toArrow().column(0).to_numpy()
        slot = slot[steps[slot] == 0]
        if len(slot):
            steps = steps.copy()
            steps[slot] = step + 1
            last = max(last, step + shards)
        step += 1
    whole = [t.filter(_began() == i + 1 - shards).select(_lang().alias("lang"), _n_words().alias("words"), _phrase().alias("phrase"), "a") for i, t in enumerate(tables)]
    out = materialise(reduce(DataFrame.unionByName, whole), "phrase-frequent")
    release(*tables)
    return out


def weakest_cuts(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with the parts' counts and the score of their lowest-scoring cut, the
    first of equal ones. Numerator and denominator are decimals of 38 digits."""
    said = F.split("phrase", " ")
    cut = phrases.filter("words > 1").withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cut = cut.withColumn("_left", F.array_join(F.slice(said, F.lit(1), F.col("k")), " ")).withColumn("_right", F.array_join(F.slice(said, F.col("k") + 1, F.col("words")), " "))
    for side, n in (("_left", "l"), ("_right", "r")):
        cut = cut.join(phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(n)), ["lang", side])
    cut = cut.join(totals, "lang")
    d = lambda c: f"cast({c} as decimal(19,0))"
    cut = cut.withColumn("score", F.expr(f"(cast(1000 as decimal(4,0)) * {d('a')} * {d('n')}) div ({d('l')} * {d('r')})"))
    low = cut.groupBy("lang", "words", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_low"))
    return low.select("lang", "words", "phrase", "a", "n", "_low.score", "_low.l", "_low.r")


def without_parts(candidates: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Candidates that no longer one holds with at least `percent` hundredths of their count."""
    said = F.split("phrase", " ")
    held = candidates.filter("words > 2").withColumn("_n", F.explode(F.expr("sequence(2, words - 1)"))).withColumn("_at", F.explode(F.expr("sequence(1, words - _n + 1)")))
    held = held.select("lang", F.array_join(F.slice(said, F.col("_at"), F.col("_n")), " ").alias("phrase"), F.col("a").alias("_longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    return candidates.join(held, ["lang", "phrase"], "left").filter(F.expr(f"_longer is null or 100 * _longer < {percent}L * a")).drop("_longer")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, shards: int = SHARDS) -> DataFrame:
    """(text, lang, ...) -> lang, rank, phrase, a, l, r, n, score: each language's first
    `top` phrases of 2 to `longest` words by score, then count, then UTF-8 bytes.

    Null texts are empty, null languages are `und`; repeated rows count as often as they
    stand; a text of any length is one chunk at most; an empty table, or one without a
    frequent phrase, gives an empty result. Other columns are ignored, whatever their names.
    """
    chunks = materialise(cut_in_chunks(docs, shards), "phrase-chunks", by="shard", codec="zstd")
    phrases = frequent(chunks, least, longest, shards)
    totals = materialise(chunks.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
    release(chunks)
    kept = without_parts(materialise(weakest_cuts(phrases, totals), "phrase-scores"), percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in (["lang", F.pmod(F.hash("phrase"), F.lit(RANK_PARTS))], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return kept.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
