"""Ordered folds whose groups may be large: a group is cut in ranges of consecutive rows,
each with what it needs to know of the rows before, so that no task holds a group.

Rows of a range reach one task in order and are read as a stream; a task keeps a few
numbers, whatever the range's size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Runs are cut at so many run numbers, rows at so many rows.
RANGE = 8_192
#: Decisions up to this many (24 bytes each) are sent to all executors.
BROADCAST = 1_000_000
#: Before everything; no time in milliseconds is that early.
NEVER = -(2**62)
FOREVER = 2**62


def in_order(rows: DataFrame, keys: list[str], order: list[str], step: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of equal keys reach one task, in order; step reads a task's rows as tuples, in
    the columns' order, nulls as None, and yields output rows. Rows are dealt by a hash of
    the keys, not by the keys: an exchange by the keys themselves is left out where a join
    has made one, and a join that turns into a broadcast then deals rows out otherwise."""
    names = [c.split()[0] for c in schema.split(",")]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def tuples() -> Iterator[tuple]:
            for pdf in pdfs:
                columns = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in pdf.columns]
                yield from zip(*columns, strict=True)

        out = []
        for row in step(tuples()):
            out.append(row)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return rows.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


# The furthest end. A run of disputed words sees the furthest end f before it, takes in the
# undisputed end b, goes back to the provider where that is possible and max(f, b) <= t,
# and leaves max(f, b, p) then, max(f, b, a) otherwise. As a function of f that is
# max(f, c) with one c up to t and another beyond it. Such functions, with more pieces,
# stay of this kind when composed: pieces are (up to which f, c), in ascending order.


def _chosen(may: bool, f: int, b: int, t: int) -> bool:
    return may and max(f, b) <= t


def compose(pieces: list[tuple[int, int]], low: int, may: bool, t: int, b: int, p: int, a: int) -> list[tuple[int, int]]:
    """The pieces after one more run; f is above `low` in the first one."""
    out: list[tuple[int, int]] = []
    for high, c in pieces:
        c = max(c, b)
        if may and c <= t and low < t < high:
            parts = [(t, max(c, p)), (high, max(c, a))]
        else:
            parts = [(high, max(c, p) if may and c <= t and high <= t else max(c, a))]
        for part in parts:
            if out and out[-1][1] == part[1]:
                out.pop()
            out.append(part)
        low = high
    return out


def at(pieces: list[tuple[int, int]], f: int) -> int:
    return max(f, next(c for high, c in pieces if f <= high))


_RUN = ["programme_id", "_range", "_run", "_may", "t", "before", "prov_max", "aligned_max"]


def _numbers(row: tuple) -> tuple[bool, int, int, int, int]:
    may, t, b, p, a = row
    never = lambda x: NEVER if x is None else int(x)
    return bool(may), FOREVER if t is None else int(t), never(b), never(p), never(a)


def _composed(rows: Iterator[tuple]) -> Iterator[tuple]:
    key, pieces, low = None, [], NEVER
    for programme, range_, _, may, t, b, p, a, low_, high_ in rows:
        if (programme, range_) != key:
            if key:
                yield (*key, [x[0] for x in pieces], [x[1] for x in pieces])
            # No f outside what earlier runs can leave, whatever they choose.
            key, low = (programme, range_), NEVER if low_ is None else int(low_) - 1
            pieces = [(NEVER if high_ is None else int(high_), NEVER)]
        pieces = compose(pieces, low, *_numbers((may, t, b, p, a)))
    if key:
        yield (*key, [x[0] for x in pieces], [x[1] for x in pieces])


def _entered(rows: Iterator[tuple]) -> Iterator[tuple]:
    programme, f = [], NEVER
    for p, range_, high, c in rows:
        programme, f = p, f if p == programme else NEVER
        yield p, range_, f
        f = at(list(zip(map(int, high), map(int, c), strict=True)), f)


def _decided(rows: Iterator[tuple]) -> Iterator[tuple]:
    key, f = None, NEVER
    for programme, range_, run, may, t, b, p, a, aligned_ok, f_in in rows:
        if (programme, range_) != key:
            key, f = (programme, range_), NEVER if f_in is None else int(f_in)
        may, t, b, p, a = _numbers((may, t, b, p, a))
        back = _chosen(may, f, b, t)
        f = max(f, b)
        seen, f = f, max(f, p if back else a)
        yield programme, run, aligned_ok, back, None if seen == NEVER else seen, None if f == NEVER else f


def furthest_end(runs: DataFrame, programme_type: str, ranges: bool, size: int = RANGE, left: bool = False) -> DataFrame:
    """runs (programme_id, _run, aligned_ok, prov_ok, t, before, prov_max, aligned_max) ->
    programme_id, _run, aligned_ok, restored, f_in: what each run decides, in order of
    _run, and the furthest end it saw; left: also f_out, the one it leaves. A null t is no limit. ranges: whether any _run reaches
    `size`; then each range of runs is composed to one function of the end it starts from,
    these are applied one after the other, a row a range, and all ranges are decided at
    once, each from its own start."""
    r = runs.withColumns({"_range": F.floor(F.col("_run") / size), "_may": F.col("prov_ok") & ~F.col("aligned_ok")})
    start = F.lit(None).cast("long")
    if ranges:
        sure, possible = F.when(F.col("_may"), F.least("prov_max", "aligned_max")).otherwise(F.col("aligned_max")), F.when(F.col("_may"), F.greatest("prov_max", "aligned_max")).otherwise(F.col("aligned_max"))
        ends = r.groupBy("programme_id", "_range").agg(F.max(F.greatest("before", sure)).alias("_low"), F.max(F.greatest("before", possible)).alias("_high"))
        earlier = Window.partitionBy("programme_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select("programme_id", "_range", F.max("_low").over(earlier).alias("_low"), F.max("_high").over(earlier).alias("_high"))
        pieces = in_order(r.select(*_RUN).join(ends, ["programme_id", "_range"]).select(*_RUN, "_low", "_high"), ["programme_id", "_range"], ["_run"], _composed, f"programme_id {programme_type}, _range bigint, high array<bigint>, c array<bigint>")
        starts = in_order(pieces, ["programme_id"], ["_range"], _entered, f"programme_id {programme_type}, _range bigint, _start bigint")
        r, start = r.join(starts, ["programme_id", "_range"]), F.col("_start")
    out = in_order(r.select(*_RUN, "aligned_ok", start.alias("_start")), ["programme_id", "_range"], ["_run"], _decided, f"programme_id {programme_type}, _run bigint, aligned_ok boolean, restored boolean, f_in bigint, f_out bigint")
    return out if left else out.drop("f_out")


# The furthest row. A row that ends after all before it becomes the furthest one whatever
# happened before, since repairs only pull ends back: a fold may start there.


def _overlaps(most: int, least: int):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, end = None, None
        for programme, cluster, block, start_ms, end_ms, index, last_word in rows:
            if (programme, cluster, block) != key:
                key, end = (programme, cluster, block), None
            if end is not None and start_ms is not None and end - start_ms > least:
                over = end - start_ms
                fix = over <= most and start_ms > start and word < start_ms
                yield programme, index, other, over, fix
                end = start_ms if fix else end
            if end is None or (end_ms is not None and end_ms > end):
                start, end, other, word = start_ms, end_ms, index, last_word

    return step


def furthest_row(rows: DataFrame, programme_type: str, least: int, most: int, size: int = RANGE) -> DataFrame:
    """rows (programme_id, cluster, start_ms, end_ms, sequence_index, last_word_start) ->
    programme_id, sequence_index, other_index, overlap_ms, repaired: each row that begins more
    than `least` before the furthest earlier row of its speaker ends. An overlap of at most
    `most` that erases no word pulls that end back. A speaker's rows are cut in blocks of
    about `size`, at rows that end after all before them; such a row is the last one of its
    block, where its own overlap is found, and the first one of the next."""
    order = ["start_ms", "end_ms", "sequence_index", "_word"]
    r = rows.select("programme_id", "cluster", "start_ms", "end_ms", "sequence_index", F.coalesce("last_word_start", F.lit(-1)).cast("long").alias("_word"))
    by = Window.partitionBy("programme_id", "cluster").orderBy(*order)
    further = F.coalesce(F.col("end_ms") > F.max("end_ms").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    r = r.withColumn("_further", further & F.col("end_ms").isNotNull()).withColumn("_n", F.row_number().over(by))
    r = r.withColumn("_block", F.coalesce(F.max(F.when(F.col("_further"), F.floor(F.col("_n") / size))).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    r = r.withColumn("_before", F.coalesce(F.lag("_block").over(by), F.col("_block")))
    r = r.withColumn("_block", F.explode(F.array_distinct(F.array("_before", "_block"))))
    cut = r.select("programme_id", "cluster", "_block", "start_ms", "end_ms", "sequence_index", "_word")
    return in_order(cut, ["programme_id", "cluster", "_block"], order, _overlaps(most, least), f"programme_id {programme_type}, sequence_index bigint, other_index bigint, overlap_ms bigint, repaired boolean")
