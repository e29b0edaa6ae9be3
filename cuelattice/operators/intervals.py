"""Interval joins by time nodes: equality on (programme, level, node), then the exact
predicate. Work stays near-linear and no nested loop over a programme arises.

A span lies at the level whose nodes are wide enough for eight of them to hold it, so it
covers nine nodes at most, however long it is. What is looked up goes to the nodes it
touches at each level that spans lie at, most often one. Where that is long itself, it goes
to its own level and coarser ones only, and meets finer spans where those are lifted to its
level: a span then makes 21 rows at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_MS = 10_000
#: Widths of the levels; spans beyond eight of the last one (240 days) cover more nodes.
WIDTHS = tuple(BUCKET_MS * 8**k for k in range(7))


def _nodes(level: int, start: Column, end: Column, lifted: bool = False) -> Column:
    width = WIDTHS[level]
    at = F.sequence(F.floor(start / width), F.floor(F.greatest(start, end) / width))
    return F.transform(at, lambda n: F.struct(F.lit(level).alias("level"), n.alias("node"), F.lit(lifted).alias("lifted")))


def level(start: Column, end: Column) -> Column:
    k = F.lit(len(WIDTHS) - 1)
    for at in range(len(WIDTHS) - 2, -1, -1):
        k = F.when(end - start <= 8 * WIDTHS[at], at).otherwise(k)
    return k


def _explode(rows: DataFrame, parts: list[tuple[Column, Column]]) -> DataFrame:
    """rows once for each node of the parts whose condition holds."""
    none = F.array().cast("array<struct<level:int,node:bigint,lifted:boolean>>")
    at = F.flatten(F.array(*[F.when(condition, nodes).otherwise(none) for condition, nodes in parts]))
    return rows.withColumn("_at", F.explode(at)).select(*rows.columns, "_at.level", "_at.node", "_at.lifted")


def cover(spans: DataFrame, start: str, end: str, lift: bool = False) -> DataFrame:
    """spans once for each node they cover, and with `lift` at each coarser level too."""
    s, e = F.col(start), F.col(end)
    own = level(s, e)
    parts = [(own == k, _nodes(k, s, e)) for k in range(len(WIDTHS))]
    return _explode(spans, parts + [(own < k, _nodes(k, s, e, True)) for k in range(1, len(WIDTHS)) if lift])


def levels_of(spans: DataFrame, start: str, end: str) -> list[int]:
    """Levels that spans lie at, seven at most."""
    return sorted(r[0] for r in spans.select(level(F.col(start), F.col(end)).alias("k")).distinct().collect()) or [0]


def touch(rows: DataFrame, levels: list[int], start: Column, end: Column, long: bool = False) -> DataFrame:
    """rows once for each node that [start, end] touches at each of the levels; `long` ones
    at no finer level than their own, and there at nodes of lifted spans."""
    own = level(start, end) if long else F.lit(0)
    parts = [(own <= k, _nodes(k, start, end)) for k in levels]
    return _explode(rows, parts + [(own == k, _nodes(k, start, end, True)) for k in range(1, len(WIDTHS)) if long])


NODE = ["programme_id", "level", "node", "lifted"]


def best_overlap(words: DataFrame, turns: DataFrame, long: bool = False) -> DataFrame:
    """Words (programme_id, segment_id, word_index, s, e, ...) with the cluster of
    the turn they overlap most, ties to the earliest turn; null without overlap. long: what
    is looked up may be as long as a programme, as rows of music are. Turns without a start or
    an end are left out. Words and the overlaps found are dealt together, by segment, and a
    word reads its own off the largest so far: a join would deal words by word_index too, and
    what comes after, by segment, once more."""
    t = turns.select("programme_id", "cluster", F.col("start_ms").alias("ts"), F.col("end_ms").alias("te")).filter("ts is not null and te is not null")
    w = touch(words.select("programme_id", "segment_id", "word_index", "s", "e"), levels_of(t, "ts", "te"), F.col("s"), F.col("e"), long)
    over = F.least("e", "te") - F.greatest("s", "ts")
    hit = w.join(cover(t, "ts", "te", long), NODE).withColumn("o", over).filter("o > 0")
    segment, key = ["programme_id", "segment_id"], ["programme_id", "segment_id", "word_index"]
    found = hit.select(*key, F.struct("word_index", "o", (-F.col("ts")).alias("nts"), (-F.col("te")).alias("nte"), "cluster").alias("_hit"))
    both = words.select(*key, F.struct(*[c for c in words.columns if c not in key]).alias("_word")).unionByName(found, allowMissingColumns=True).repartition(*segment)
    so_far = Window.partitionBy(*segment).orderBy("word_index", F.col("_word").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    w = both.withColumn("_best", F.max("_hit").over(so_far)).filter("_word is not null")
    own = lambda c: F.when(F.col("_best.word_index") == F.col("word_index"), F.col("_best." + c))
    return w.select(*key, "_word.*", own("cluster").alias("cluster"), own("o").alias("overlap_ms"))


def points_in(words: DataFrame, spans: DataFrame) -> DataFrame:
    """(programme_id, s) inside half-open [start_ms, end_ms) of spans; a word may
    match several."""
    w = touch(words, levels_of(spans, "start_ms", "end_ms"), F.col("s"), F.col("s"))
    return w.join(cover(spans, "start_ms", "end_ms"), NODE).filter("s >= start_ms and s < end_ms").drop("level", "node", "lifted")


def with_levels(rows: DataFrame, lengths: Column) -> DataFrame:
    """rows (programme_id, ...) with `levels`: those that spans of their programme lie at.
    lengths: the lengths of a row's spans."""
    own = F.transform(lengths, lambda n: level(F.lit(0), n))
    return rows.withColumn("levels", F.array_distinct(F.flatten(F.collect_list(own).over(Window.partitionBy("programme_id")))))


def points_by(rows: DataFrame) -> DataFrame:
    """`points_in` where points and spans come as rows of one table: rows (programme_id, s, levels,
    span (start_ms, end_ms, ...), ...) are points where span is null -> points, once with each
    span they are in. A window collects the spans of a node, so rows dealt by programme
    are not dealt out again, as a join by node would."""
    widths = F.array(*[F.lit(w).cast("long") for w in WIDTHS])
    s, e, columns = F.col("span.start_ms"), F.col("span.end_ms"), [c for c in rows.columns if c not in ("levels", "span")]
    node = lambda k, ms: F.floor(ms / F.element_at(widths, k + 1))
    at = lambda k, n: F.struct(k.alias("level"), n.alias("node"))
    own = F.col("_own")
    covered = F.transform(F.sequence(node(own, s), node(own, F.greatest(s, e))), lambda n: at(own, n))
    touched = F.transform("levels", lambda k: at(k, node(k, F.col("s"))))
    r = rows.withColumn("_own", level(s, e)).withColumn("_at", F.explode(F.when(F.col("span").isNotNull(), covered).otherwise(touched)))
    r = r.filter("_at.node is not null").select(*columns, "span", "_at.level", "_at.node")
    r = r.withColumn("_spans", F.collect_list("span").over(Window.partitionBy("programme_id", "level", "node"))).filter("span is null")
    return r.select(*columns, F.explode(F.filter("_spans", lambda x: (x["start_ms"] <= F.col("s")) & (x["end_ms"] > F.col("s")))).alias("span"))
