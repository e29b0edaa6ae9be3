"""Segments, speakers, clips, quality gates and job bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


def sentence_segments(words: DataFrame, gap_ms: int = 650) -> DataFrame:
    """Cuts each segment's words after a sentence end or a pause; one row a piece."""
    order = Window.partitionBy("programme_id", "segment_id").orderBy("word_index")
    cut = F.coalesce(X.sentence_end(F.lag("text").over(order)) | (F.col("ps") - F.lag("pe").over(order) >= gap_ms), F.lit(False))
    w = words.withColumn("piece", F.sum(cut.cast("int")).over(order))
    words_in_order = F.transform(F.sort_array(F.collect_list(F.struct("word_index", "text"))), lambda x: x["text"])
    return w.groupBy("programme_id", "segment_id", "piece").agg(F.min("ps").alias("start_ms"), F.max("pe").alias("end_ms"), F.count(F.lit(1)).alias("n_words"), X.join_words(words_in_order).alias("text"))


def speaker_plan(turns: DataFrame) -> DataFrame:
    """Clusters of a programme in order of first appearance, with colour index,
    mean confidence and number of turns."""
    g = turns.groupBy("programme_id", "cluster").agg(F.min(F.struct("start_ms", "end_ms")).alias("first"), F.avg(X.confidence_norm(F.col("confidence"))).alias("m"), F.count(F.lit(1)).alias("turn_count"))
    rank = F.row_number().over(Window.partitionBy("programme_id").orderBy("first", "cluster")) - 1
    return g.select("programme_id", "cluster", rank.cast("long").alias("speaker_index"), (rank % X.SPEAKER_COLOURS).cast("long").alias("colour"), (F.floor(F.col("m") * 1e6 + 0.5) / 1e6).alias("mean_confidence"), "turn_count")


def spaced_stems(clips: DataFrame, gap_ms: int = 500) -> DataFrame:
    """Start of each clip on its speaker's stem: what came before, rounded to
    milliseconds, plus the gaps; and the stem's length, at least 1."""
    group = Window.partitionBy("programme_id", "speaker_id")
    length = X.half_up(F.col("audio_dur_ms"))
    start = F.coalesce(F.sum(length + gap_ms).over(group.orderBy("clip_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = clips.select("programme_id", "speaker_id", "clip_no", start.cast("long").alias("start_ms"), (start + length).cast("long").alias("end_ms"))
    return c.withColumn("total_ms", F.greatest(F.lit(1), F.max("end_ms").over(group)))


def overruns(clips: DataFrame, most_ms: int = 80) -> DataFrame:
    """Programmes whose deliverable is refused, with the number of late clips."""
    return clips.filter(F.col("overrun_ms") > most_ms).groupBy("programme_id").agg(F.count(F.lit(1)).alias("late_clips"))


def shift_report(words: DataFrame, tolerance_ms: int = 1500, sample: int = 5) -> DataFrame:
    """Distribution of the shift between the two timelines with the words that shift most,
    and the quality gate: p99 at most 30 s and at most one word in 200 beyond the
    tolerance; `unmeasured` where no word has both windows."""
    d = F.greatest(F.abs(F.col("s") - F.col("ps")), F.abs(F.col("e") - F.col("pe"))).cast("double")
    worst = F.slice(F.sort_array(F.collect_list(F.when(F.col("d") > tolerance_ms, F.struct((-F.col("d")).alias("d"), "segment_id", "word_index")))), 1, sample)
    g = words.withColumn("d", d).groupBy("programme_id").agg(
        F.count(F.lit(1)).alias("word_count"), F.percentile("d", F.lit(0.5)).alias("median_shift"), F.percentile("d", F.lit(0.95)).alias("p95_shift"), F.percentile("d", F.lit(0.99)).alias("p99_shift"), F.max("d").alias("max_shift"),
        F.count_if(F.col("d") > tolerance_ms).alias("outliers"), F.array_join(F.transform(worst, lambda w: F.concat_ws(":", w["segment_id"], w["word_index"])), ",").alias("outlier_sample"),
    )
    verdict = F.when(F.col("p99_shift").isNull(), "unmeasured").when(F.col("p99_shift") > 30_000, "p99_shift").when(F.col("outliers") / F.col("word_count") > 0.005, "outlier_ratio").otherwise("pass")
    return g.withColumn("verdict", verdict)


def latest_states(events: DataFrame) -> DataFrame:
    """Jobs per queue and latest state."""
    last = events.groupBy("queue", "job_id").agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"))
    return last.groupBy("queue", "state").agg(F.count(F.lit(1)).alias("jobs"))


def recent(events: DataFrame, n: int = 10) -> DataFrame:
    order = Window.partitionBy("queue", "state").orderBy(F.desc("ts"), F.desc("event_id"))
    return events.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(1, min(50, n))).select("queue", "state", "rank", "event_id")


def failures(events: DataFrame) -> DataFrame:
    return events.filter("state = 'failed'").groupBy(X.failure_class(F.col("message")).alias("failure")).agg(F.count(F.lit(1)).alias("n"), F.sum(X.backoff_ms(F.lit(1000), 2.0, F.col("attempt") + 1, 20000)).alias("backoff_ms"))


def liveness(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions of a job's events, a new one after a longer gap (batch twin of the
    streaming session window)."""
    order, at = Window.partitionBy("job_id").orderBy("ts", "event_id"), F.col("ts").cast("timestamp")
    new = F.coalesce(F.unix_micros(at) - F.unix_micros(F.lag(at).over(order)) > gap_seconds * 1_000_000, F.lit(True))
    return events.withColumn("session", F.sum(new.cast("int")).over(order)).groupBy("job_id", "session").agg(F.count(F.lit(1)).alias("n_events")).withColumn("session", F.col("session").cast("long"))


def liveness_verdicts(events: DataFrame, gap_seconds: int, most: int = 2, last: bool = False) -> DataFrame:
    """Per job, how often nothing was heard of it for longer than the gap while it was
    active, and what that makes of it: alive, stalled, or failed after `most` stalls.
    last: the silence after a job's last event counts too, up to the latest time in the
    table."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    order = Window.partitionBy("job_id").orderBy("ts", "event_id")
    e = events.withColumns({"_at": at, "_next": F.lead(at).over(order)})
    if last:
        now = events.agg(F.max(at).alias("_now")).withColumn("_one", F.lit(1))
        e = e.withColumn("_one", F.lit(1)).join(F.broadcast(now), "_one").withColumn("_next", F.coalesce("_next", "_now"))  # now is one row
    stall = (F.col("state") == "active") & (F.col("_next") - F.col("_at") > gap_seconds * 1_000_000)
    g = e.groupBy("job_id").agg(F.count_if(F.coalesce(stall, F.lit(False))).alias("stalls"))
    return g.withColumn("verdict", F.when(F.col("stalls") > most, "failed").when(F.col("stalls") > 0, "stalled").otherwise("alive"))
