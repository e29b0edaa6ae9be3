"""Chunked runs as a whole, and speaker stems."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import ranges, runs

#: Rows of a run are numbered by ranges of so many items, so that no run is sorted whole.
RANGE_ITEMS = 10_000


def plan_run(items: DataFrame, size: int, by_scene: bool = False) -> DataFrame:
    """items (run_id, item_id, ...; scene_id if by_scene) -> the frozen plan: chunk_index,
    chunk_key (`chunk:{i}` or `{scene}:{i}`). Items are numbered in order of item_id: a
    run's items fall into ranges of ids, ranges are counted, and only a range is sorted."""
    keys = ["run_id", "scene_id"] if by_scene else ["run_id"]
    stats = items.groupBy(*keys).agg(F.min("item_id").alias("_lo"), F.max("item_id").alias("_hi"), F.count(F.lit(1)).alias("_all"))
    parts = F.ceil(F.col("_all") / RANGE_ITEMS)
    width = F.greatest(F.lit(1), F.ceil((F.col("_hi") - F.col("_lo") + 1) / parts))
    i = items.join(stats, keys).withColumn("_range", F.floor((F.col("item_id") - F.col("_lo")) / width)).drop("_lo", "_hi", "_all")
    counts = i.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy("item_id")) - 1 + F.col("_base")
    out = i.join(base, [*keys, "_range"]).withColumn("chunk_index", F.floor(place / size))
    head = F.col("scene_id").cast("string") if by_scene else F.lit("chunk")
    return out.withColumn("chunk_key", F.concat_ws(":", head, "chunk_index")).drop("_range", "_base")


def run_state(plan: DataFrame, results: DataFrame, cap: float, most_failed: int = 200) -> tuple[DataFrame, DataFrame]:
    """plan (run_id, chunk_index, chunk_key, one row a chunk) and results (run_id, chunk_key,
    ok, processed, succeeded, failed, skipped, characters, cost_usd) -> per chunk its next
    step (done, failed, dispatch or stop), and per run the counters, the first failed
    chunks, whether the cost cap is breached, and its status: partial once it is, or if
    some chunk failed; failed if all did; running while a chunk may still be dispatched."""
    r = plan.join(results, ["run_id", "chunk_key"], "left")
    r = ranges.sum_before(r, ["run_id"], "chunk_index", "cost_usd", "_spent")
    r = r.withColumn("next_step", F.when(F.col("ok"), "done").when(~F.col("ok"), "failed").when(F.col("_spent") < cap, "dispatch").otherwise("stop"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    g = r.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_chunks"), F.count_if(F.col("ok").isNotNull()).alias("terminal_chunks"), F.count_if(~F.col("ok")).alias("failed_chunks"), F.count_if(F.col("next_step") == "dispatch").alias("open_chunks"),
        *[total(c).cast("long").alias(c) for c in ("processed", "succeeded", "failed", "skipped", "characters")], F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("cost_usd"),
    )
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy("chunk_index"))
    first = r.filter("not ok").withColumn("_k", rank).filter(F.col("_k") <= most_failed)
    named = first.groupBy("run_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_key"))), lambda x: x["chunk_key"]), ",").alias("failed_keys"))
    g = g.join(named, "run_id", "left").withColumns({"failed_keys": F.coalesce("failed_keys", F.lit("")), "breached": F.col("cost_usd") >= cap})
    ended = (F.col("terminal_chunks") >= F.col("total_chunks")) | (F.col("breached") & (F.col("open_chunks") == 0))
    status = F.when(~ended, "running").when(F.col("failed_chunks") == F.col("total_chunks"), "failed").when((F.col("failed_chunks") > 0) | (F.col("terminal_chunks") < F.col("total_chunks")), "partial").otherwise("completed")
    return r.select("run_id", "chunk_index", "chunk_key", "next_step"), g.withColumn("run_status", status)


def resume(plan: DataFrame, completed: DataFrame) -> DataFrame:
    """Chunks of the frozen plan still to be done."""
    return runs.pending(plan, completed)


def speaker_stems(clips: DataFrame, labels: DataFrame, language: str, gap_ms: int = 0, fmt: str = "wav") -> tuple[DataFrame, DataFrame, DataFrame]:
    """clips (programme_id, speaker_id, clip_no, start_ms, audio_dur_ms, overrun_ms) and
    labels (speaker_id, label) -> placed clips, one file per speaker (name, clip count,
    length, gap), and what is refused: programmes with late clips, and, where clips are
    spaced, clips without a measured length (their speaker has no file then)."""
    late = clips.filter(F.col("overrun_ms") > 80).groupBy("programme_id").agg(F.count(F.lit(1)).alias("n")).select("programme_id", F.lit(None).cast("string").alias("speaker_id"), F.lit("late_clips").alias("fault"), "n")
    sound = clips.join(late.select("programme_id"), "programme_id", "left_anti")
    group = ["programme_id", "speaker_id"]
    bad = late.limit(0)
    if gap_ms > 0:
        bad = sound.filter(~F.coalesce(F.col("audio_dur_ms") > 0, F.lit(False))).groupBy(*group).agg(F.count(F.lit(1)).alias("n")).select(*group, F.lit("missing_duration").alias("fault"), "n")
        sound = sound.join(bad.select(*group), group, "left_anti")
        before = Window.partitionBy(*group).orderBy("clip_no").rowsBetween(Window.unboundedPreceding, -1)
        length = X.half_up(F.col("audio_dur_ms"))
        sound = sound.withColumn("start_ms", F.coalesce(F.sum(length + gap_ms).over(before), F.lit(0)))
    ends = sound.groupBy(*group).agg(F.count(F.lit(1)).alias("clip_count"), F.greatest(F.lit(1), F.max(F.col("start_ms") + X.half_up(F.coalesce(F.col("audio_dur_ms"), F.lit(0))))).alias("duration_ms"))
    files = ends.join(labels, "speaker_id", "left").withColumn("label", F.coalesce("label", "speaker_id"))
    gap = f"_gap{gap_ms / 1000:g}s" if gap_ms > 0 else ""
    files = files.withColumns({"file_name": F.concat(X.slug(F.col("label")), F.lit(f"_{language}{gap}.{fmt}")), "gap_seconds": F.lit(gap_ms / 1000 if gap_ms > 0 else None).cast("double")})
    return sound.select(*group, "clip_no", "start_ms", "audio_dur_ms"), files.select(*group, "label", "file_name", "clip_count", "duration_ms", "gap_seconds"), late.unionByName(bad)


