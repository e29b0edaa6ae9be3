"""Rules over lines, clips and tags: what is refused, rewritten, kept, priced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


def missing_durations(clips: DataFrame) -> DataFrame:
    """Clips without a measured length; none may be spaced while there are any."""
    return clips.filter(~F.coalesce(F.col("audio_dur_ms") > 0, F.lit(False)))


def rewrite_candidates(lines: DataFrame, low: float, high: float, most_fit: float | None = None) -> DataFrame:
    """lines (..., text, start_ms, end_ms; audio_dur_ms where most_fit is given) whose
    characters a second lie outside low..high. With most_fit, a line that has audio is a
    candidate only if the audio is longer than its window by more than that factor."""
    length = F.col("end_ms") - F.col("start_ms")
    rate = F.length("text") * 1000.0 / F.when(length > 0, length)
    out = lines.withColumn("chars_per_second", rate).filter((F.col("chars_per_second") < low) | (F.col("chars_per_second") > high))
    if most_fit is None:
        return out
    fit = F.col("audio_dur_ms") / F.when(length > 0, length)
    return out.withColumn("fit", fit).filter(F.col("fit").isNull() | (F.col("fit") > most_fit))


def above_floor(tags: DataFrame, floors: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """tags (kind, confidence, ...) at or above their kind's floor (0 for a kind without
    one), and per kind how many stay and go. A null confidence goes. floors is a small
    parameter table, one entry a kind."""
    floor = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in floors.items() for x in kv]), F.col("kind")), F.lit(0.0)) if floors else F.lit(0.0)
    t = tags.withColumn("_ok", F.coalesce(F.col("confidence") >= floor, F.lit(False)))
    return t.filter("_ok").drop("_ok"), t.groupBy("kind").agg(F.count_if("_ok").alias("kept"), F.count_if(~F.col("_ok")).alias("dropped"))


def clip_groups(clips: DataFrame, gap_ms: int = 0) -> DataFrame:
    """Clips per programme and speaker, and how long their stem is."""
    g = clips.groupBy("programme_id", "speaker_id").agg(F.count(F.lit(1)).alias("clips"), F.sum(X.half_up(F.col("audio_dur_ms"))).alias("_d"))
    return g.withColumn("stem_ms", F.greatest(F.lit(1), F.col("_d") + (F.col("clips") - 1) * gap_ms).cast("long")).drop("_d")


def transcription_cost(seconds: Column, rate: Column) -> Column:
    """Dollars, to four places."""
    return (F.floor(seconds * rate * 10_000 + 0.5) / 10_000).cast("double")


def stale_from_source(translations: DataFrame, sources: DataFrame) -> DataFrame:
    """translations (source_segment_id, translated_from_source_hash, ...) with the hash of
    their source's text now, and stale: null where no hash was kept."""
    s = sources.select("source_segment_id", X.fnv1a32(F.col("source_text")).alias("source_hash"))
    out = translations.join(s, "source_segment_id", "left")
    return out.withColumn("stale", F.col("translated_from_source_hash") != F.col("source_hash"))


def context_neighbours(lines: DataFrame, order: str = "segment_id") -> DataFrame:
    o = Window.partitionBy("programme_id").orderBy(order)
    return lines.withColumns({"previous_text": F.lag("text").over(o), "next_text": F.lead("text").over(o)})


def speaker_runs(lines: DataFrame, order: str = "segment_id") -> DataFrame:
    """run: numbers the stretches of one speaker in a programme."""
    o = Window.partitionBy("programme_id").orderBy(order)
    return lines.withColumn("run", F.sum(F.coalesce((F.col("speaker") != F.lag("speaker").over(o)).cast("long"), F.lit(0))).over(o))


def latency_summary(chunks: DataFrame, exact: bool = False) -> DataFrame:
    """chunks (run_id, queued_ms, started_ms, finished_ms, provider_ms) -> per run how long
    chunks waited, were worked on, and waited for the provider: sums, means and
    percentiles. Percentiles are approximate unless exact is asked for."""
    c = chunks.withColumns({"wait_ms": F.col("started_ms") - F.col("queued_ms"), "work_ms": F.col("finished_ms") - F.col("started_ms")})
    q = (lambda c, p: F.percentile(c, F.lit(p))) if exact else (lambda c, p: F.percentile_approx(c, p, 10_000).cast("double"))
    cols = [f for c in ("wait_ms", "work_ms", "provider_ms") for f in (F.sum(c).alias(f"{c}_sum"), F.avg(c).alias(f"{c}_mean"), q(c, 0.5).alias(f"{c}_p50"), q(c, 0.95).alias(f"{c}_p95"))]
    return c.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_chunks"), *cols)
