"""Chunked runs: resume, harvest, counters, cost stop, versions (plans: `chunked`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .evidence import deterministic_uuid
from .ranges import sum_before


def pending(chunks: DataFrame, completed: DataFrame) -> DataFrame:
    """Chunks of a run that no completed row names (null keys name none)."""
    return chunks.join(completed.select("run_id", "chunk_key"), ["run_id", "chunk_key"], "left_anti")


def harvest(in_flight: DataFrame, results: DataFrame) -> DataFrame:
    """Results of chunks in flight; one without a result has status null."""
    return in_flight.join(results.select("run_id", "chunk_key", "status"), ["run_id", "chunk_key"], "left")


def counters(results: DataFrame, most_failed: int = 200) -> DataFrame:
    """Per run: sums, the first failed keys in order of chunk_index, and status: running
    until every chunk is final, then completed, failed, or partial."""
    g = results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("characters").alias("characters"), F.sum("cost").alias("cost"),
    )
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy("chunk_index"))
    first = results.filter("status = 'failed'").withColumn("_k", rank).filter(F.col("_k") <= most_failed)
    keys = first.groupBy("run_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_key"))), lambda x: x["chunk_key"]), ",").alias("failed_keys"))
    status = F.when(F.col("ok") + F.col("failed") < F.col("chunks"), "running").when(F.col("failed") == 0, "completed").when(F.col("ok") == 0, "failed").otherwise("partial")
    return g.join(keys, "run_id", "left").withColumns({"failed_keys": F.coalesce("failed_keys", F.lit("")), "run_status": status})


def cost_stop(chunks: DataFrame, cap: float) -> DataFrame:
    """dispatched: whether the cost committed before a chunk is still below the cap."""
    return sum_before(chunks, ["run_id"], "chunk_index", "cost", "_spent").withColumn("dispatched", F.col("_spent") < F.lit(cap)).drop("_spent")


def stale(events: DataFrame, ceiling_seconds: int) -> DataFrame:
    """Active events followed by nothing within the ceiling, on the same job: the
    first is dispatched again, later ones end the job. The last event of a job is
    judged against the latest time in the table."""
    order = Window.partitionBy("job_id").orderBy("ts", "event_id")
    latest = events.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("_now"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    e = events.withColumns({"_at": at, "_next": F.lead(at).over(order), "_one": F.lit(1)})
    e = e.join(F.broadcast(latest.withColumn("_one", F.lit(1))), "_one").drop("_one")  # latest is one row
    late = e.filter((F.col("state") == "active") & (F.coalesce("_next", "_now") - F.col("_at") > ceiling_seconds * 1_000_000))
    return late.select("job_id", "event_id", F.when(F.row_number().over(order) == 1, "dispatch_again").otherwise("terminal").alias("action"))


def latency(events: DataFrame) -> DataFrame:
    p = lambda q: F.percentile("value", F.lit(q))
    return events.groupBy("queue").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("longest"), p(0.5).alias("p50"), p(0.95).alias("p95"), p(0.99).alias("p99"))


def stage_and_flip(active: DataFrame, staged: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """active (row_id, import_run_id, is_active, superseded_by, superseded_at if any), staged
    (row_id): staged rows become active under run_id and replace active rows of their id,
    which keep who superseded them and when (`at`, null if not given). A second application changes nothing, since
    rows of that run are not staged again."""
    at = F.lit(None).cast("timestamp") if at is None else at
    active = active if "superseded_at" in active.columns else active.withColumn("superseded_at", F.lit(None).cast("timestamp"))
    done = active.filter(F.col("import_run_id") == run_id).select("row_id")
    new = staged.select("row_id").distinct().join(done, "row_id", "left_anti")
    flag = new.select("row_id", F.lit(True).alias("_hit"))
    old = active.join(flag, "row_id", "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)) & F.col("is_active"))
    old = old.withColumns({"superseded_by": F.when(F.col("_hit"), F.lit(run_id)).otherwise(F.col("superseded_by")), "superseded_at": F.when(F.col("_hit"), at).otherwise(F.col("superseded_at")), "is_active": F.col("is_active") & ~F.col("_hit")}).drop("_hit")
    fresh = new.select("row_id", F.lit(run_id).alias("import_run_id"), F.lit(True).alias("is_active"), F.lit(None).cast("string").alias("superseded_by"), F.lit(None).cast("timestamp").alias("superseded_at"))
    return old.unionByName(fresh)


def reseed(existing: DataFrame, segments: DataFrame, languages: tuple[str, ...], seed: Column) -> DataFrame:
    """existing and the result: (programme_id, segment_id, lang, row_id). Rows of the
    programmes of `segments` go, and each segment gets one row a language under an id
    that `seed` (over programme_id, segment_id, lang) decides, so that doing it again
    gives the same rows."""
    others = existing.join(segments.select("programme_id").distinct(), "programme_id", "left_anti")
    new = segments.select("programme_id", "segment_id").distinct().withColumn("lang", F.explode(F.array(*[F.lit(x) for x in languages])))
    return others.select("programme_id", "segment_id", "lang", "row_id").unionByName(new.withColumn("row_id", deterministic_uuid(seed)))


def retained(snapshots: DataFrame, keep: int) -> DataFrame:
    """snapshots (table_name, dt, n_rows): whether each date is among the last `keep`."""
    r = F.dense_rank().over(Window.partitionBy("table_name").orderBy(F.desc("dt")))
    return snapshots.withColumn("kept", r <= keep)


def cascade(parents: DataFrame, children: DataFrame, key: str, to: str | None = None) -> DataFrame:
    """Rows of children whose `key` is among the parents' `to` (same name if None)."""
    keys = parents.select(F.col(to or key).alias(key)).distinct()
    return children.join(keys, key, "left_semi")


def trigger(force: Column, n: Column) -> Column:
    return F.when(~force, "initial_generation").when(n > 1, "bulk_regenerate").otherwise("operator_regenerate")
