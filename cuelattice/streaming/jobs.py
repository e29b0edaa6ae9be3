"""Structured Streaming operators over job events. Those that only transform work on a
batch table too; those that keep state over a stream have a batch twin in `operators`.
`ordered` has those whose rows depend on the order of event times."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..ledger import Ledger
from ..operators import refine, timing
from ..staging import stage

SCHEMA = "event_id long, user_id long, event_type string, ts timestamp, value double, props string"


def read_events(spark: SparkSession, path: str, schema=SCHEMA) -> DataFrame:
    """Stream of the Parquet files in a folder; a path that is one file is read by its
    name from the folder it lies in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def drain(writer, checkpoint: str, seconds: int | None = None, conf: dict[str, str] | None = None) -> list[dict]:
    """Run a stream over what is there now and stop; fails if it takes longer than
    `seconds`, where given. conf holds while the stream starts. Returns for each batch
    its number, the watermark it ran with, its input rows and those dropped as late (the
    session's spark.sql.streaming.numRecentProgressUpdates last batches)."""
    spark = SparkSession.active()
    old = {k: spark.conf.get(k, None) for k in conf or {}}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    try:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError(f"the stream took more than {seconds} s")
        done = [json.loads(p.json) for p in query.recentProgress]
    finally:
        query.stop()
    return [{"batch": p["batchId"], "watermark": p.get("eventTime", {}).get("watermark"), "rows": p.get("numInputRows", 0), "dropped": sum(o.get("numRowsDroppedByWatermark", 0) for o in p.get("stateOperators", []))} for p in done]


def once_per_job(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["job_id"])


def start_rates(events: DataFrame, window: str = "1 minute", most: int = 100, late: str = "10 minutes") -> DataFrame:
    """Starts per queue and tumbling window, and whether they pass the limit."""
    g = events.withWatermark("ts", late).filter("state = 'active'").groupBy("queue", F.window("ts", window))
    return g.agg(F.count(F.lit(1)).alias("starts")).select("queue", F.col("window.start").alias("window_start"), "starts", (F.col("starts") > most).alias("over"))


def wait_trend(events: DataFrame, window: str = "10 minutes", slide: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Per queue and sliding window: events, the longest value, and of events that wait
    (waiting, delayed) and that work (active, completed, failed) the mean value, the number
    of values and their sum. Values are summed as decimals of six places, so that no order
    of arrival changes a sum; what is no such number (not finite, 10^22 or more) is left out
    of means and sums."""
    waits = F.col("state").isin("waiting", "delayed")
    g, exact = events.withWatermark("ts", late).groupBy("queue", F.window("ts", window, slide)), F.col("value").try_cast("decimal(28,6)")
    of = {"wait": F.when(waits, exact), "work": F.when(~waits, exact)}
    out = g.agg(F.count(F.lit(1)).alias("n_events"), F.max("value").alias("longest"), *[f(c).alias(f"{name}_{k}") for k, c in of.items() for name, f in (("n", F.count), ("sum", F.sum))])
    mean = [F.when(F.col(f"n_{k}") > 0, F.col(f"sum_{k}").cast("double") / F.col(f"n_{k}")).alias(f"mean_{k}") for k in of]
    return out.select("queue", F.col("window.start").alias("window_start"), "n_events", "longest", *mean, "n_wait", "sum_wait", "n_work", "sum_work")


def cents(total: Column, n: Column) -> Column:
    """total / n in hundredths, halves up, exactly; null where n is 0."""
    twice = (200_000_000 * total).cast("decimal(38,0)") + 1_000_000 * n
    by = F.when(n > 0, (2_000_000 * n).cast("decimal(38,0)"))
    return F.call_function("div", twice - F.pmod(twice, by), by).cast("long")


def sessions(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy("job_id", F.session_window("ts", gap))
    return g.agg(F.count(F.lit(1)).alias("n_events")).select("job_id", F.col("session_window.start").alias("started"), "n_events")


def keep_on_time(events: DataFrame, late: str, key: str = "event_id") -> DataFrame:
    """Events once by their key, without those behind the stream's watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def late_rows_of(arrivals: DataFrame, on_time: DataFrame, key: str = "event_id") -> DataFrame:
    """Side table of a `keep_on_time` stream: rows of the folder it read whose key it didn't
    let through. As many as Spark counts as dropped by the watermark, as long as keys don't
    repeat; a late repeat of an accepted row is not a late row."""
    return arrivals.join(on_time.select(key), key, "left_anti")


def _latest(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("queue", "job_id").agg(F.max(F.struct("ts", "event_id", "state")).alias("_last"))
    return last.select("queue", "job_id", "_last.*")


def keep_states(events: DataFrame, path: str, checkpoint: str, most: int = 16, seconds: int | None = None) -> None:
    """Latest state per job over the stream. Each micro-batch writes the jobs it changed to a
    folder of its own and publishes it as a version; a repeated batch finds itself published
    and does nothing. Beyond `most` folders they are merged into one. The state is the table:
    the stream itself keeps none, and any order of files gives the same."""

    def write(batch: DataFrame, number: int) -> None:
        ledger = Ledger(batch.sparkSession, path)
        now = ledger.current()
        if now["batches"].get(checkpoint, -1) < number:
            now = ledger.commit(now, [*now["folders"], ledger.write(_latest(batch), "states")], checkpoint, number)
        ledger.fold(now, most, lambda rows: _latest(rows.drop("_folder")))

    drain(events.writeStream.foreachBatch(write), checkpoint, seconds)


def running_states(spark: SparkSession, path: str) -> DataFrame:
    """Jobs per queue and latest state, from what `keep_states` has published."""
    rows = Ledger(spark, path).read()
    rows = spark.createDataFrame([], "queue string, job_id string, ts timestamp, event_id long, state string") if rows is None else rows
    return _latest(rows).groupBy("queue", "state").agg(F.count(F.lit(1)).alias("jobs"))


def _incrementally(arrivals: DataFrame, refined: Callable[[DataFrame], tuple[DataFrame, DataFrame]], path: str, checkpoint: str, most: int, seconds: int | None) -> None:
    """refined: programme ids -> (programmes that must have rows, rows)."""

    def write(batch: DataFrame, number: int) -> None:
        ledger = Ledger(batch.sparkSession, path)
        now = ledger.current()
        if now["batches"].get(checkpoint, -1) < number:
            needed, rows = refined(stage(batch.select("programme_id").distinct()))
            folder = ledger.write(rows.withColumn("version", F.lit(now["version"] + 1)), "rows")
            written = batch.sparkSession.read.parquet(f"{ledger.path}/{folder}")
            if not needed.join(written, "programme_id", "left_anti").isEmpty() or written.count() != rows.count():
                raise ValueError("rows of a touched programme were not written; nothing is published")
            now = ledger.commit(now, [*now["folders"], folder], checkpoint, number)
        ledger.fold(now, most, lambda x: _last_versions(x.drop("_folder")))

    drain(arrivals.writeStream.foreachBatch(write), checkpoint, seconds)


def refine_incrementally(arrivals: DataFrame, words: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, most: int = 16, seconds: int | None = None) -> None:
    """`publish_incrementally` for the timing of words alone."""

    def refined(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = stage(words(ids))
        return found.select("programme_id").distinct(), stage(timing.refine_timing(found))

    _incrementally(arrivals, refined, path, checkpoint, most, seconds)


def publish_incrementally(arrivals: DataFrame, tables: Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]], path: str, checkpoint: str, most: int = 16, seconds: int | None = None) -> None:
    """arrivals: a stream with the programme_id of whatever has come in. tables: called in
    every micro-batch with the touched programmes' ids; reads words, turns and segments (see
    `refine.refine_programmes`) as they are then, so files written after the start count.

    Touched programmes are refined again, whole, and written with their export gate to a
    folder that no reader sees; it is read back, and only if it has rows of every touched
    programme that has words does one new version list it. A batch that failed in between
    is written anew when repeated, and one already published does nothing: a batch makes one
    version. If another writer published meanwhile, the batch fails with `Conflict`, and
    repeats on what is current then."""

    def refined(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        words, turns, segments = tables(ids)
        words = stage(words)
        rows = stage(refine.refine_programmes(words, turns, segments))
        gate = refine.export_gate(rows).select("programme_id", "blocking", "total", "exportable")
        return words.select("programme_id").distinct(), rows.join(gate, "programme_id")

    _incrementally(arrivals, refined, path, checkpoint, most, seconds)


def _last_versions(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("programme_id").agg(F.max("version").alias("version"))
    return rows.join(last, ["programme_id", "version"], "left_semi")


def published_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Each programme's refined rows, with their export gate, as the last version that
    touched it left them; None before the first version."""
    rows = Ledger(spark, path).read()
    return None if rows is None else _last_versions(rows.drop("_folder"))


def late_rows(events: DataFrame, late_seconds: int, arrival: str = "arrival") -> DataFrame:
    """Batch report: per queue, events whose time lies more than late_seconds behind the
    latest one of their queue that arrived before them. A stream's watermark is one for all
    queues and moves by micro-batch; what it drops is `late_rows_of`."""
    before = Window.partitionBy("queue").orderBy(arrival, "event_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    e = events.withColumn("_late", F.coalesce(F.max(at).over(before) - at > late_seconds * 1_000_000, F.lit(False)))
    return e.groupBy("queue").agg(F.count(F.lit(1)).alias("n_events"), F.count_if("_late").alias("late_events"))
