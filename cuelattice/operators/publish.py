"""What leaves the engine: logs, published segments, captions, snapshots, versions.

Published data is a folder of its own for every version and one row that names the
current one, so that a reader sees the old version or the new one, never a mix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..ledger import Ledger

FORMATS = ("srt", "vtt", "csv", "json", "txt")


def append_events(events: DataFrame, path: str) -> None:
    """Append log rows (ts, function_name, event, ... ) below one folder a day; a missing
    level is `info`."""
    out = events.withColumn("level", F.coalesce("level", F.lit("info")) if "level" in events.columns else F.lit("info"))
    out.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).write.mode("append").partitionBy("dt").parquet(path)


def publish(segments: DataFrame, report: DataFrame, path: str, version: str) -> DataFrame:
    """Evidence before cutover: write the report, read it back, refuse unless it covers
    every programme of the segments; then write the segments, compare counts, and only
    then append the version to the list that readers follow. Returns what readers see."""
    spark = segments.sparkSession
    report.write.mode("overwrite").parquet(f"{path}/{version}/report")
    kept = spark.read.parquet(f"{path}/{version}/report")
    segments.write.mode("overwrite").parquet(f"{path}/{version}/segments")
    _check(spark.read.parquet(f"{path}/{version}/segments"), kept)
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at")).write.mode("append").parquet(f"{path}/versions")
    return published(spark, path)


def _check(written: DataFrame, kept: DataFrame) -> None:
    bare = written.select("programme_id").distinct().join(kept, "programme_id", "left_anti")
    if not bare.isEmpty():
        raise ValueError("segments without a report are not published")
    counts = written.groupBy("programme_id").agg(F.count(F.lit(1)).alias("_n")).join(kept.select("programme_id", "n_rows"), "programme_id")
    if not counts.filter("_n <> n_rows").isEmpty():
        raise ValueError("a report counts other rows than were written")


def publish_over(segments: DataFrame, report: DataFrame, path: str, base: dict) -> dict:
    """`publish` for writers that may meet: base is the version that the work started from
    (`Ledger(spark, path).current()`). Report and segments are written and checked out of
    sight, then become the next version only if base is still the current one; otherwise
    `Conflict` is raised and readers see nothing of this writer. Returns the new version."""
    ledger = Ledger(segments.sparkSession, path)
    folders = [ledger.write(report, "report"), ledger.write(segments, "segments")]
    kept, written = (segments.sparkSession.read.parquet(f"{ledger.path}/{f}") for f in folders)
    _check(written, kept)
    return ledger.commit(base, folders)


def current_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments of the current version of `publish_over`."""
    ledger = Ledger(spark, path)
    return spark.read.parquet(*[f"{ledger.path}/{f}" for f in ledger.current()["folders"] if f.startswith("segments-")])


def published(spark: SparkSession, path: str) -> DataFrame:
    """Segments of the version published last."""
    last = spark.read.parquet(f"{path}/versions").agg(F.max_by("version", F.struct("published_at", "version")).alias("v")).first()["v"]
    return spark.read.parquet(f"{path}/{last}/segments")


def _clock(ms: Column, mark: str) -> Column:
    part = lambda v, w: F.lpad(v.cast("string"), w, "0")
    return F.concat(part(F.floor(ms / 3_600_000), 2), F.lit(":"), part(F.floor(ms / 60_000) % 60, 2), F.lit(":"), part(F.floor(ms / 1000) % 60, 2), F.lit(mark), part(ms % 1000, 3))


def captions(cues: DataFrame, fmt: str) -> DataFrame:
    """cues (programme_id, n, start_ms, end_ms, text) -> programme_id, format, content: one
    file a programme, cues in order of n. A null text is empty."""
    text = F.coalesce("text", F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    line = {
        "srt": F.concat_ws("\n", F.col("n").cast("string"), F.concat(_clock(F.col("start_ms"), ","), F.lit(" --> "), _clock(F.col("end_ms"), ",")), text),
        "vtt": F.concat_ws("\n", F.concat(_clock(F.col("start_ms"), "."), F.lit(" --> "), _clock(F.col("end_ms"), ".")), text),
        "csv": F.concat_ws(",", F.col("n").cast("string"), F.col("start_ms").cast("string"), F.col("end_ms").cast("string"), quoted),
        "json": F.to_json(F.struct("n", "start_ms", "end_ms", text.alias("text"))),
        "txt": text,
    }[fmt]
    head, part, tail = {"srt": ("", "\n\n", ""), "vtt": ("WEBVTT\n\n", "\n\n", ""), "csv": ("n,start_ms,end_ms,text\n", "\n", ""), "json": ("[", ",", "]"), "txt": ("", "\n", "")}[fmt]
    g = cues.withColumn("_b", line).groupBy("programme_id").agg(F.sort_array(F.collect_list(F.struct("n", "_b"))).alias("_c"))
    body = F.array_join(F.transform("_c", lambda c: c["_b"]), part)
    return g.select("programme_id", F.lit(fmt).alias("format"), F.concat(F.lit(head), body, F.lit(tail)).alias("content"))


def export_captions(cues: DataFrame, path: str, fmt: str) -> None:
    """One text file for each programme's folder."""
    captions(cues, fmt).select("programme_id", "content").write.mode("overwrite").partitionBy("programme_id").text(f"{path}/{fmt}")


def snapshot(tables: dict[str, DataFrame], path: str, date: str, keep_last: int) -> DataFrame:
    """Write every table below dt=date, then the manifest (table_name, dt, n_rows, kept):
    dates beyond the last `keep_last` of a table are marked for removal."""
    if not tables:
        raise ValueError("a snapshot needs a table")
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/dt={date}")
    rows = [spark.read.parquet(f"{path}/{name}").groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "dt", "n_rows") for name in tables]
    order = Window.partitionBy("table_name").orderBy(F.desc("dt"))
    return reduce(DataFrame.unionByName, rows).withColumn("kept", F.dense_rank().over(order) <= keep_last)


def prune(manifest: DataFrame, path: str) -> None:
    """Delete the snapshot folders that the manifest doesn't keep, one per table and date."""
    spark = manifest.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in manifest.filter("not kept").select("table_name", "dt").toLocalIterator():
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{r['table_name']}/dt={r['dt']}")
        old.getFileSystem(conf).delete(old, True)


def supersede_cues(cues: DataFrame, run_id: str, at: Column, page: int, dispatches: bool) -> tuple[DataFrame, DataFrame]:
    """cues (project_id, cue_id, is_active, superseded_by_run_id, superseded_at): one tick
    takes each project's first `page` active cues out of use. Returns the cues, and per
    project how many were taken, how many are left and what comes next: continue,
    dispatch_engine or done. A tick over cues without active ones changes nothing."""
    rank = F.row_number().over(Window.partitionBy("project_id", "is_active").orderBy("cue_id"))
    hit = F.col("is_active") & (F.col("_rank") <= page)
    marked = cues.withColumn("_rank", rank).withColumn("_hit", hit)
    out = marked.withColumns({"is_active": F.col("is_active") & ~F.col("_hit"), "superseded_by_run_id": F.when(F.col("_hit"), F.lit(run_id)).otherwise(F.col("superseded_by_run_id")), "superseded_at": F.when(F.col("_hit"), at).otherwise(F.col("superseded_at"))})
    step = out.groupBy("project_id").agg(F.count_if("_hit").alias("superseded"), F.count_if("is_active").alias("remaining"))
    return out.drop("_rank", "_hit"), step.withColumn("next_step", F.when(F.col("remaining") > 0, "continue").otherwise("dispatch_engine" if dispatches else "done"))
