"""Transcript inputs derived from the driver tables: words, segments, turns, clips
and job events. Real deployments read these tables from Parquet as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a stored table that one task takes: its words then are some 300 MB over all sorts.
PART_BYTES = 1_000_000


def _parts(spark: SparkSession, path: str) -> int:
    """Partitions that grow with the table, so that a task's memory doesn't."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))


def words(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """programme_id, segment_id, word_index, text, ps, pe (provider window), s, e
    (aligned window), in milliseconds; chronological position is (segment, index). only:
    the programme_id of those asked for. Texts are dealt by programme before they are split
    into words: windows over a programme's words find them together, and what is shuffled
    are texts."""
    path = f"{sf_dir}/conversations.parquet"
    src = spark.read.parquet(path).select("conv_id", "turn", "text")
    if only is not None:
        src = src.join(only.select(F.col("programme_id").alias("conv_id")), "conv_id", "left_semi")
    src = src.repartition(_parts(spark, path), "conv_id")
    return spark.sql(
        """
        with w as (select conv_id, turn, cast(idx as bigint) idx, text from
          (select conv_id, turn, filter(split(text, '[ \\t\\n\\r]+'), x -> x <> '') a from {src}) lateral view posexplode(a) p as idx, text),
        h as (select *, length(text) n_ch, (conv_id*7919+turn*104729+idx*1299709)%1000 h, (conv_id*131+turn*37+idx*17)%100 c, (conv_id*31+turn*17+idx div 3)%60 g from w),
        t as (select *, case when n_ch<=2 then 41+h%60 else 60+n_ch*55+h%120 end dur, case when idx=0 then 300+h%900 else 20+h%60+case when h%37=0 then 700 else 0 end end gap from h),
        q as (select *, cast(sum(dur+gap) over (partition by conv_id order by turn,idx rows between unbounded preceding and current row) as bigint) b_end from t),
        r as (select *, b_end-dur b_start from q),
        k as (select *, first_value(b_start) over (partition by conv_id,turn,idx div 3 order by idx) g_start, count(*) over (partition by conv_id,turn,idx div 3) g_n from r)
        select conv_id programme_id, turn segment_id, idx word_index, text, b_start ps,
          case when (g=0 and g_n=3 and (idx div 3)%2=0) or c=4 then b_start+3 else b_end end pe,
          case when g=0 and g_n=3 then g_start when c in (0,4) then b_start-3000 when c=52 then b_start+4000 else b_start+(h%7)-3 end s,
          case when g=0 and g_n=3 then g_start+1 when c=1 then b_start+(h%7)-3+10 when c=52 then b_end+4000
               when c=3 then b_start+(h%7)-3+case when n_ch<=2 then 39 else 25 end else b_end+(h%5)-2 end e
        from k""",
        src=src,
    )


def segments(spark: SparkSession, sf_dir: str, found: DataFrame | None = None) -> DataFrame:
    """One row per (programme, segment) that has words. found: the words, where they have
    been derived already."""
    w = words(spark, sf_dir) if found is None else found
    role = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").alias("programme_id"), F.col("turn").alias("segment_id"), "role")
    out = w.groupBy("programme_id", "segment_id").agg(F.min("ps").alias("start_ms"), F.max("pe").alias("end_ms"), F.count(F.lit(1)).alias("n_words"))
    return out.join(role, ["programme_id", "segment_id"])


def turns(spark: SparkSession, sf_dir: str, found: DataFrame | None = None) -> DataFrame:
    """Diarization turns: overlapping windows, some words uncovered, some split, some
    first words with another cluster. A segment has up to three."""
    s = segments(spark, sf_dir, found)
    n = F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2)
    key = F.col("programme_id") + F.col("segment_id")
    third = F.floor((F.col("end_ms") - F.col("start_ms")) / 3).cast("long")
    turn = lambda k, start, end: F.struct(F.concat(F.lit("SPEAKER_0"), (n + k) % 3).alias("cluster"), start.cast("long").alias("start_ms"), end.cast("long").alias("end_ms"))
    start, end = F.col("start_ms"), F.col("end_ms")
    found = F.array_compact(F.array(
        F.when(key % 11 != 0, turn(0, start - 100, end + (F.col("segment_id") * 97) % 400)), F.when(key % 4 == 0, turn(1, end - third, end + 50)),
        F.when((key % 9 == 0) & (key % 11 != 0), turn(2, start - 150, start + 300)),
    ))
    out = s.select("programme_id", "segment_id", F.explode(found).alias("t"))
    return out.select("programme_id", "segment_id", "t.*", ((F.col("segment_id") * 37) % 100).cast("double").alias("confidence"))


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segments(spark, sf_dir)
    return s.select("programme_id", F.col("role").alias("speaker_id"), F.col("segment_id").alias("clip_no"), (F.col("end_ms") - F.col("start_ms")).alias("audio_dur_ms"), ((F.col("programme_id") * 13 + F.col("segment_id") * 7) % 160 - 40).alias("overrun_ms"))


def job_events(events: DataFrame) -> DataFrame:
    """Works on a batch table and on a stream."""
    k = F.get_json_object("props", "$.k").cast("long")
    state = F.create_map(*[F.lit(x) for x in ("signup", "waiting", "click", "active", "view", "completed", "error", "failed", "purchase", "delayed")])[F.col("event_type")]
    said = F.element_at(F.array(*[F.lit(x) for x in ("HTTP 429", "HTTP 503", "fetch failed", "HTTP 403: auth_required", "without usable speech", "")]), (k % 6 + 1).cast("int"))
    return events.select("event_id", (F.col("user_id") % 150).alias("job_id"), F.concat(F.lit("q"), F.col("user_id") % 31).alias("queue"), state.alias("state"), "ts", (k % 4).alias("attempt"), said.alias("message"), "value")


def engine_words(words: DataFrame) -> DataFrame:
    """Adds what the aligner said of each word: engine_unresolved, engine_reason, exhausted,
    confidence, by how much it widened its search, and in which pass it was placed."""
    k = F.col("programme_id") * 17 + F.col("segment_id") * 29 + F.col("word_index") * 13
    bad = k % 331 == 0
    reason = F.when(bad, F.when(k % 5 == 0, "search_region_exhausted").otherwise("no_acoustic_match"))
    return words.withColumns({"engine_unresolved": bad, "engine_reason": reason, "exhausted": (F.col("programme_id") + F.col("segment_id") * 3 + F.col("word_index") * 7) % 1201 == 0,
        "confidence": F.when(k % 10 != 0, (k % 64) / 64.0), "expansion_ms": F.when(k % 211 == 0, 300 + k % 700).otherwise(0), "alignment_pass": F.when(k % 211 == 0, 2).otherwise(1)})


def segment_table(spark: SparkSession, sf_dir: str, found: DataFrame | None = None) -> DataFrame:
    """Source segments as the attribution operator takes them."""
    src = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").alias("programme_id"), F.col("turn").alias("segment_id"), F.col("text").alias("source_text"))
    s = segments(spark, sf_dir, found).join(src, ["programme_id", "segment_id"])
    k = F.col("programme_id") + F.col("segment_id")
    status = F.when(k % 7 == 0, "edited").when(k % 13 == 0, "approved").otherwise("machine")
    music, carried = F.col("role") == "system", k % 5 == 0
    bare = music | ((k % 7 == 0) & (k % 21 == 0))
    return s.select(
        "programme_id", "segment_id", "start_ms", "end_ms", "source_text", status.alias("status"), music.alias("is_music"), (~bare).alias("has_words"),
        F.when(carried, F.col("start_ms") - 40).alias("carried_start"), F.when(carried, F.col("end_ms") + 40).alias("carried_end"),
        F.when(carried, "validated_words").alias("boundary_source"), F.when(k % 41 == 0, F.lit("2024-01-01")).alias("override"),
    )


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with text with music tags, confidence."""
    k = F.col("segment_id") * 31 + F.col("word_index")
    tag = (F.col("word_index") == 0) & ((F.col("programme_id") + F.col("segment_id")) % 6 == 0)
    w = words(spark, sf_dir).withColumns({"k": k, "conf": F.when(k % 7 != 0, (k % 100) / 100.0)})
    return w.withColumn("said", F.when(tag, F.concat(F.lit("[MUSIC] "), "text")).otherwise(F.col("text")))


def _by_segment(w: DataFrame, item: Column, *others: Column) -> DataFrame:
    """The items of each segment's words in order. Like all that is grouped here, segments
    stay where their programme's words are."""
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("word_index", item.alias("w")))), lambda x: x["w"])
    return w.groupBy("programme_id", "segment_id").agg(in_order.alias("words"), *others)


def _joined(name: str) -> Column:
    """The lists of a programme's segments as one, in order."""
    return F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("segment_id", name))), lambda x: x[name]))


def utterance_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """programme_id, raw: JSON of utterances over one list of words, in milliseconds."""
    item = F.struct(F.col("said").alias("text"), F.col("ps").alias("start"), F.col("pe").alias("end"), F.col("conf").alias("confidence"))
    s = _by_segment(_listed(spark, sf_dir), item, F.min("ps").alias("start"), F.max("pe").alias("last"))
    end = F.col("last") + F.when(F.col("segment_id") % 10 == 0, 600).otherwise(0)
    one = F.struct(F.chr(F.lit(65) + F.col("segment_id") % 3).alias("speaker"), "start", end.alias("end"), (F.lit(0.5) + F.col("segment_id") % 5 / 10.0).alias("confidence"))
    lists = s.withColumn("utterances", F.array(one)).groupBy("programme_id").agg(_joined("words").alias("words"), _joined("utterances").alias("utterances"), (F.max("last") / 1000.0).alias("audio_duration"))
    model = F.when(F.col("programme_id") % 2 == 0, "universal-2").otherwise("universal-3-5-pro")
    return lists.select("programme_id", F.to_json(F.struct("words", "utterances", "audio_duration", model.alias("speech_model_used"))).alias("raw"))


def stream_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """programme_id, raw: JSON of one stream of typed words, in seconds."""
    k = F.col("k")
    kind = F.when(k % 29 == 0, "spacing").when(k % 41 == 0, "audio_event").otherwise("word")
    text = F.when(kind == "audio_event", F.when(k % 82 == 0, "(music playing)").otherwise("(laughter)")).otherwise(F.col("text"))
    speaker = F.when(F.col("segment_id") % 3 != 0, F.concat(F.lit("speaker_"), F.col("segment_id") % 3))
    item = F.struct(text.alias("text"), (F.col("ps") / 1000.0).alias("start"), (F.col("pe") / 1000.0).alias("end"), F.col("conf").alias("confidence"), kind.alias("type"), speaker.alias("speaker_id"))
    lists = _by_segment(_listed(spark, sf_dir), item).groupBy("programme_id").agg(_joined("words").alias("words"))
    return lists.select("programme_id", F.to_json(F.struct("words")).alias("raw"))


def diarizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """programme_id, raw: JSON of speaker turns in seconds, some without speaker or end."""
    item = F.struct("start_ms", "end_ms", "cluster", "confidence", "programme_id")

    def turn(x):
        return F.struct(
            F.when((x["programme_id"] + x["start_ms"]) % 50 != 0, x["cluster"]).alias("speaker"), (x["start_ms"] / 1000.0).alias("start"),
            F.when(x["start_ms"] % 37 != 0, x["end_ms"] / 1000.0).alias("end"), F.create_map(x["cluster"], x["confidence"]).alias("confidence"))

    lists = turns(spark, sf_dir).groupBy("programme_id").agg(F.transform(F.sort_array(F.collect_list(item)), turn).alias("diarization"))
    return lists.select("programme_id", F.to_json(F.struct("diarization")).alias("raw"))


def timed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with their words nested; some lack them, some words are blank."""
    k = F.col("programme_id") + F.col("segment_id")
    text = F.when((F.col("segment_id") * 31 + F.col("word_index")) % 97 == 0, F.lit("  ")).otherwise(F.col("text"))
    item = F.struct("word_index", F.struct(text.alias("text"), F.col("ps").alias("start_ms"), F.col("pe").alias("end_ms")).alias("w"))
    lists = words(spark, sf_dir).groupBy("programme_id", "segment_id").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["w"]).alias("word_timings"))
    s = segment_table(spark, sf_dir).join(lists, ["programme_id", "segment_id"])
    return s.select("programme_id", "segment_id", "status", "is_music", F.when(F.col("has_words") & (k % 17 != 0), F.col("word_timings")).alias("word_timings"))
