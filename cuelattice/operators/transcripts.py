"""Providers' raw transcripts and diarizations, read from JSON text into flat rows:
speech segments, evidence words, speaker turns, and what has to be rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import evidence, intervals
from .speakers import authoritative

#: Fixed values that results depend on.
PAUSE_MS, MUSIC_WORDS, FRAME_RATE = 650, 6, 25
MUSIC_TEXT = "♪ Music ♪"
#: Dollars per audio second.
RATES = {"universal-2": 0.00004583, "universal-3-5-pro": 0.000076389, "scribe_v2": 0.000111}

_WORD = "text:string,start:double,end:double,confidence:double,type:string,speaker_id:string"
RAW = f"struct<words:array<struct<{_WORD}>>,utterances:array<struct<speaker:string,start:double,end:double,confidence:double>>,language_code:string,audio_duration:double,speech_model_used:string>"
DIARIZATION = "struct<diarization:array<struct<speaker:string,start:double,end:double,confidence:map<string,double>>>>"


def parsed(raw: DataFrame, schema: str = RAW) -> DataFrame:
    """raw (programme_id, raw) with the JSON text as column `r`; text that is no JSON,
    and fields of another type, become null. Rows that have `r` stay as they are."""
    return raw if "r" in raw.columns else raw.withColumn("r", F.from_json("raw", schema, {"mode": "PERMISSIVE"}))


def with_content_hash(raw: DataFrame, column: str = "raw") -> DataFrame:
    """SHA-256 of the stored text, null where there is none."""
    return raw.withColumn("content_sha256", F.sha2(F.col(column), 256))


def _rollup(words: DataFrame, *keys: str, whole: Column | None = None) -> DataFrame:
    """words (programme_id, segment_id, word_index, text, start_ms, end_ms, confidence, keys: alike
    in a segment) -> one row per chunk, word texts in order. Chunks are cut after a sentence's
    end or a pause, short fragments merged; segments that are `whole` stay so. Nothing is joined,
    so words dealt by programme are not dealt out again."""
    order = Window.partitionBy("programme_id", "segment_id").orderBy("word_index")
    cut = X.sentence_end(F.trim(F.lag("text").over(order))) | (F.col("start_ms") - F.lag("end_ms").over(order) >= PAUSE_MS)
    cut = cut if whole is None else cut & ~whole
    w = words.withColumn("piece", F.sum(F.coalesce(cut, F.lit(False)).cast("long")).over(order))
    pieces = w.groupBy("programme_id", "segment_id", *keys, "piece").agg(F.sort_array(F.collect_list(F.struct("word_index", "text", "start_ms", "end_ms", "confidence"))).alias("words"))
    ends = {"start_ms": F.element_at("words", 1)["start_ms"], "end_ms": F.element_at("words", -1)["end_ms"], "n_words": F.size("words").cast("long")}
    merged = evidence.merge_fragments(pieces.withColumns(ends), *keys, "words").withColumnRenamed("merged", "chunk")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("piece", "words"))), lambda x: x["words"])
    said = F.filter(F.transform("words", lambda x: x["confidence"]), lambda x: x.isNotNull())
    timing = lambda x: F.struct(x["word_index"], x["text"], x["start_ms"], x["end_ms"], F.round(x["confidence"], 4).alias("confidence"))
    return merged.groupBy("programme_id", "segment_id", "chunk", *keys).agg(F.flatten(parts).alias("words")).select(
        "programme_id", "segment_id", "chunk", *keys, *[x.alias(c) for c, x in ends.items()],
        F.when(F.size(said) > 0, F.aggregate(said, F.lit(0.0), lambda a, x: a + x) / F.size(said)).alias("avg_word_confidence"),
        F.array_join(F.transform("words", lambda x: x["text"]), " ").alias("_joined"), F.transform("words", timing).alias("word_timings"),
    )


def music_mark(joined: Column) -> Column:
    """struct(text, is_music, music_context) of a text that may carry [MUSIC] tags."""
    marked = joined.rlike(r"(?i)\[/?MUSIC\]")
    text = F.trim(F.regexp_replace(joined, r"(?i)\[/?MUSIC\]", ""))
    music = marked & (F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")) < MUSIC_WORDS)
    shown = F.when(text != "", text).when(music, F.lit(MUSIC_TEXT)).otherwise("")
    return F.struct(shown.alias("text"), music.alias("is_music"), F.when(music, "foreground").when(marked, "background").otherwise("none").alias("music_context"))


_SEGMENT = ["programme_id", "segment_id", "chunk", "speaker_ref", "start_ms", "end_ms", "n_words", "text", "confidence", "avg_word_confidence", "is_music", "music_context", "music_source", "word_timings"]


def read_utterance_transcripts(raw: DataFrame) -> DataFrame:
    """Transcripts of utterances over one list of words, times in milliseconds. A word
    belongs to every utterance it begins in; segment_id is the utterance's number."""
    return _utterances(parsed(raw)).select(*_SEGMENT)


def _utterances(p: DataFrame, *kept: str) -> DataFrame:
    """kept: columns of p (programme_id, r) that stay."""
    item = lambda spoken, label: lambda x, n: F.struct(n.cast("long").alias("n"), F.lit(spoken).alias("spoken"), x[label].alias("label"), x["start"].alias("start"), x["end"].alias("end"), x["confidence"].alias("confidence"))
    p = intervals.with_levels(p, F.transform("r.utterances", lambda u: X.half_up(u["end"]) - X.half_up(u["start"])))
    x = p.select("programme_id", "levels", *kept, F.explode(F.concat(F.transform("r.words", item(False, "text")), F.transform("r.utterances", item(True, "speaker")))).alias("x")).select("programme_id", "levels", *kept, "x.*")
    span = F.struct(F.col("n").alias("segment_id"), F.col("label").alias("speaker_ref"), F.col("confidence").alias("_said"), X.half_up(F.col("start")).alias("start_ms"), X.half_up(F.col("end")).alias("end_ms"), *kept)
    w = x.select("programme_id", "levels", F.when(F.col("spoken"), span).alias("span"), F.col("n").alias("word_index"), F.col("label").alias("text"), X.half_up(F.col("start")).alias("s"), X.half_up(F.col("end")).alias("e"), "confidence")
    keys = ["speaker_ref", "_said", *kept]
    inside = intervals.points_by(w).select("programme_id", "span.segment_id", "word_index", "text", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"), "confidence", *[f"span.{k}" for k in keys])
    out = _rollup(inside, *keys)
    out = out.withColumn("_m", music_mark(F.trim(F.regexp_replace("_joined", r"(?U)\s+", " ")))).select("*", "_m.*")
    return out.withColumns({"confidence": F.col("_said"), "avg_word_confidence": F.coalesce("avg_word_confidence", "_said"), "music_source": F.when(F.col("is_music"), "aai_u3_prompt")})


def read_word_stream_transcripts(raw: DataFrame) -> DataFrame:
    """Transcripts that are one stream of typed words, times in seconds. segment_id
    numbers the runs of one speaker and of music or speech; music is not cut further."""
    return _word_stream(parsed(raw)).select(*_SEGMENT)


def _word_stream(p: DataFrame, *kept: str) -> DataFrame:
    """kept: columns of p (programme_id, r) that stay."""
    order = Window.partitionBy("programme_id").orderBy("word_index")
    w = p.select("programme_id", *kept, F.posexplode("r.words").alias("word_index", "w"))
    kind, text = F.coalesce("w.type", F.lit("")), F.coalesce("w.text", F.lit(""))
    music = (kind == "audio_event") & text.rlike("(?i)music|song|singing")
    w = w.filter((kind != "spacing") & ((kind != "audio_event") | music))
    ms = lambda c: X.half_up(F.coalesce(F.col(c), F.lit(0.0)) * 1000)
    speaker = F.when(F.coalesce("w.speaker_id", F.lit("")) == "", "speaker_0").otherwise(F.col("w.speaker_id"))
    w = w.select("programme_id", *kept, F.col("word_index").cast("long"), text.alias("text"), ms("w.start").alias("start_ms"), ms("w.end").alias("end_ms"), F.col("w.confidence").alias("confidence"), speaker.alias("speaker_ref"), music.alias("is_music"))
    change = (F.lag("speaker_ref").over(order) != F.col("speaker_ref")) | (F.lag("is_music").over(order) != F.col("is_music"))
    w = w.withColumn("segment_id", F.sum(F.coalesce(change, F.lit(False)).cast("long")).over(order))
    out = _rollup(w, "speaker_ref", "is_music", *kept, whole=F.col("is_music"))
    tidy = F.trim(F.regexp_replace(F.regexp_replace("_joined", r"(?U)\s+([,.;:!?])", "$1"), r"(?U)\s+", " "))
    return out.withColumns({"text": tidy, "confidence": F.col("avg_word_confidence"), "music_context": F.when(F.col("is_music"), "foreground").otherwise("none"), "music_source": F.when(F.col("is_music"), "scribe_audio_events")})


def with_speakers(segments: DataFrame) -> DataFrame:
    """segments with their speaker's place in the order of first appearance in the programme,
    label, colour index and number of segments."""
    own = Window.partitionBy("programme_id", "speaker_ref")
    s = segments.withColumns({"_first": F.min(F.struct("segment_id", "chunk")).over(own), "segment_count": F.count(F.lit(1)).over(own)})
    s = s.withColumn("speaker_index", (F.dense_rank().over(Window.partitionBy("programme_id").orderBy("_first")) - 1).cast("long")).drop("_first")
    return s.withColumns({"label": X.provider_speaker_label(F.col("speaker_ref"), F.col("speaker_index")), "colour": F.col("speaker_index") % X.SPEAKER_COLOURS})


def transcript_speakers(segments: DataFrame) -> DataFrame:
    """Speakers of each programme in order of first appearance: label, colour index and
    number of segments."""
    return with_speakers(segments).select("programme_id", "speaker_ref", "speaker_index", "label", "colour", "segment_count").distinct()


def transcribe_normalise(raw: DataFrame, provider: str, frame_rate: int = FRAME_RATE) -> DataFrame:
    """raw (programme_id, raw) of one provider, a programme a row -> the transcript's rows in order,
    with speaker, timecodes and the programme's cost; rows without a speaker are left out. Each
    text is parsed once, and all that follows is grouped by programme: raw rows are dealt out once
    at most, words never, and nothing is written between."""
    p = parsed(raw)
    if provider == "utterances":
        p = p.select("programme_id", "r", X.half_up(F.coalesce("r.audio_duration", F.lit(0.0)) * 1000).alias("duration_ms"), F.coalesce("r.speech_model_used", F.lit("universal-3-5-pro")).alias("model"))
        segs, rate = _utterances(p, "duration_ms", "model"), F.when(F.col("model") == "universal-2", RATES["universal-2"]).otherwise(RATES["universal-3-5-pro"])
    else:
        p = p.select("programme_id", "r", X.half_up(F.coalesce(F.try_element_at("r.words", F.lit(-1))["end"], F.lit(0.0)) * 1000).alias("duration_ms"))
        segs, rate = _word_stream(p, "duration_ms").withColumn("model", F.lit("scribe_v2")), F.lit(RATES["scribe_v2"])
    rows = with_speakers(segs.select(*_SEGMENT, "duration_ms", "model").filter("speaker_ref is not null"))
    n = F.row_number().over(Window.partitionBy("programme_id").orderBy("segment_id", "chunk")) - 1
    usd = F.floor(F.col("duration_ms") / 1000.0 * rate * 10_000 + 0.5) / 10_000
    return rows.withColumns({"cost_usd": usd.cast("double"), "sequence_index": n.cast("long"), "tc_in": X.timecode(F.col("start_ms"), frame_rate), "tc_out": X.timecode(F.col("end_ms"), frame_rate)})


def unusable(raw: DataFrame, segments: DataFrame) -> DataFrame:
    """Programmes whose transcript has no speech segment."""
    return raw.select("programme_id").join(segments.select("programme_id").distinct(), "programme_id", "left_anti")


def primary_words(raw: DataFrame) -> DataFrame:
    """Evidence words of an utterance transcript: key `p:{place in the list}`."""
    w = parsed(raw).select("programme_id", F.posexplode("r.words").alias("n", "w"))
    out = w.select("programme_id", F.concat(F.lit("p:"), "n").alias("key"), F.trim(F.coalesce("w.text", F.lit(""))).alias("text"), X.half_up(F.col("w.start")).alias("s"), X.half_up(F.col("w.end")).alias("e"))
    return out.filter("text <> '' and s is not null and e is not null")


def word_stream(raw: DataFrame) -> DataFrame:
    """The typed words of a stream, as `evidence.secondary_words` takes them."""
    w = parsed(raw).select("programme_id", F.posexplode("r.words").alias("n", "w"))
    return w.select("programme_id", "n", F.col("w.type").alias("kind"), F.trim(F.coalesce("w.text", F.lit(""))).alias("text"), F.coalesce("w.start", F.lit(0.0)).alias("start_s"), F.coalesce("w.end", F.lit(0.0)).alias("end_s"))


def evidence_words(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Both providers' words in one table, told apart by their keys."""
    return primary.select("programme_id", "key", "text", "s", "e").unionByName(secondary.select("programme_id", "key", "text", "s", "e"))


def read_turns(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """raw (programme_id, raw) -> turns (programme_id, turn_pos, cluster, start_ms,
    end_ms, confidence) in order of start, and the programmes that have none."""
    t = parsed(raw, DIARIZATION).select("programme_id", F.posexplode("r.diarization").alias("n", "t"))
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    t = t.filter((F.coalesce("t.speaker", F.lit("")) != "") & number(F.col("t.start")) & number(F.col("t.end")))
    pos = F.row_number().over(Window.partitionBy("programme_id").orderBy("t.start", "n")) - 1
    own = F.try_element_at("t.confidence", F.col("t.speaker"))
    turns = t.select("programme_id", pos.cast("long").alias("turn_pos"), F.col("t.speaker").alias("cluster"), X.half_up(F.col("t.start") * 1000).alias("start_ms"), X.half_up(F.col("t.end") * 1000).alias("end_ms"), X.confidence_norm(own).alias("confidence"))
    return turns, raw.select("programme_id").distinct().join(turns.select("programme_id").distinct(), "programme_id", "left_anti")


def explode_words(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """segments (programme_id, segment_id, status, is_music, word_timings: array of text,
    start_ms, end_ms) -> words with their place in the list, blank ones left out; and
    what stops a programme: segments without words that are neither music nor authored,
    and programmes without any word (segment_id null)."""
    w = segments.select("programme_id", "segment_id", F.posexplode("word_timings").alias("word_index", "w"))
    w = w.select("programme_id", "segment_id", F.col("word_index").cast("long"), F.trim(F.coalesce("w.text", F.lit(""))).alias("text"), F.col("w.start_ms").alias("ps"), F.col("w.end_ms").alias("pe")).filter("text <> ''")
    bare = (F.coalesce(F.size("word_timings"), F.lit(0)) < 1) & ~F.coalesce("is_music", F.lit(False)) & ~authoritative(F.col("status"))
    lacking = segments.filter(bare).select("programme_id", "segment_id", F.lit("missing_word_timings").alias("fault"))
    none = segments.select("programme_id").distinct().join(w.select("programme_id").distinct(), "programme_id", "left_anti")
    return w, lacking.unionByName(none.select("programme_id", F.lit(None).cast("long").alias("segment_id"), F.lit("no_words").alias("fault")))


def with_aligned(words: DataFrame, aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """words joined with aligned (programme_id, segment_id, word_index, s, e) by key, and
    the words that no aligned one answers."""
    key = ["programme_id", "segment_id", "word_index"]
    return words.join(aligned.select(*key, "s", "e"), key, "left"), words.select(*key).join(aligned.select(*key), key, "left_anti")


def provider_windows(words: DataFrame, windows: DataFrame) -> DataFrame:
    """words with ps, pe of windows (programme_id, key, start_ms, end_ms) by their key
    `{segment}:{index}`; null where there is none."""
    w = windows.select("programme_id", F.col("key").alias("_key"), F.col("start_ms").alias("ps"), F.col("end_ms").alias("pe"))
    key = F.concat_ws(":", "segment_id", "word_index")
    return words.withColumn("_key", key).join(w, ["programme_id", "_key"], "left").drop("_key")


def sources_within(rows: DataFrame) -> DataFrame:
    """rows (start_ms, end_ms, sources: array of start_ms, end_ms, ...) with only those
    sources that reach into the row's window."""
    keep = lambda x: (x["end_ms"] > F.col("start_ms")) & (x["start_ms"] < F.col("end_ms"))
    return rows.withColumn("sources", F.filter("sources", lambda x: F.coalesce(keep(x), F.lit(False))))


def duo_evidence(primary: DataFrame, secondary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alignment runs (see `evidence.alignment_gate`, with audio_sha256 and word_count) of
    two providers -> one row per programme that both verify over the same audio, and the
    others with the reason."""
    side = lambda df, n: evidence.alignment_gate(df).select("programme_id", *[F.col(c).alias(f"{n}_{c}") for c in ("verdict", "audio_sha256", "word_count", "mean_confidence", "p99_shift", "outlier_ratio")])
    both = side(primary, "primary").join(side(secondary, "secondary"), "programme_id", "full")
    reason = (
        F.when((F.coalesce("primary_word_count", F.lit(0)) == 0) | (F.coalesce("secondary_word_count", F.lit(0)) == 0), "missing_stream")
        .when(F.col("primary_verdict") != "pass", F.concat(F.lit("primary:"), "primary_verdict")).when(F.col("secondary_verdict") != "pass", F.concat(F.lit("secondary:"), "secondary_verdict"))
        .when(~F.col("primary_audio_sha256").eqNullSafe(F.col("secondary_audio_sha256")), "different_audio")
    )
    both = both.withColumn("reason", reason)
    return both.filter("reason is null").drop("reason", "primary_verdict", "secondary_verdict"), both.filter("reason is not null").select("programme_id", "reason")
