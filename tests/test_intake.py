"""Golden cases of raw transcripts, publishing, chunked runs, streams and text rules."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cuelattice import staging
from cuelattice.functions import exprs as X
from cuelattice.operators import audit, chunked, evidence, lines, publish, rows, runs
from cuelattice.operators import transcripts as T


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_utterances_cut_merge_and_mark(spark):
    words = [("[MUSIC]", 0, 400), ("la", 500, 700), ("Hello", 2000, 2300), ("there.", 2350, 2900), ("Yes", 2950, 3100), ("so", 5000, 5200)]
    raw = {"words": [{"text": t, "start": s, "end": e, "confidence": 0.5} for t, s, e in words], "utterances": [{"speaker": "A", "start": 0, "end": 1500, "confidence": 0.9}, {"speaker": "B", "start": 1500, "end": 6000}], "audio_duration": 6.0, "speech_model_used": "universal-2"}
    df = spark.createDataFrame([(1, json.dumps(raw)), (2, "no json"), (3, None), (4, "{}")], "programme_id long, raw string")
    out = T.read_utterance_transcripts(df).orderBy("segment_id", "chunk").collect()
    assert [(r["speaker_ref"], r["text"], r["is_music"], r["n_words"]) for r in out] == [("A", "la", True, 2), ("B", "Hello there. Yes", False, 3), ("B", "so", False, 1)]
    assert {r["programme_id"] for r in T.unusable(df, T.read_utterance_transcripts(df)).collect()} == {2, 3, 4}
    done = T.transcribe_normalise(df, "utterances").orderBy("sequence_index").collect()
    assert [r["label"] for r in done] == ["Speaker A", "Speaker B", "Speaker B"] and done[0]["cost_usd"] == 0.0003 and done[1]["tc_in"] == "00:00:02;00"


def test_word_stream_runs(spark):
    items = [("a", 0.0, 0.2, "word", "speaker_0"), (" ", 0.2, 0.3, "spacing", None), ("(music)", 0.3, 2.0, "audio_event", "speaker_0"), ("(cough)", 2.0, 2.1, "audio_event", "speaker_0"), ("b", 2.2, 2.4, "word", None), ("c .", 2.5, 2.7, "word", "speaker_1")]
    raw = json.dumps({"words": [{"text": t, "start": s, "end": e, "type": k, "speaker_id": w} for t, s, e, k, w in items]})
    out = T.read_word_stream_transcripts(spark.createDataFrame([(1, raw)], "programme_id long, raw string")).orderBy("segment_id").collect()
    assert [(r["speaker_ref"], r["text"], r["is_music"]) for r in out] == [("speaker_0", "a", False), ("speaker_0", "(music)", True), ("speaker_0", "b", False), ("speaker_1", "c.", False)]


def test_transcripts_are_dealt_once_and_written_nowhere(spark):
    """A programme's words stay where its raw text is: only texts or raw rows are shuffled."""
    from cuelattice.plans import intake

    before = set(os.listdir(staging.folder(spark)))
    dealt = re.findall(r"Exchange .*", intake.pipe_08_transcripts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString())
    assert len(dealt) == 2 and all("hashpartitioning(conv_id" in x and "REPARTITION_BY_NUM" in x for x in dealt)
    raw = spark.createDataFrame([(1, "{}")], "programme_id long, raw string")
    for provider in ("utterances", "word_stream"):
        df = T.transcribe_normalise(raw, provider)
        assert len(re.findall(r"Exchange .*", df._jdf.queryExecution().executedPlan().toString())) <= 1 and df.count() == 0
    assert set(os.listdir(staging.folder(spark))) == before


def test_utterances_that_overlap_and_last_long(spark):
    """Words of several utterances, some of hours, some of no length, some without times."""
    rng = random.Random(3)
    words = [{"text": f"w{i}", "start": rng.choice([None, *[rng.randint(-5_000, 9_000_000)] * 9]), "end": i, "confidence": 0.5} for i in range(300)] + [None]
    ends = [(a := rng.randint(-5_000, 9_000_000), a + rng.choice([-5, 0, 900, 70_000, 700_000, 8_000_000])) for _ in range(25)]
    said = [{"speaker": "A", "start": a, "end": b} for a, b in [*ends, (None, 5), (5, None)]]
    raw = spark.createDataFrame([(p, json.dumps({"words": words, "utterances": said})) for p in (1, 2)], "programme_id long, raw string")
    got = {(r["programme_id"], r["segment_id"], t["text"]) for r in T.read_utterance_transcripts(raw).collect() for t in r["word_timings"]}
    assert got == {(p, k, w["text"]) for p in (1, 2) for k, (a, b) in enumerate(ends) for w in words if w and w["start"] is not None and a <= w["start"] < b}


def test_turns_and_words_with_rejects(spark):
    raw = json.dumps({"diarization": [{"speaker": "S1", "start": 2.0, "end": 3.0, "confidence": {"S1": 80}}, {"speaker": None, "start": 0, "end": 1}, {"speaker": "S0", "start": 1.0, "end": 1.5}]})
    turns, none = T.read_turns(spark.createDataFrame([(1, raw), (2, '{"diarization": []}')], "programme_id long, raw string"))
    assert [tuple(r)[1:] for r in turns.orderBy("turn_pos").collect()] == [(0, "S0", 1000, 1500, None), (1, "S1", 2000, 3000, 0.8)]
    assert [r[0] for r in none.collect()] == [2]
    seg = spark.createDataFrame([(1, 1, "machine", False, [("a", 0, 1), (" ", 1, 2)]), (1, 2, "machine", False, None), (1, 3, "edited", False, None), (2, 1, "machine", True, [])], "programme_id long, segment_id long, status string, is_music boolean, word_timings array<struct<text:string,start_ms:long,end_ms:long>>")
    words, bad = T.explode_words(seg)
    assert [(r["segment_id"], r["word_index"], r["text"]) for r in words.collect()] == [(1, 0, "a")]
    assert {tuple(r) for r in bad.collect()} == {(1, 2, "missing_word_timings"), (2, None, "no_words")}


def test_publish_needs_its_report(spark, tmp_path):
    s = spark.createDataFrame([(1, "a"), (2, "b")], "programme_id long, text string")
    report = s.groupBy("programme_id").agg(F.count(F.lit(1)).alias("n_rows"))
    assert publish.publish(s, report, str(tmp_path), "v1").count() == 2
    with pytest.raises(ValueError, match="without a report"):
        publish.publish(s, report.filter("programme_id = 1"), str(tmp_path), "v2")
    with pytest.raises(ValueError, match="other rows"):
        publish.publish(s, report.withColumn("n_rows", F.col("n_rows") + 1), str(tmp_path), "v3")
    assert publish.published(spark, str(tmp_path)).count() == 2


def test_captions_of_every_format(spark):
    cues = spark.createDataFrame([(1, 2, 61_001, 62_000, 'say "x"'), (1, 1, 0, 999, None)], "programme_id long, n long, start_ms long, end_ms long, text string")
    got = {f: publish.captions(cues, f).first()["content"] for f in publish.FORMATS}
    assert got["vtt"].startswith("WEBVTT\n\n00:00:00.000 --> 00:00:00.999\n\n\n00:01:01.001") and got["csv"].endswith('2,61001,62000,"say ""x"""')
    assert json.loads(got["json"])[1]["text"] == 'say "x"' and got["txt"] == '\nsay "x"'


def test_snapshot_keeps_and_prunes(spark, tmp_path):
    t = {"a": spark.range(3), "b": spark.range(0)}
    for d in ("2024-01-01", "2024-01-02"):
        m = publish.snapshot(t, str(tmp_path), d, 1)
    assert {(r["table_name"], r["dt"], r["kept"]) for r in m.collect()} >= {("a", "2024-01-01", False), ("a", "2024-01-02", True)}
    publish.prune(m, str(tmp_path))
    assert not (tmp_path / "a" / "dt=2024-01-01").exists() and (tmp_path / "a" / "dt=2024-01-02").exists()


def test_supersede_until_done(spark):
    c = spark.createDataFrame([(1, i, True, None, None) for i in range(3)], "project_id long, cue_id long, is_active boolean, superseded_by_run_id string, superseded_at timestamp")
    at = F.lit("2024-01-01").cast("timestamp")
    steps = []
    for _ in range(3):
        c, step = publish.supersede_cues(c, "r", at, 2, False)
        steps.append(tuple(step.first())[1:])
    assert steps == [(2, 1, "continue"), (1, 0, "done"), (0, 0, "done")]


def test_plan_numbers_ranges_like_one_sort(spark, monkeypatch):
    monkeypatch.setattr(chunked, "RANGE_ITEMS", 7)
    items = spark.createDataFrame([(r, i * i) for r in (1, 2) for i in range(40)], "run_id long, item_id long")
    got = {(r["run_id"], r["item_id"]): r["chunk_index"] for r in chunked.plan_run(items, 5).collect()}
    assert got == {(r, i * i): i // 5 for r in (1, 2) for i in range(40)}


def test_failure_classes(spark):
    said = {"HTTP 429": "rate_limited", "row 14290": "terminal", "HTTP 503: x": "gateway_timeout", "timed out": "transient", 'HTTP 409: {"stand_down": true}': "stand_down", 'HTTP 409: {"stand_down": "true"}': "terminal", 'HTTP 503: {"stand_down": true}': "gateway_timeout", 'HTTP 409: {"a": {"stand_down": true}}': "terminal"}
    assert {k: one(spark, X.failure_class(F.lit(k))) for k in said} == said


def test_text_rules(spark):
    assert one(spark, X.safe_name(F.lit("..a/b\x01c"))) == "a_b_c" and one(spark, X.safe_name(F.lit(None).cast("string"))) == "segment.wav"
    assert one(spark, X.speaker_label(F.lit("SPEAKER_03"), F.lit(9))) == "Speaker 4" and one(spark, X.provider_speaker_label(F.lit("B"), F.lit(0))) == "Speaker B"
    assert one(spark, X.job_key("poll")) == "poll-singleton" and one(spark, X.count_words(F.lit("a  b"), F.array())) == 0
    df = spark.createDataFrame([("Straße!",), ("Été",), ("ﬁn",), (None,)], "t string")
    assert [r[0] for r in df.select(evidence.token_nfkd("t")).collect()] == ["straße", "ete", "fin", ""]
    assert {one(spark, X.jittered_backoff_ms(F.lit(9), F.lit(s))) <= 20_000 for s in range(5)} == {True}


def test_severity_keeps_the_first_of_equals(spark):
    t = F.lit(True)
    found = one(spark, audit.most_severe((t, "alignment_collapse", F.lit(1)), (t, "unresolved_timing", F.lit(7)), (t, "unresolved_timing", F.lit(8))))
    assert (found["defect"], found["size"]) == ("unresolved_timing", 7)
    assert one(spark, audit.most_severe((F.lit(False), "alignment_collapse", F.lit(1)))) is None


def test_retry_header_and_stale_hash(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert [one(spark, evidence.retry_after_ms(F.lit(h), now)) for h in ("7", "Mon, 01 Jan 2024 00:00:10 GMT", "Mon, 01 Jan 2024 00:10:00 GMT", "soon")] == [7000, 10_000, 30_000, None]
    src = spark.createDataFrame([("a", "foobar")], "source_segment_id string, source_text string")
    tr = spark.createDataFrame([("a", "bf9cf968"), ("a", "0"), ("a", None)], "source_segment_id string, translated_from_source_hash string")
    assert sorted(str(r["stale"]) for r in lines.stale_from_source(tr, src).collect()) == ["False", "None", "True"]


def test_reseed_is_idempotent_and_shift_report_survives_nulls(spark):
    seg = spark.createDataFrame([(1, 1), (1, 2)], "programme_id long, segment_id long")
    seed = F.concat_ws(":", "programme_id", "segment_id", "lang")
    old = spark.createDataFrame([(1, 1, "de", "x"), (2, 1, "de", "y")], "programme_id long, segment_id long, lang string, row_id string")
    once = runs.reseed(old, seg, ("de", "fr"), seed)
    assert once.count() == 5 and sorted(map(tuple, once.collect())) == sorted(map(tuple, runs.reseed(once, seg, ("de", "fr"), seed).collect()))
    w = spark.createDataFrame([(1, 1, 0, None, None, None, None)], "programme_id long, segment_id long, word_index long, s long, e long, ps long, pe long")
    assert rows.shift_report(w).first()["verdict"] == "unmeasured"
