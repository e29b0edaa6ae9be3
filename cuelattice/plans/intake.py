"""Queries over raw transcripts, evidence, publishing and whole runs, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..ledger import Conflict, Ledger
from ..operators import audit, chunked, evidence, publish, rows
from ..operators import transcripts as T
from ..sources import derived as D
from ..staging import folder
from .oracles import _TURNS, _W

_R = "with recursive " + _W.removeprefix("with recursive ")
_END = r"""'[.!?…。！？]["''”’)\]]*$'"""


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _six(c):
    return F.floor(F.col(c) * 1e6 + 0.501) / 1e6  # exact halves go up whatever the sum's last bit


_FLAT = ["programme_id", "segment_id", "chunk", "speaker_ref", "start_ms", "end_ms", "n_words", "text", "is_music", "music_context", "music_source"]


def src_01_utterances(spark, sf_dir):
    return T.read_utterance_transcripts(D.utterance_transcripts(spark, sf_dir)).select(*_FLAT, _six("confidence").alias("confidence"), _six("avg_word_confidence").alias("avg_word_confidence"))


def src_02_word_stream(spark, sf_dir):
    return T.read_word_stream_transcripts(D.stream_transcripts(spark, sf_dir)).select(*_FLAT, _six("avg_word_confidence").alias("avg_word_confidence"))


def src_03_primary_words(spark, sf_dir):
    return T.primary_words(D.utterance_transcripts(spark, sf_dir))


def set_01_evidence_words(spark, sf_dir):
    return T.evidence_words(T.primary_words(D.utterance_transcripts(spark, sf_dir)), evidence.secondary_words(T.word_stream(D.stream_transcripts(spark, sf_dir))))


def src_05_turns(spark, sf_dir):
    return T.read_turns(D.diarizations(spark, sf_dir))[0]


def src_06_words(spark, sf_dir):
    return T.explode_words(D.timed_segments(spark, sf_dir))[0]


def src_06_rejects(spark, sf_dir):
    return T.explode_words(D.timed_segments(spark, sf_dir))[1]


def src_07_content_hash(spark, sf_dir):
    return T.with_content_hash(_t(spark, sf_dir, "conversations"), "text").select("conv_id", "turn", "content_sha256")


def src_08_event_log(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    path = f"{folder(spark)}/log-{uuid.uuid4().hex}"
    log = e.select("ts", F.col("event_type").alias("event"), F.when(F.col("event_id") % 3 == 0, "warn").alias("level"), F.col("value").alias("duration_ms"))
    publish.append_events(log.filter("duration_ms < 50"), path)
    publish.append_events(log.filter("duration_ms >= 50"), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("dt").cast("string").alias("dt"), "level", "event").agg(F.count(F.lit(1)).alias("n_events"))


def snk_01_publish(spark, sf_dir):
    s = D.segments(spark, sf_dir)
    report = s.groupBy("programme_id").agg(F.count(F.lit(1)).alias("n_rows"))
    path = f"{folder(spark)}/published-{uuid.uuid4().hex}"
    publish.publish(s.filter("n_words > 3"), s.filter("n_words > 3").groupBy("programme_id").agg(F.count(F.lit(1)).alias("n_rows")), path, "v1")
    return publish.publish(s, report, path, "v2").select("programme_id", "segment_id", "role", "start_ms", "end_ms", "n_words")


def snk_01_publish_over(spark, sf_dir):
    """Two writers that started from the same version: the second one is refused."""
    s, path = D.segments(spark, sf_dir), f"{folder(spark)}/published-{uuid.uuid4().hex}"
    count = lambda df: df.groupBy("programme_id").agg(F.count(F.lit(1)).alias("n_rows"))
    base = Ledger(spark, path).current()
    publish.publish_over(s, count(s), path, base)
    fewer = s.filter("n_words > 3")
    try:
        publish.publish_over(fewer, count(fewer), path, base)
    except Conflict:
        pass
    return publish.current_segments(spark, path).select("programme_id", "segment_id", "role", "start_ms", "end_ms", "n_words")


def snk_02_captions(spark, sf_dir):
    text = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("programme_id"), F.col("turn").alias("segment_id"), "text")
    cues = D.segments(spark, sf_dir).join(text, ["programme_id", "segment_id"]).withColumn("n", F.col("segment_id") + 1)
    out = None
    for fmt in publish.FORMATS:
        part = publish.captions(cues, fmt)
        out = part if out is None else out.unionByName(part)
    return out


def snk_03_snapshot(spark, sf_dir):
    path = f"{folder(spark)}/snapshots-{uuid.uuid4().hex}"
    tables = {n: _t(spark, sf_dir, n) for n in ("customer", "orders", "part")}
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        manifest = publish.snapshot(tables, path, day, 2)
    return manifest


def jn_03_aligned(spark, sf_dir):
    w = D.words(spark, sf_dir)
    k = F.col("segment_id") * 31 + F.col("word_index")
    joined, missing = T.with_aligned(w.drop("s", "e"), w.filter(k % 101 != 0))
    return joined.join(missing.withColumn("missing", F.lit(True)), ["programme_id", "segment_id", "word_index"], "left").select("programme_id", "segment_id", "word_index", "s", "e", F.coalesce("missing", F.lit(False)).alias("missing"))


def jn_04_provider_windows(spark, sf_dir):
    w = D.words(spark, sf_dir)
    k = F.col("segment_id") * 31 + F.col("word_index")
    windows = w.filter(k % 13 != 0).select("programme_id", F.concat_ws(":", "segment_id", "word_index").alias("key"), F.col("ps").alias("start_ms"), F.col("pe").alias("end_ms"))
    out = T.provider_windows(w.drop("ps", "pe"), windows)
    return out.select("programme_id", "segment_id", "word_index", "s", "e", "ps", "pe")


def jn_08_sources(spark, sf_dir):
    src = D.words(spark, sf_dir).groupBy("programme_id", "segment_id").agg(F.sort_array(F.collect_list(F.struct(F.col("ps").alias("start_ms"), F.col("pe").alias("end_ms")))).alias("sources"))
    s = D.segments(spark, sf_dir).join(src, ["programme_id", "segment_id"])
    third = F.floor((F.col("end_ms") - F.col("start_ms")) / 3).cast("long")
    s = s.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    s = s.withColumns({"end_ms": F.when(F.col("part") == 2, F.col("end_ms")).otherwise(F.col("start_ms") + third * (F.col("part") + 1)), "start_ms": F.col("start_ms") + third * F.col("part")})
    out = T.sources_within(s)
    return out.select("programme_id", "segment_id", "part", F.size("sources").cast("long").alias("n"), F.try_element_at("sources", F.lit(1))["start_ms"].alias("first_start"), F.array_max(F.transform("sources", lambda x: x["end_ms"])).alias("last_end"))


def _alignments(spark, sf_dir):
    r = rows.shift_report(D.words(spark, sf_dir)).drop("verdict")
    p = F.col("programme_id")
    one = r.withColumns({"verified": p % 17 != 0, "mean_confidence": (p % 10) / 10.0 + 0.4, "outlier_ratio": F.when(p % 5 == 0, F.col("outliers") / F.col("word_count")), "audio_sha256": F.sha2(p.cast("string"), 256)})
    two = one.filter(p % 19 != 0).withColumns({"mean_confidence": (p % 7) / 10.0 + 0.3, "audio_sha256": F.when(p % 9 != 0, F.col("audio_sha256"))})
    return T.duo_evidence(one, two)


def pipe_09_duo_evidence(spark, sf_dir):
    out = _alignments(spark, sf_dir)[0]
    return out.select("programme_id", "primary_audio_sha256", "primary_word_count", "secondary_word_count", _six("primary_mean_confidence").alias("primary_mean"), _six("secondary_mean_confidence").alias("secondary_mean"))


def jn_09_refused(spark, sf_dir):
    return _alignments(spark, sf_dir)[1]


def pipe_08_transcripts(spark, sf_dir):
    cols = ["programme_id", "provider", "sequence_index", "label", "colour", "tc_in", "tc_out", "text", "model", "duration_ms", "cost_usd"]
    a = T.transcribe_normalise(D.utterance_transcripts(spark, sf_dir), "utterances").withColumn("provider", F.lit("utterances"))
    b = T.transcribe_normalise(D.stream_transcripts(spark, sf_dir), "word_stream").withColumn("provider", F.lit("word_stream"))
    return a.select(*cols).unionByName(b.select(*cols))


def fn_05_speaker_labels(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    ref = F.when(k % 4 == 0, F.concat(F.lit("Speaker_"), k)).when(k % 4 == 1, F.concat(F.lit("speaker "), k % 7)).when(k % 4 == 2, F.lit("")).otherwise(F.col("s_name"))
    return s.select("s_suppkey", X.speaker_label(ref, k % 5).alias("label"), X.provider_speaker_label(ref, k % 5).alias("provider_label"))


def fn_10_file_names(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.when(k % 11 == 0, F.lit("")).when(k % 5 == 0, F.concat(F.lit("..a/b:c*"), "p_name")).otherwise(F.repeat("p_name", F.when(k % 7 == 0, 9).otherwise(1)))
    return p.select("p_partkey", X.slug(name).alias("slug"), X.safe_name(name).alias("safe"), X.count_words(F.col("p_name")).alias("n_words"))


def fn_15_job_keys(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", X.job_key("cascade", F.col("o_orderkey")).alias("key"), X.job_key(F.lower("o_orderpriority"), F.col("o_custkey"), F.col("o_orderkey")).alias("key2"))


def fn_16_backoff(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    n = F.col("event_id") % 7 + 1
    return e.select("event_id", X.backoff_ms(F.lit(2000), 5.0, n, 600_000).alias("fixed"), X.jittered_backoff_ms(n, F.col("event_id")).alias("jittered"))


def fn_12_retry_after(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.col("event_id") % 4
    header = F.when(k == 0, (F.col("event_id") % 60).cast("string")).when(k == 1, F.lit("soon")).otherwise(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    now = F.date_trunc("minute", "ts")
    return e.select("event_id", evidence.retry_after_ms(header, now).alias("retry_ms"))


def fn_14_word_clamps(spark, sf_dir):
    item = F.struct("word_index", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"), F.col("ps").alias("provider_start_ms"), F.col("pe").alias("provider_end_ms"))
    g = D.words(spark, sf_dir).groupBy("programme_id", "segment_id").agg(F.sort_array(F.collect_list(item)).alias("words"), (F.max("e") - 120).alias("boundary"))
    g = g.withColumn("clamped", audit.clamp_words(F.col("words"), F.col("boundary")))
    return g.select("programme_id", "segment_id", audit.would_erase(F.col("words"), F.col("boundary")).alias("erases"), audit.recompute_max_shift(F.col("clamped")).alias("max_shift"), F.aggregate("clamped", F.lit(0).cast("long"), lambda a, w: a + w["end_ms"]).alias("ends"))


_SAID = ("HTTP 429: slow down", "HTTP 503", "row 14290 failed", "HTTP 403: auth_required", "HTTP 403: denied", 'HTTP 409: {"stand_down": true, "message": "x"}', 'HTTP 409: {"stand_down": "true"}', "socket timed out", "read ECONNRESET", "Rate limit reached", "provider error", "")
_CLASS = ("rate_limited", "gateway_timeout", "terminal", "auth_rejected", "terminal", "stand_down", "terminal", "transient", "transient", "rate_limited", "terminal", "none")


def prd_17_failure_classes(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    said = F.element_at(F.array(*[F.lit(x) for x in _SAID]), (F.col("event_id") % len(_SAID) + 1).cast("int"))
    return e.select("event_id", X.failure_class(said).alias("failure"))


def pipe_11_supersede(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    cues = o.select(F.col("o_custkey").alias("project_id"), F.col("o_orderkey").alias("cue_id"), (F.col("o_orderkey") % 5 != 0).alias("is_active"), F.lit(None).cast("string").alias("superseded_by_run_id"), F.lit(None).cast("timestamp").alias("superseded_at"))
    return publish.supersede_cues(cues, "run-7", F.lit("2024-02-01").cast("timestamp"), 5, True)[0].select("project_id", "cue_id", "is_active", "superseded_by_run_id")


def pipe_11_next_steps(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    cues = o.select(F.col("o_custkey").alias("project_id"), F.col("o_orderkey").alias("cue_id"), (F.col("o_orderkey") % 5 != 0).alias("is_active"), F.lit(None).cast("string").alias("superseded_by_run_id"), F.lit(None).cast("timestamp").alias("superseded_at"))
    return publish.supersede_cues(cues, "run-7", F.lit("2024-02-01").cast("timestamp"), 5, True)[1]


def _run(spark, sf_dir):
    items = _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 10).alias("run_id"), F.col("o_orderkey").alias("item_id"), F.col("o_totalprice").alias("price"))
    plan = chunked.plan_run(items, 20).groupBy("run_id", "chunk_index", "chunk_key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("decimal(20,2)")).cast("double").alias("cost"))
    k = F.col("run_id") + F.col("chunk_index")
    done = plan.filter(k % 17 != 0)
    ok = k % 13 != 0
    results = done.select("run_id", "chunk_key", ok.alias("ok"), F.col("n").alias("processed"), F.when(ok, F.col("n")).otherwise(0).alias("succeeded"), F.when(ok, F.lit(0)).otherwise(F.col("n") - 1).alias("failed"), F.when(ok, F.lit(0)).otherwise(1).alias("skipped"), (F.col("n") * 40).alias("characters"), F.col("cost").alias("cost_usd"))
    return chunked.run_state(plan, results, 9_000_000.0)


def pipe_12_chunk_steps(spark, sf_dir):
    return _run(spark, sf_dir)[0]


def pipe_12_run_states(spark, sf_dir):
    return _run(spark, sf_dir)[1].withColumn("cost_usd", F.floor(F.col("cost_usd") * 100 + 0.5).cast("long"))


def _stems(spark, sf_dir):
    c = D.clips(spark, sf_dir)
    c = c.withColumn("overrun_ms", F.when(F.col("programme_id") % 10 == 0, F.col("overrun_ms")).otherwise(F.lit(0))).withColumn("start_ms", F.col("clip_no") * 1000)
    c = c.withColumn("audio_dur_ms", F.when((F.col("programme_id") % 14 != 0) | (F.col("clip_no") % 6 != 0), F.col("audio_dur_ms")))
    return chunked.speaker_stems(c, c.select("speaker_id").distinct().withColumn("label", F.concat(F.lit("The "), "speaker_id")), "en", 500)


def pipe_13_stem_files(spark, sf_dir):
    return _stems(spark, sf_dir)[1]


def pipe_13_refused(spark, sf_dir):
    return _stems(spark, sf_dir)[2]


_LISTED = r""",
ul as (select programme_id, segment_id, word_index, ps, pe, segment_id*31+word_index k, row_number() over (partition by programme_id order by segment_id, word_index)-1 n, case when word_index=0 and (programme_id+segment_id)%6=0 then '[MUSIC] '||text else text end said, text,
  case when (segment_id*31+word_index)%7<>0 then ((segment_id*31+word_index)%100)/100.0::double end conf from words),
uu as (select programme_id, segment_id utt, min(ps) us, max(pe)+case when segment_id%10=0 then 600 else 0 end ue, chr(cast(65+segment_id%3 as int)) sp, 0.5::double+(segment_id%5)/10.0::double uc from words group by programme_id, segment_id),
aw as (select w.programme_id, u.utt segment_id, w.n word_index, said as text, ps st, pe en, conf, sp, uc from ul w join uu u on w.programme_id=u.programme_id and ps>=us and ps<ue),
s0 as (select programme_id, n, k, ps, pe, conf, case when k%41=0 then case when k%82=0 then '(music playing)' else '(laughter)' end else text end as text, k%41=0 ev, case when segment_id%3=0 then 'speaker_0' else 'speaker_'||(segment_id%3) end sp from ul where k%29<>0),
s1 as (select *, ev music from s0 where not ev or k%82=0),
s2 as (select *, case when sp<>lag(sp) over o or music<>lag(music) over o then 1 else 0 end ch from s1 window o as (partition by programme_id order by n)),
sw0 as (select programme_id, cast(sum(ch) over (partition by programme_id order by n) as bigint) segment_id, n word_index, text, cast(floor(ps/1000.0::double*1000+0.5) as bigint) st, cast(floor(pe/1000.0::double*1000+0.5) as bigint) en, conf, sp, music from s2),
sw as (select * from sw0 where not music)"""


def _shape(src: str, p: str) -> str:
    """CTEs that number the pieces of `src` and merge fragments: {p}m has `merged`."""
    return rf""",
{p}c as (select *, case when coalesce(regexp_matches(trim(lag(text) over o), {_END}) or st-lag(en) over o>=650, false) then 1 else 0 end cut from {src} window o as (partition by programme_id, segment_id order by word_index)),
{p}d as (select *, cast(sum(cut) over (partition by programme_id, segment_id order by word_index) as bigint) piece from {p}c),
{p}x as materialized (select *, lead(st) over (partition by programme_id, segment_id order by piece) nx from (select programme_id, segment_id, piece, arg_min(st,word_index) st, arg_max(en,word_index) en, count(*) n from {p}d group by all)),
{p}f as (select distinct programme_id, segment_id, -1::bigint piece, -1::bigint g, null::bigint pend, null::bigint cs, 0::bigint cn, 0::bigint merged from {p}x
  union all select programme_id, segment_id, piece, case when back or on_ then g else g+1 end, case when on_ then pend else en end, case when on_ then s0 end, case when on_ then n0 else 0 end, case when back then g else g+1 end
  from (select *, not back and frag and coalesce(nx-en<650,false) on_ from (select *, frag and coalesce(s0-pend<650,false) back from (select x.programme_id, x.segment_id, x.piece, x.en, x.nx, f.g, f.pend, coalesce(f.cs,x.st) s0, x.n+f.cn n0, x.en-coalesce(f.cs,x.st)<1200 and x.n+f.cn<3 frag
    from {p}x x join {p}f f on x.programme_id=f.programme_id and x.segment_id=f.segment_id and x.piece=f.piece+1)))),
{p}m as materialized (select d.*, f.merged from {p}d d join {p}f f on d.programme_id=f.programme_id and d.segment_id=f.segment_id and d.piece=f.piece)"""


_UTT = _shape("aw", "a") + r""",
ag as (select programme_id, segment_id, merged "chunk", sp, uc, arg_min(st,word_index) start_ms, arg_max(en,word_index) end_ms, count(*) n_words, avg(conf) ac, trim(regexp_replace(string_agg(text,' ' order by word_index),'\s+',' ','g')) j from am group by all),
ah as (select *, regexp_matches(j,'(?i)\[/?MUSIC\]') marked, trim(regexp_replace(j,'(?i)\[/?MUSIC\]','','g')) tx from ag),
ai as (select *, marked and len(list_filter(regexp_split_to_array(tx,'\s+'), lambda x: x<>''))<6 mu from ah),
utter as (select programme_id, segment_id, "chunk", sp speaker_ref, start_ms, end_ms, n_words, case when tx<>'' then tx when mu then '♪ Music ♪' else '' end as text, mu is_music, case when mu then 'foreground' when marked then 'background' else 'none' end music_context,
  case when mu then 'aai_u3_prompt' end music_source, uc confidence, coalesce(ac,uc) avg_word_confidence from ai)"""

_STR = _shape("sw", "b") + r""",
bw as (select programme_id, segment_id, word_index, text, st, en, conf, sp, music, merged from bm union all select programme_id, segment_id, word_index, text, st, en, conf, sp, music, 0 from sw0 where music),
stream as (select programme_id, segment_id, merged "chunk", sp speaker_ref, arg_min(st,word_index) start_ms, arg_max(en,word_index) end_ms, count(*) n_words,
  trim(regexp_replace(regexp_replace(string_agg(text,' ' order by word_index),'\s+([,.;:!?])','\1','g'),'\s+',' ','g')) as text, music is_music, case when music then 'foreground' else 'none' end music_context, case when music then 'scribe_audio_events' end music_source, avg(conf) avg_word_confidence from bw group by programme_id, segment_id, merged, sp, music)"""

_FLATS = 'programme_id, segment_id, "chunk", speaker_ref, start_ms, end_ms, n_words, text, is_music, music_context, music_source'
_TC = "lpad(({0}//3600000)::varchar,2,'0')||':'||lpad(({0}//60000%60)::varchar,2,'0')||':'||lpad(({0}//1000%60)::varchar,2,'0')||';'||lpad(({0}%1000//40)::varchar,2,'0')"
_K = "segment_id*31+word_index"
_CLK = "lpad(({0}//3600000)::varchar,2,'0')||':'||lpad(({0}//60000%60)::varchar,2,'0')||':'||lpad(({0}//1000%60)::varchar,2,'0')||'{1}'||lpad(({0}%1000)::varchar,3,'0')"
_SEGT = r""",
sg as (select *, programme_id+segment_id k from segs),
tseg as (select programme_id, segment_id, k, role='system' music, case when k%7=0 then 'edited' when k%13=0 then 'approved' else 'machine' end status, not (role='system' or (k%7=0 and k%21=0)) and k%17<>0 worded from sg)"""
_DUO = r""", d as (select programme_id p, greatest(abs(s-ps),abs(e-pe))::double d from words), g as (select p, quantile_cont(d,0.99) p99, max(d) mx, count(*) n, case when p%5=0 then count(*) filter (d>1500)/count(*) end ratio from d group by p),
one as (select *, (p%10)/10.0::double+0.4 mc, sha256(p::varchar) sha from g), two as (select * replace ((p%7)/10.0::double+0.3 as mc, case when p%9<>0 then sha end as sha) from one where p%19<>0),
v as (select one.p, one.n n1, two.n n2, one.sha sha1, two.sha sha2, one.mc m1, two.mc m2, case when one.p%17=0 then 'not_verified' when not one.mc>=0.5 then 'mean_confidence' when one.ratio is not null and one.p99>30000 then 'p99_shift' when one.ratio>0.005 then 'outlier_ratio' when one.ratio is null and one.mx>30000 then 'max_shift' else 'pass' end v1,
  case when two.p%17=0 then 'not_verified' when not two.mc>=0.5 then 'mean_confidence' when two.ratio is not null and two.p99>30000 then 'p99_shift' when two.ratio>0.005 then 'outlier_ratio' when two.ratio is null and two.mx>30000 then 'max_shift' else 'pass' end v2 from one left join two on one.p=two.p),
z as (select *, case when n2 is null then 'missing_stream' when v1<>'pass' then 'primary:'||v1 when v2<>'pass' then 'secondary:'||v2 when sha1 is distinct from sha2 then 'different_audio' end reason from v)"""
_CUES = r"with c as (select o_custkey project_id, o_orderkey cue_id, o_orderkey%5<>0 act from orders), r as (select *, act and row_number() over (partition by project_id, act order by cue_id)<=5 hit from c) "
_RUN = r"""with ch as (select o_custkey%10 run_id, (row_number() over (partition by o_custkey%10 order by o_orderkey)-1)//20 chunk_index, cast(o_totalprice as decimal(20,2)) price from orders),
pl as (select run_id, chunk_index, 'chunk:'||chunk_index chunk_key, count(*) n, sum(price)::double cost, run_id+chunk_index k from ch group by all),
rs as (select *, case when k%17<>0 then k%13<>0 end ok, coalesce(sum(case when k%17<>0 then cost end) over (partition by run_id order by chunk_index rows between unbounded preceding and 1 preceding),0) spent from pl),
st as (select *, case when ok then 'done' when not ok then 'failed' when spent<9000000 then 'dispatch' else 'stop' end next_step from rs) """
_STEM = _TURNS + r""", c0 as (select programme_id, role speaker_id, segment_id clip_no, case when programme_id%14<>0 or segment_id%6<>0 then end_ms-start_ms end dur, case when programme_id%10=0 then (programme_id*13+segment_id*7)%160-40 else 0 end ov from segs),
late as (select programme_id, count(*) n from c0 where ov>80 group by all), c1 as (select * from c0 where programme_id not in (select programme_id from late)),
bad as (select programme_id, speaker_id, count(*) n from c1 where not coalesce(dur>0,false) group by all), c2 as (select * from c1 anti join bad using (programme_id, speaker_id))"""

ORACLES = {
    "src_01_utterances": _R + _LISTED + _UTT + f" select {_FLATS}, floor(confidence*1e6+0.501)/1e6 confidence, floor(avg_word_confidence*1e6+0.501)/1e6 avg_word_confidence from utter",
    "src_02_word_stream": _R + _LISTED + _STR + f" select {_FLATS}, floor(avg_word_confidence*1e6+0.501)/1e6 avg_word_confidence from stream",
    "src_03_primary_words": _R + _LISTED + """ select programme_id, 'p:'||n "key", trim(said) as text, ps s, pe e from ul where trim(said)<>''""",
    "set_01_evidence_words": _R + _LISTED + r""" select programme_id, 'p:'||n "key", trim(said) as text, ps s, pe e from ul where trim(said)<>''
        union all select programme_id, 's:'||(row_number() over (partition by programme_id order by n)-1), text, cast(floor(ps/1000.0::double*1000+0.5) as bigint), cast(floor(pe/1000.0::double*1000+0.5) as bigint) from s0 where not ev and regexp_matches(text,'[\\p{L}\\p{N}]')""".replace("\\\\", "\\"),
    "src_05_turns": _R + _TURNS + """, t as (select programme_id, cluster, start_ms, end_ms, confidence, row_number() over (partition by programme_id order by start_ms, end_ms, cluster) n from turns where (programme_id+start_ms)%50<>0 and start_ms%37<>0)
        select programme_id, row_number() over (partition by programme_id order by start_ms, n)-1 turn_pos, cluster, start_ms, end_ms, greatest(0.0, least(1.0, case when confidence>1 then confidence/100 else confidence end))::double confidence from t""",
    "src_06_words": _R + _TURNS + _SEGT + f" select w.programme_id, w.segment_id, word_index, trim(text) as text, ps, pe from words w join tseg t on w.programme_id=t.programme_id and w.segment_id=t.segment_id and worded where (w.{_K.replace('word_index', 'w.word_index')})%97<>0",
    "src_06_rejects": _R + _TURNS + _SEGT + """ select programme_id, segment_id, 'missing_word_timings' fault from tseg where not worded and not music and status='machine'
        union all select distinct programme_id, null::bigint, 'no_words' from tseg t where not exists (select 1 from tseg x join words w on x.programme_id=w.programme_id and x.segment_id=w.segment_id where x.worded and x.programme_id=t.programme_id and (w.segment_id*31+w.word_index)%97<>0)""",
    "src_07_content_hash": "select conv_id, turn, sha256(text) content_sha256 from conversations",
    "src_08_event_log": "select strftime(ts,'%Y-%m-%d') dt, case when event_id%3=0 then 'warn' else 'info' end as \"level\", event_type as \"event\", count(*) n_events from events group by all",
    "snk_01_publish": _R + _TURNS + " select s.programme_id, s.segment_id, s.role, s.start_ms, s.end_ms, w.n n_words from segs s join (select programme_id, segment_id, count(*) n from words group by all) w using (programme_id, segment_id)",
    "snk_01_publish_over": _R + _TURNS + " select s.programme_id, s.segment_id, s.role, s.start_ms, s.end_ms, w.n n_words from segs s join (select programme_id, segment_id, count(*) n from words group by all) w using (programme_id, segment_id)",
    "snk_02_captions": _R + _TURNS + ", c as (select programme_id, segment_id+1 n, start_ms, end_ms, text from segs s join conversations c on c.conv_id=s.programme_id and c.turn=s.segment_id) "
        + "select programme_id, 'srt' \"format\", string_agg(n||chr(10)||" + _CLK.format("start_ms", ",") + "||' --> '||" + _CLK.format("end_ms", ",") + "||chr(10)||text, chr(10)||chr(10) order by n) content from c group by all union all "
        + "select programme_id, 'vtt', 'WEBVTT'||chr(10)||chr(10)||string_agg(" + _CLK.format("start_ms", ".") + "||' --> '||" + _CLK.format("end_ms", ".") + "||chr(10)||text, chr(10)||chr(10) order by n) from c group by all union all "
        + "select programme_id, 'csv', 'n,start_ms,end_ms,text'||chr(10)||string_agg(n||','||start_ms||','||end_ms||',\"'||replace(text,'\"','\"\"')||'\"', chr(10) order by n) from c group by all union all "
        + "select programme_id, 'json', '['||string_agg(to_json({'n': n, 'start_ms': start_ms, 'end_ms': end_ms, 'text': text})::varchar, ',' order by n)||']' from c group by all union all "
        + "select programme_id, 'txt', string_agg(text, chr(10) order by n) from c group by all",
    "snk_03_snapshot": "with n as (select 'customer' table_name, count(*) n_rows from customer union all select 'orders', count(*) from orders union all select 'part', count(*) from part) select table_name, dt, n_rows, dt>='2024-01-02' kept from n, (select unnest(['2024-01-01','2024-01-02','2024-01-03']) dt)",
    "jn_03_aligned": _R + f" select programme_id, segment_id, word_index, case when ({_K})%101<>0 then s end s, case when ({_K})%101<>0 then e end e, ({_K})%101=0 missing from words",
    "jn_04_provider_windows": _R + f" select programme_id, segment_id, word_index, s, e, case when ({_K})%13<>0 then ps end ps, case when ({_K})%13<>0 then pe end pe from words",
    "jn_08_sources": _R + _TURNS + """, p as (select programme_id, segment_id, part, start_ms+((end_ms-start_ms)//3)*part st, case when part=2 then end_ms else start_ms+((end_ms-start_ms)//3)*(part+1) end en from segs, (select unnest(range(3)) part))
        select p.programme_id, p.segment_id, part, count(w.ps) n, min(w.ps) first_start, max(w.pe) last_end from p left join words w on w.programme_id=p.programme_id and w.segment_id=p.segment_id and w.pe>st and w.ps<en group by all""",
    "pipe_09_duo_evidence": _R + _DUO + " select p programme_id, sha1 primary_audio_sha256, n1 primary_word_count, n2 secondary_word_count, floor(m1*1e6+0.501)/1e6 primary_mean, floor(m2*1e6+0.501)/1e6 secondary_mean from z where reason is null",
    "jn_09_refused": _R + _DUO + " select p programme_id, reason from z where reason is not null",
    "pipe_08_transcripts": _R + _LISTED + _UTT + _STR + """, al as (select programme_id, 'utterances' provider, segment_id, "chunk", speaker_ref, start_ms, end_ms, text from utter union all select programme_id, 'word_stream', segment_id, "chunk", speaker_ref, start_ms, end_ms, text from stream),
        sp as (select programme_id, provider, speaker_ref, row_number() over (partition by programme_id, provider order by f)-1 i from (select programme_id, provider, speaker_ref, min({'a': segment_id, 'b': "chunk"}) f from al group by all)),
        du as (select programme_id, cast(floor(max(pe)/1000.0::double*1000+0.5) as bigint) d1, cast(floor(arg_max(pe,n)/1000.0::double*1000+0.5) as bigint) d2 from ul group by all)
        select al.programme_id, al.provider, row_number() over (partition by al.programme_id, al.provider order by al.segment_id, "chunk")-1 sequence_index, case when starts_with(al.speaker_ref,'speaker_') then 'Speaker '||(split_part(al.speaker_ref,'_',2)::int+1) else 'Speaker '||al.speaker_ref end as "label", i%8 colour, """
        + _TC.format("start_ms") + " tc_in, " + _TC.format("end_ms") + """ tc_out, text, case when al.provider='word_stream' then 'scribe_v2' when al.programme_id%2=0 then 'universal-2' else 'universal-3-5-pro' end model, case when al.provider='word_stream' then d2 else d1 end duration_ms,
        floor((case when al.provider='word_stream' then d2 else d1 end)/1000.0::double*(case when al.provider='word_stream' then 0.000111 when al.programme_id%2=0 then 0.00004583 else 0.000076389 end)::double*10000+0.5)/10000 cost_usd
        from al join sp on sp.programme_id=al.programme_id and sp.provider=al.provider and sp.speaker_ref=al.speaker_ref join du on du.programme_id=al.programme_id""",
    "fn_05_speaker_labels": r"""with r as (select s_suppkey, s_suppkey%5 i, case s_suppkey%4 when 0 then 'Speaker_'||s_suppkey when 1 then 'speaker '||(s_suppkey%7) when 2 then '' else s_name end r from supplier)
        select s_suppkey, 'Speaker '||case when regexp_matches(r,'\d+$') then (regexp_extract(r,'(\d+)$',1)::hugeint+1)::varchar else (i+1)::varchar end as "label",
        'Speaker '||case when regexp_matches(r,'(?i)^speaker[_\s]?(\d+)$') then (regexp_extract(r,'(\d+)$',1)::hugeint+1)::varchar when r<>'' then r else (i+1)::varchar end provider_label from r""",
    "fn_10_file_names": r"""with r as (select p_partkey, p_name, case when p_partkey%11=0 then '' when p_partkey%5=0 then '..a/b:c*'||p_name when p_partkey%7=0 then repeat(p_name,9) else p_name end r from part)
        select p_partkey, substr(regexp_replace(case when r='' then 'speaker' else r end,'[^A-Za-z0-9]','_','g'),1,40) slug, case when r='' then 'segment.wav' else substr(regexp_replace(regexp_replace(r,'[\\/:*?"<>|]','_','g'),'^\.+',''),1,180) end safe, len(list_filter(regexp_split_to_array(trim(p_name),'\s+'), lambda x: x<>'')) n_words from r""",
    "fn_15_job_keys": "select o_orderkey, o_custkey, 'cascade-'||o_orderkey \"key\", lower(o_orderpriority)||'-'||o_custkey||'-'||o_orderkey key2 from orders",
    "fn_16_backoff": "with e as (select event_id, event_id%7+1 n from events) select event_id, cast(least(600000.0, 2000*pow(5.0,n-1)) as bigint) fixed, greatest(500, cast(floor(list_reduce(list_transform(string_split(substr(sha256(event_id::varchar),1,8),''), lambda c: (strpos('0123456789abcdef',c)-1)::bigint), lambda a, c: a*16+c)/4294967296.0::double*least(20000.0,1000*pow(2.0,n-1))) as bigint)) jittered from e",
    "fn_12_retry_after": "select event_id, case event_id%4 when 0 then least(30000, event_id%60*1000) when 1 then null else least(30000, epoch_ms(date_trunc('second', ts))-epoch_ms(date_trunc('minute', ts))) end retry_ms from events",
    "fn_14_word_clamps": _R + """, b as (select programme_id, segment_id, max(e)-120 b from words group by all), c as (select w.*, b, case when e>b and s<b then b else e end e2 from words w join b using (programme_id, segment_id))
        select programme_id, segment_id, bool_or(s>=b) erases, max(greatest(abs(s-ps),abs(e2-pe))) max_shift, cast(sum(e2) as bigint) ends from c group by all""",
    "prd_17_failure_classes": "select event_id, ([" + ",".join(f"'{c}'" for c in _CLASS) + f"])[cast(event_id%{len(_CLASS)}+1 as int)] failure from events",
    "pipe_11_supersede": _CUES + "select project_id, cue_id, act and not hit is_active, case when hit then 'run-7' end superseded_by_run_id from r",
    "pipe_11_next_steps": _CUES + "select project_id, count(*) filter (hit) superseded, count(*) filter (act and not hit) remaining, case when count(*) filter (act and not hit)>0 then 'continue' else 'dispatch_engine' end next_step from r group by all",
    "pipe_12_chunk_steps": _RUN + "select run_id, chunk_index, chunk_key, next_step from st",
    "pipe_12_run_states": _RUN + """, g as (select run_id, count(*) total_chunks, count(ok) terminal_chunks, count(*) filter (not ok) failed_chunks, count(*) filter (next_step='dispatch') open_chunks, cast(coalesce(sum(n) filter (ok is not null),0) as bigint) processed, cast(coalesce(sum(n) filter (ok),0) as bigint) succeeded,
        cast(coalesce(sum(n-1) filter (not ok),0) as bigint) failed, count(*) filter (not ok) skipped, cast(coalesce(sum(n*40) filter (ok is not null),0) as bigint) characters, coalesce(sum(cost) filter (ok is not null),0) c,
        coalesce(array_to_string(list_slice(list(chunk_key order by chunk_index) filter (not ok),1,200),','),'') failed_keys from st group by run_id)
        select run_id, total_chunks, terminal_chunks, failed_chunks, open_chunks, processed, succeeded, failed, skipped, characters, cast(floor(c*100+0.5) as bigint) cost_usd, failed_keys, c>=9000000 breached,
        case when not (terminal_chunks>=total_chunks or (c>=9000000 and open_chunks=0)) then 'running' when failed_chunks=total_chunks then 'failed' when failed_chunks>0 or terminal_chunks<total_chunks then 'partial' else 'completed' end run_status from g""",
    "pipe_13_stem_files": _R + _STEM + """ select programme_id, speaker_id, 'The '||speaker_id as "label", substr(regexp_replace('The '||speaker_id,'[^A-Za-z0-9]','_','g'),1,40)||'_en_gap0.5s.wav' file_name, count(*) clip_count, cast(greatest(1, sum(dur)+(count(*)-1)*500) as bigint) duration_ms, 0.5::double gap_seconds from c2 group by all""",
    "pipe_13_refused": _R + _STEM + " select programme_id, null::varchar speaker_id, 'late_clips' fault, n from late union all select programme_id, speaker_id, 'missing_duration', n from bad",
}

QUERIES = {n: globals()[n] for n in ORACLES}
