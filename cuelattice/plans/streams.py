"""Streaming queries, run over what the tables hold now, each with its batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import rows
from ..sources import derived as D
from ..staging import folder, stage
from ..streaming import jobs, ordered
from .oracles import _EVENTS
from .oracles import ORACLES as BASE
from .production import ORACLES as PRODUCTION
from .programme_sql import _D, _STATES

#: Events are dealt over so many files, whatever their times; the lateness that allows it.
FILES, LATE = 4, "400 days"


def _stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    return D.job_events(jobs.read_events(spark, path, spark.read.parquet(path).schema))


def _new(spark, name):
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def _deal(rows_, number, path, files):
    """Rows in `files` files, one written after the other, by number."""
    for k in range(files):
        rows_.filter(F.pmod(number, F.lit(files)) == k).coalesce(1).write.mode("append").parquet(path)


def _shuffled(spark, sf_dir, ahead="0 seconds"):
    """Job events as a stream of FILES files in no order of time. The last file is a tick of
    the clock: an event of no job, so late that the watermark comes to the latest event and
    `ahead` of it."""
    e, path = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), _new(spark, "dealt")
    _deal(e, F.xxhash64("event_id"), path, FILES)
    tick = e.agg((F.max("ts") + F.expr(f"interval {LATE}") + F.expr(f"interval {ahead}")).alias("ts")).withColumns({"event_id": F.lit(-1).cast("long"), "event_type": F.lit("click")})
    e.limit(0).unionByName(tick, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(path)
    return D.job_events(jobs.read_events(spark, path, e.schema))


def _sent(spark, stream, conf=None):
    """What a stream of appended rows has sent once it has read all files."""
    out = _new(spark, "sent")
    jobs.drain(stream.writeStream.format("parquet").option("path", out), _new(spark, "cp"), conf=conf)
    return spark.read.schema(stream.schema).parquet(out)


def stm_02_once_per_job(spark, sf_dir):
    out = _new(spark, "once")
    jobs.drain(jobs.once_per_job(_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "400 days").select("job_id").writeStream.format("parquet").option("path", out), _new(spark, "cp"))
    return spark.read.parquet(out)


def stm_05_session_windows(spark, sf_dir):
    e = D.job_events(spark.read.parquet(f"{sf_dir}/events.parquet")).withColumn("ts", F.col("ts").cast("timestamp"))
    return jobs.sessions(e, "1 hour").select("job_id", F.unix_micros("started").alias("started_us"), "n_events")


def stm_05_verdicts(spark, sf_dir):
    return rows.liveness_verdicts(D.job_events(spark.read.parquet(f"{sf_dir}/events.parquet")), 36_000, 2)


def stm_03_rate_stream(spark, sf_dir):
    out = _sent(spark, jobs.start_rates(_shuffled(spark, sf_dir, "2 hours"), "1 hour", 2, LATE))
    return out.select("queue", F.unix_micros("window_start").alias("window_us"), "starts", "over")


def stm_04_trend_stream(spark, sf_dir):
    out = _sent(spark, jobs.wait_trend(_shuffled(spark, sf_dir, "3 hours"), "2 hours", "1 hour", LATE))
    cents = [jobs.cents(F.col(f"sum_{k}"), F.col(f"n_{k}")).alias(f"{k}_cents") for k in ("wait", "work")]
    return out.select("queue", F.unix_micros("window_start").alias("window_us"), "n_events", "longest", *cents)


def stm_05_live_verdicts(spark, sf_dir):
    return ordered.verdicts_now(_sent(spark, ordered.live_verdicts(_shuffled(spark, sf_dir), 36_000, 2, LATE), ordered.STATE_STORE))


def stm_06_stale_stream(spark, sf_dir):
    return _sent(spark, ordered.reclaim_stale(_shuffled(spark, sf_dir), 36_000, LATE), ordered.STATE_STORE)


def stm_07_running_states(spark, sf_dir):
    out = _new(spark, "states")
    jobs.keep_states(_shuffled(spark, sf_dir).filter("job_id is not null"), out, _new(spark, "cp"), most=2)
    return jobs.running_states(spark, out)


def stm_08_incremental(spark, sf_dir):
    path, out = f"{sf_dir}/conversations.parquet", _new(spark, "refined")
    arrivals = jobs.read_events(spark, path, spark.read.parquet(path).schema).select(F.col("conv_id").alias("programme_id"))
    jobs.refine_incrementally(arrivals, lambda ids: D.words(spark, sf_dir, ids), out, _new(spark, "cp"))
    return jobs.published_rows(spark, out).select("programme_id", "segment_id", "word_index", "outcome", "final", "s", "e", "absorbed")


def stm_08_published(spark, sf_dir):
    """Turns of programmes arrive in two files; every third programme has some in both."""
    c, path, out = spark.read.parquet(f"{sf_dir}/conversations.parquet"), _new(spark, "turns"), _new(spark, "published")
    _deal(c, F.when(F.col("conv_id") % 3 == 0, F.col("turn")).otherwise(F.col("conv_id")), path, 2)
    arrivals = jobs.read_events(spark, path, c.schema).select(F.col("conv_id").alias("programme_id"))

    def tables(ids):
        words = stage(D.engine_words(D.words(spark, sf_dir, ids)))
        return words, stage(D.turns(spark, sf_dir, words)), stage(D.segment_table(spark, sf_dir, words))

    jobs.publish_incrementally(arrivals, tables, out, _new(spark, "cp"))
    return jobs.published_rows(spark, out).select("programme_id", "segment_id", "group_no", "state", "cause", "exportable")


def stm_09_dropped_rows(spark, sf_dir):
    """Events in files by day of month, the first days last: what the stream dropped."""
    e, path = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), _new(spark, "dealt")
    _deal(e, F.dayofmonth("ts") + 2, path, FILES)
    stream = jobs.read_events(spark, path, e.schema)
    late = jobs.late_rows_of(e, _sent(spark, jobs.keep_on_time(stream, "3 days")))
    return late.groupBy("event_type").agg(F.count(F.lit(1)).alias("late_events"))


def stm_09_late_rows(spark, sf_dir):
    e = D.job_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return jobs.late_rows(e.withColumn("arrival", F.col("event_id") + F.when(F.col("event_id") % 50 == 0, 500).otherwise(0)), 3600)


ORACLES = {
    "stm_02_once_per_job": "select distinct user_id%150 job_id from events",
    "stm_05_session_windows": "with " + _EVENTS + """, l as (select *, case when coalesce(epoch_us(ts)-epoch_us(lag(ts) over (partition by job_id order by ts, event_id))>=3600000000, true) then 1 else 0 end nw from jobs),
        m as (select *, sum(nw) over (partition by job_id order by ts, event_id) n from l) select job_id, min(epoch_us(ts)) started_us, count(*) n_events from m group by job_id, n""",
    "stm_05_verdicts": "with " + _EVENTS + """, l as (select *, lag(state) over o ps, epoch_us(ts)-epoch_us(lag(ts) over o) gap from jobs window o as (partition by job_id order by ts, event_id)), g as (select job_id, count(*) filter (ps='active' and gap>36000000000) stalls from l group by job_id)
        select job_id, stalls, case when stalls>2 then 'failed' when stalls>0 then 'stalled' else 'alive' end verdict from g""",
    "stm_06_stale_stream": PRODUCTION["stm_06_stale"],
    "stm_07_running_states": BASE["agg_15_queue_states"],
    "stm_03_rate_stream": "with " + _EVENTS + """ select queue, cast(epoch_us(ts)//3600000000*3600000000 as bigint) window_us, count(*) starts, count(*)>2 as over from jobs where state='active' group by queue, 2""",
    "stm_04_trend_stream": "with " + _EVENTS + """, w as (select *, (epoch_us(ts)//3600000000-h.h)*3600000000 window_us from jobs, (select unnest([0,1]) h) h)
        , x as (select *, case when state in ('waiting','delayed') then 'wait' else 'work' end what, cast(try_cast(value as decimal(28,6))*1000000 as hugeint) v from w),
        g as (select queue, window_us, count(*) n_events, max(value) longest, """ + ", ".join(f"200*sum(v) filter (what='{k}')+1000000*count(v) filter (what='{k}') {k}_a, 2000000*count(v) filter (what='{k}')::hugeint {k}_b" for k in ("wait", "work")) + """ from x group by all)
        select queue, cast(window_us as bigint) window_us, n_events, longest, """ + ", ".join(f"cast(case when {k}_b>0 then ({k}_a-({k}_a%{k}_b+{k}_b)%{k}_b)//{k}_b end as bigint) {k}_cents" for k in ("wait", "work")) + " from g",
    "stm_05_live_verdicts": "with " + _EVENTS + """, l as (select *, coalesce(lead(epoch_us(ts)) over (partition by job_id order by ts, event_id), (select max(epoch_us(ts)) from jobs))-epoch_us(ts) gap from jobs), g as (select job_id, count(*) filter (state='active' and gap>36000000000) stalls from l group by job_id)
        select job_id, stalls, case when stalls>2 then 'failed' when stalls>0 then 'stalled' else 'alive' end verdict from g""",
    "stm_08_published": _D + _STATES + " select programme_id, segment_id, group_no, state, cause, count(*) filter (state in ('UNRESOLVED_TIMING','UNRESOLVED_SPEAKER')) over (partition by programme_id)=0 exportable from states",
    "stm_08_incremental": BASE["pipe_01_refine_timing"],
    "stm_09_dropped_rows": """with f as (select *, (day(ts)+2)%4 k from events), w as (select k, max(epoch_ms(ts)) m from f group by k)
        select event_type, count(*) late_events from f where epoch_us(ts)<=(select max(m)-3*86400000 from w where w.k<=f.k-2)*1000 group by event_type""",
    "stm_09_late_rows": "with " + _EVENTS + """, a as (select *, event_id+case when event_id%50=0 then 500 else 0 end arr from jobs), l as (select *, coalesce(max(epoch_us(ts)) over (partition by queue order by arr, event_id rows between unbounded preceding and 1 preceding)-epoch_us(ts)>3600000000, false) late from a)
        select queue, count(*) n_events, count(*) filter (late) late_events from l group by queue""",
}

QUERIES = {n: globals()[n] for n in ORACLES}
