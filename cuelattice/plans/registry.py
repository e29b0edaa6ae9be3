"""Registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import intervals, rows, timing
from ..sources import derived as D
from ..staging import stage
from ..streaming import jobs
from . import intake, production, programme, programme_sql, streams
from . import oracles as base_sql

KEY = ["programme_id", "segment_id", "word_index"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.job_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def prd_word_rules(spark, sf_dir):
    pd, t = F.col("pe") - F.col("ps"), F.col("text")
    return D.words(spark, sf_dir).select(*KEY, X.max_word_ms(t).alias("max_ms"), X.credible(t, pd).alias("credible"), X.evidence_ceiling(t, pd).alias("ceiling"), X.near_zero_corroborated(pd).alias("near_zero"), X.plausible(t, F.col("s"), F.col("e"), pd).alias("plausible"))


def prd_08_disputed(spark, sf_dir):
    return timing.flag_disputes(D.words(spark, sf_dir)).select(*KEY, "stacked", "divergence", "disputed")


def fold_01_arbitration(spark, sf_dir):
    return timing.arbitrate(D.words(spark, sf_dir)).select(*KEY, "outcome", "s", "e", "arbitration_reason", "arbitration_ceiling_ms", "arbitration_provider_ms", "arbitration_aligned_ms")


def pipe_01_refine_timing(spark, sf_dir):
    return timing.refine_timing(D.words(spark, sf_dir)).select(*KEY, "outcome", "final", "s", "e", "absorbed")


def agg_05_outcomes(spark, sf_dir):
    w = timing.refine_timing(D.words(spark, sf_dir))
    return w.groupBy("programme_id", "outcome", "final").agg(F.count(F.lit(1)).alias("n_words"), F.sum("absorbed").alias("absorbed_ms"))


def jn_02_best_overlap(spark, sf_dir):
    words = stage(D.words(spark, sf_dir))
    return intervals.best_overlap(words.select(*KEY, "s", "e"), stage(D.turns(spark, sf_dir, words))).select(*KEY, "cluster", "overlap_ms")


def jn_01_points_in_turns(spark, sf_dir):
    spans = D.turns(spark, sf_dir).select("programme_id", "cluster", "start_ms", "end_ms")
    return intervals.points_in(D.words(spark, sf_dir).select(*KEY, "s"), spans).select(*KEY, "cluster", "start_ms")


def agg_01_speaker_plan(spark, sf_dir):
    return rows.speaker_plan(D.turns(spark, sf_dir))


def win_05_sentences(spark, sf_dir):
    return rows.sentence_segments(D.words(spark, sf_dir)).select("programme_id", "segment_id", F.col("piece").cast("long").alias("piece"), "start_ms", "end_ms", "n_words", "text")


def win_12_stems(spark, sf_dir):
    return rows.spaced_stems(D.clips(spark, sf_dir))


def prd_12_overruns(spark, sf_dir):
    return rows.overruns(D.clips(spark, sf_dir))


def agg_11_shift_gate(spark, sf_dir):
    return rows.shift_report(D.words(spark, sf_dir))


def fn_texts(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    t = F.col("text")
    return c.select("conv_id", "turn", X.timecode(F.col("conv_id") * 7919 + F.col("turn") * 104729).alias("tc"), X.punctuation_only(t).alias("punct"), X.slug(t).alias("slug"), X.sentence_end(t).alias("ends"), X.count_words(t).alias("n_words"))


def agg_15_queue_states(spark, sf_dir):
    return rows.latest_states(_events(spark, sf_dir))


def win_13_recent(spark, sf_dir):
    return rows.recent(_events(spark, sf_dir))


def prd_17_failures(spark, sf_dir):
    return rows.failures(_events(spark, sf_dir))


def stm_03_start_rates(spark, sf_dir):
    return jobs.start_rates(_events(spark, sf_dir), "1 hour", 2)


def stm_04_wait_trend(spark, sf_dir):
    w = jobs.wait_trend(_events(spark, sf_dir), "2 hours", "1 hour").drop("n_wait", "sum_wait", "n_work", "sum_work")
    return w.withColumns({c: F.floor(F.col(c) * 1000 + 0.501) / 1000 for c in ("mean_wait", "mean_work")})


def stm_05_sessions(spark, sf_dir):
    return rows.liveness(_events(spark, sf_dir), 3600)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg_05_outcomes(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        prd_word_rules, prd_08_disputed, fold_01_arbitration, pipe_01_refine_timing, agg_05_outcomes, jn_01_points_in_turns, jn_02_best_overlap, agg_01_speaker_plan,
        win_05_sentences, win_12_stems, prd_12_overruns, agg_11_shift_gate, fn_texts, agg_15_queue_states, win_13_recent, prd_17_failures, stm_03_start_rates, stm_04_wait_trend, stm_05_sessions,
    )
}

QUERIES |= programme.QUERIES | production.QUERIES | intake.QUERIES | streams.QUERIES
ORACLES = base_sql.ORACLES | programme_sql.ORACLES | production.ORACLES | intake.ORACLES | streams.ORACLES
