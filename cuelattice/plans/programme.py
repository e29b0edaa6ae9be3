"""Queries over whole programmes: attribution, boundaries, islands, audit, state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, boundaries, islands, refine, speakers, timing
from ..sources import derived as D
from ..staging import stage

ROW = ["programme_id", "segment_id", "group_no"]


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.reconcile(timing.refine_timing(D.engine_words(D.words(spark, sf_dir))))


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reconciled words, turns and segments. Words are refined where they are derived, without
    being dealt again, and written once; turns and segments, which a deployment has as
    tables, are derived from them."""
    words = stage(reconciled(spark, sf_dir))
    return words, stage(D.turns(spark, sf_dir, words)), stage(D.segment_table(spark, sf_dir, words))


def _bounded_with_words(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows with boundaries and own defects, the reconciled words they come from, turns and
    segments, each made once."""
    words, turns, segments = _inputs(spark, sf_dir)
    rows = refine.bounded_from(words, turns, segments)
    return stage(audit.own_defects(rows)), words, turns, segments


def attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speakers.attribute(*_inputs(spark, sf_dir))


def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.bounded_from(*_inputs(spark, sf_dir))


def with_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, turns, segments = _inputs(spark, sf_dir)
    return islands.detect_islands(stage(refine.bounded_from(words, turns, segments)), turns)


def refined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, turns, segments = _inputs(spark, sf_dir)
    return refine.states(refine.bounded_from(words, turns, segments), turns, own_reasons=False)


def rec_reconciliation(spark, sf_dir):
    return reconciled(spark, sf_dir).select("programme_id", "segment_id", "word_index", "unresolved", "reason", "cleared", "prior_reason")


def agg_06_word_report(spark, sf_dir):
    w = reconciled(spark, sf_dir)
    touched = F.count_distinct(F.when(F.col("cleared").isNotNull(), F.col("segment_id")))
    return w.groupBy("programme_id").agg(F.count_if("unresolved").alias("unresolved_words"), F.count_if(F.col("cleared").isNotNull()).alias("cleared_words"), touched.alias("cleared_rows"), F.count_if(F.col("final") == "zero_width_final_window").alias("zero_width_words"), F.max("absorbed").alias("worst_absorbed_ms"))


def _flat(report: DataFrame) -> DataFrame:
    """Lists as text, for comparison."""
    return report.withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c, kind in report.dtypes if kind.startswith("array")})


def agg_05_capture_report(spark, sf_dir):
    return _flat(timing.capture_report(timing.arbitrate(D.words(spark, sf_dir))))


def agg_06_onset_report(spark, sf_dir):
    return _flat(timing.onset_report(reconciled(spark, sf_dir)))


def agg_06_acceptance_report(spark, sf_dir):
    return _flat(timing.acceptance_report(reconciled(spark, sf_dir)))


def agg_06_reconciliation_report(spark, sf_dir):
    return _flat(timing.reconciliation_report(reconciled(spark, sf_dir)))


def agg_04_word_evidence(spark, sf_dir):
    e = speakers.word_evidence(reconciled(spark, sf_dir))
    shown = F.transform("words", lambda w: F.concat_ws("|", w["word_index"].cast("string"), w["text"], w["ps"].cast("string"), w["pe"].cast("string"), w["s"].cast("string"), w["e"].cast("string"), w["reason"]))
    return e.select("programme_id", "segment_id", F.size("words").cast("long").alias("n"), F.array_join(shown, ",").alias("words"))


def pipe_02_attribution(spark, sf_dir):
    return attributed(spark, sf_dir).select(*ROW, "sequence_index", "cluster", "speaker_index", "start_ms", "end_ms", "core_start", "core_end", "pb_start", "pb_end", "n_words", "span_unresolved", "authored_preserved", "is_music", "text")


def agg_03_row_rollups(spark, sf_dir):
    return attributed(spark, sf_dir).select(*ROW, "unresolved_words", "exhausted_words", "near_zero_words", "cleared_words", "uncovered_words", "absorbed_ms", "max_shift_ms", "restored", "rejected", "collapsed", "below_floor_words", "restored_ms", "rejected_ms", "expansion_ms", "alignment_pass", (F.floor(F.col("mean_confidence") * 1e6 + 0.501) / 1e6).alias("mean_confidence"))


def agg_02_cluster_counts(spark, sf_dir):
    return speakers.cluster_counts(attributed(spark, sf_dir))


def pipe_03_boundaries(spark, sf_dir):
    return bounded(spark, sf_dir).select(*ROW, "start_ms", "end_ms", "boundary", "lead_in_ms", "lead_out_ms", "delta_start_ms", "delta_end_ms", "contradicted", "recovered", "conflict_ms")


def pipe_03_boundaries_of_length(spark, sf_dir):
    """Programmes whose length is known: some end before the last row's lead-out, some within
    the last word."""
    words, turns, segments = _inputs(spark, sf_dir)
    length = (F.max("prior_e") + (F.col("programme_id") * 37) % 300 - 50).alias("duration_ms")
    rows = refine.bounded_from(words, turns, segments, words.groupBy("programme_id").agg(length).filter("programme_id % 5 <> 0"))
    return rows.select(*ROW, "start_ms", "end_ms", "boundary", "lead_in_ms", "lead_out_ms")


def agg_08_boundary_report(spark, sf_dir):
    r = boundaries.boundary_report(bounded(spark, sf_dir))
    return r.withColumn("conflict_sequences", F.array_join(F.transform("conflict_sequences", lambda x: x.cast("string")), ","))


def pipe_04_islands(spark, sf_dir):
    return with_islands(spark, sf_dir).select(*ROW, "island", "overlap_ms", "suggested", "signals")


def fold_03_overlaps(spark, sf_dir):
    return audit.overlap_sweep(stage(audit.own_defects(bounded(spark, sf_dir))))


def pipe_05_audit(spark, sf_dir):
    return audit.audit(stage(audit.own_defects(bounded(spark, sf_dir)))).select(*ROW, "end_ms", "defect", "defect_ms", "repaired", "inflation_ms", "divergence_ms")


def agg_07_integrity(spark, sf_dir):
    r = stage(audit.own_defects(bounded(spark, sf_dir)))
    out = audit.integrity_report(audit.audit(r), audit.overlap_sweep(r))
    return out.withColumn("defect_sequences", F.array_join(F.transform("defect_sequences", lambda x: x.cast("string")), ","))


def agg_07_run_report(spark, sf_dir):
    r, words, _, _ = _bounded_with_words(spark, sf_dir)
    return _flat(audit.run_report(audit.audit(r), audit.overlap_sweep(r), words))


def fold_03_repairs(spark, sf_dir):
    r, words, turns, segments = _bounded_with_words(spark, sf_dir)
    audited = stage(audit.audit(r))
    # Groups are numbered inside a segment: words of segments without a repair aren't needed.
    asked = audited.filter("repaired").select("programme_id", "segment_id").distinct()
    own = words.join(asked, ["programme_id", "segment_id"], "left_semi")
    out = audit.repaired_rows(audited, speakers.grouped_words(own.select("programme_id", "segment_id", "word_index", "s", "e", "ps", "pe"), turns, segments))
    return out.select(*ROW, "end_ms", "tc_out", "clamped_words", "max_provider_shift_ms")


def pipe_06_states(spark, sf_dir):
    return refined_rows(spark, sf_dir).select(*ROW, "state", "cause", "overrides", "unresolved_timing", "unresolved_speaker", "state_reason")


def pipe_06_own_reasons(spark, sf_dir):
    words, turns, segments = _inputs(spark, sf_dir)
    return refine.states(refine.bounded_from(words, turns, segments), turns).filter("unresolved_speaker").select(*ROW, "state", "cause", "state_reason")


def pipe_07_export_gate(spark, sf_dir):
    return refine.export_gate(refined_rows(spark, sf_dir)).select("programme_id", "blocking", "total", "exportable")


def agg_09_state_summary(spark, sf_dir):
    return audit.state_summary(refined_rows(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        rec_reconciliation, agg_06_word_report, agg_04_word_evidence, pipe_02_attribution, agg_03_row_rollups, agg_02_cluster_counts, pipe_03_boundaries, pipe_03_boundaries_of_length, agg_08_boundary_report,
        pipe_04_islands, fold_03_overlaps, pipe_05_audit, agg_07_integrity, agg_07_run_report, fold_03_repairs, pipe_06_states, pipe_06_own_reasons, pipe_07_export_gate, agg_09_state_summary, agg_05_capture_report, agg_06_onset_report, agg_06_acceptance_report, agg_06_reconciliation_report,
    )
}
