"""Output rows of a programme: reconciled words, speaker groups, text authority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import intervals, rows

#: Reasons that no later step may withdraw (fixed values).
BARRED = ("zero_width_final_window", "alignment_collapse_no_usable_window", "arbitration_unresolved_two_timeline_conflict")
BARRED_PREFIXES = ("search_region_exhausted", "final_window_below_evidence_floor")
AUTHORED = ("edited", "approved")
#: What rows tell of their words; other columns needn't be dealt.
_USED = ("programme_id", "segment_id", "word_index", "text", "s", "e", "ps", "pe", "outcome", "divergence", "absorbed", "unresolved", "reason", "cleared", "exhausted", "confidence", "expansion_ms", "alignment_pass")


def authoritative(status: Column) -> Column:
    return F.coalesce(status.isin(*AUTHORED), F.lit(False))


def output_text(status: Column, own: Column, machine: Column) -> Column:
    """Authored text wins where it is not blank; else machine text, else own."""
    own = F.coalesce(own, F.lit(""))
    return F.when(authoritative(status) & (F.trim(own) != ""), own).when(F.coalesce(machine, F.lit("")) != "", machine).otherwise(own)


def provider_boundary(split: Column, start: Column, end: Column, carried_start: Column, carried_end: Column, source: Column) -> Column:
    """struct(ps, pe): the carried pair, else the window of a row never refined."""
    pair = lambda a, b: F.struct(a.cast("long").alias("start_ms"), b.cast("long").alias("end_ms"))
    none = pair(F.lit(None), F.lit(None))
    return (
        F.when(split, none).when(F.coalesce(carried_end > carried_start, F.lit(False)), pair(carried_start, carried_end))
        .when(F.coalesce(source, F.lit("")) != "", none).when(F.coalesce(end > start, F.lit(False)), pair(start, end)).otherwise(none)
    )


def reconcile(accepted: DataFrame) -> DataFrame:
    """Accepted words with engine_unresolved, engine_reason, exhausted: adds
    unresolved, reason, cleared (why an engine verdict was withdrawn, else null)
    and prior_reason. Null engine columns count as no verdict."""
    engine = F.coalesce("engine_unresolved", F.lit(False))
    below = F.col("final").isin("zero_width_final_window", "final_window_below_evidence_floor_uncorroborated")
    said = F.when(F.coalesce("engine_reason", F.lit("")) != "", F.col("engine_reason"))
    reason = F.when(below, F.col("final")).when(F.col("outcome") == "unresolved", F.coalesce(said, F.lit(BARRED[2]))).when(engine, F.coalesce(said, F.lit(""))).otherwise("")
    dur = F.col("e") - F.col("s")
    barred = F.col("_r").isin(*BARRED) | F.col("_r").startswith(BARRED_PREFIXES[0]) | F.col("_r").startswith(BARRED_PREFIXES[1])
    open_ = F.col("_u") & (F.col("outcome") != "alignment_collapsed") & ~F.coalesce("exhausted", F.lit(False)) & ~barred & F.coalesce(dur >= X.DEGENERATE_MS, F.lit(False))
    cleared = (
        F.when(~open_, None).when((F.col("outcome") == "restored") & X.plausible(F.col("text"), F.col("s"), F.col("e")), "resolved_by_capture_restore")
        .when((F.col("final") == "corroborated") & (F.col("pe") - F.col("ps") > 0), "resolved_by_provider_corroboration")
    )
    w = accepted.withColumns({"_u": below | (F.col("outcome") == "unresolved") | engine, "_r": reason}).withColumn("cleared", cleared)
    kept = F.col("cleared").isNull()
    return w.withColumns({"unresolved": F.col("_u") & kept, "reason": F.when(kept, F.col("_r")).otherwise(""), "prior_reason": F.when(~kept, F.col("_r"))}).drop("_u", "_r")


def fill_clusters(words: DataFrame) -> DataFrame:
    """words with cluster (null where no turn covers them) and first_cluster of the
    programme: filled takes the word before, at a segment's head the word after,
    else the programme's first cluster; group_no numbers runs of one cluster."""
    order = Window.partitionBy("programme_id", "segment_id").orderBy("word_index")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    head = F.first(F.coalesce("cluster", "_next", "first_cluster")).over(so_far)
    w = words.withColumn("_next", F.lead("cluster").over(order))
    w = w.withColumn("filled", F.coalesce(F.last("cluster", True).over(so_far), head))
    return w.withColumn("group_no", F.sum(F.coalesce((F.col("filled") != F.lag("filled").over(order)).cast("long"), F.lit(0))).over(order)).drop("_next")


def grouped_words(words: DataFrame, turns: DataFrame, segments: DataFrame) -> DataFrame:
    """Words of segments that have them, with their cluster, what fills its gaps, the
    number of their speaker group in the segment, and the segment's number of groups."""
    first = rows.speaker_plan(turns).filter("speaker_index = 0").select("programme_id", F.col("cluster").alias("first_cluster"))
    info = segments.filter("has_words").join(first, "programme_id", "left").select("programme_id", "segment_id", "status", "first_cluster")
    w = fill_clusters(intervals.best_overlap(words, turns).join(info, ["programme_id", "segment_id"]))
    per = Window.partitionBy("programme_id", "segment_id")
    return w.withColumn("_groups", F.max("group_no").over(per) + 1).withColumn("group_no", F.when(authoritative(F.col("status")), F.lit(0)).otherwise(F.col("group_no")))


def attribute(words: DataFrame, turns: DataFrame, segments: DataFrame) -> DataFrame:
    """Reconciled words (with confidence, expansion_ms and alignment_pass), turns and segments (programme_id, segment_id, start_ms,
    end_ms, source_text, status, is_music, has_words, carried_start, carried_end,
    boundary_source, override) -> one row per output row: split by speaker unless
    the text is authored; music and unworded authored rows pass through."""
    words = words.select(*[c for c in words.columns if c in _USED]).withColumns({c: F.lit(None).cast(t) for c, t in (("confidence", "double"), ("expansion_ms", "long"), ("alignment_pass", "int")) if c not in words.columns})
    plan = rows.speaker_plan(turns).select("programme_id", "cluster", "speaker_index")
    first = plan.filter("speaker_index = 0").select("programme_id", F.col("cluster").alias("first_cluster"))
    seg = segments.join(first, "programme_id", "left")
    w = grouped_words(words, turns, segments)
    # An authored row keeps one group: the cluster with most measured time.
    length = F.greatest(F.lit(0), F.coalesce(F.col("e") - F.col("s"), F.lit(0)))
    heard = Window.partitionBy("programme_id", "segment_id", "group_no", "filled")
    w = w.withColumns({"_ms": F.sum(length).over(heard), "_at": F.min("word_index").over(heard)})
    n = lambda c: F.count_if(c)
    shift = F.greatest(F.abs(F.col("s") - F.col("ps")), F.abs(F.col("e") - F.col("pe")))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("word_index", "text"))), lambda x: x["text"])
    ok = ~F.col("unresolved")
    g = w.groupBy("programme_id", "segment_id", "group_no").agg(
        F.count(F.lit(1)).alias("n_words"), F.min_by("s", "word_index").alias("_ws"), F.max_by("e", "word_index").alias("_we"), F.max("_groups").alias("_groups"),
        F.min(F.when(ok, F.col("s"))).alias("core_start"), F.max(F.when(ok, F.col("e"))).alias("core_end"),
        n(F.col("unresolved")).alias("unresolved_words"), n(F.coalesce("exhausted", F.lit(False))).alias("exhausted_words"),
        n(F.col("reason").startswith(BARRED_PREFIXES[1]) | (F.col("reason") == BARRED[0])).alias("near_zero_words"), n(F.col("cleared").isNotNull()).alias("cleared_words"),
        n(F.col("reason").startswith(BARRED_PREFIXES[1])).alias("below_floor_words"), F.avg("confidence").alias("mean_confidence"), F.max("expansion_ms").alias("expansion_ms"), F.max("alignment_pass").alias("alignment_pass"),
        F.max(F.when(F.col("outcome") == "restored", F.col("divergence"))).alias("restored_ms"), F.max(F.when(F.col("outcome") == "provider_timing_rejected", F.col("divergence"))).alias("rejected_ms"),
        F.max_by("filled", F.struct(F.col("_ms"), -F.col("_at"))).alias("_main"), n(F.col("word_index") == F.col("_at")).alias("n_clusters"), n(F.col("cluster").isNull()).alias("uncovered_words"), F.max("absorbed").alias("absorbed_ms"), F.max(shift).alias("max_shift_ms"),
        F.max(F.when(F.col("outcome") != "provider_timing_rejected", shift)).alias("gap_ms"),
        F.bool_or(F.col("outcome") == "restored").alias("restored"), F.bool_or(F.col("outcome") == "provider_timing_rejected").alias("rejected"),
        F.bool_or(F.col("outcome") == "alignment_collapsed").alias("collapsed"), F.bool_or(F.col("absorbed") > 0).alias("onset_moved"),
        (F.max_by("pe", "word_index") - F.min_by("ps", "word_index")).alias("capture_ms"), F.max(F.greatest("s", "ps")).alias("last_word_start"), X.join_words(texts).alias("machine_text"),
    ).withColumnRenamed("_main", "cluster")
    worded = g.join(seg.filter("has_words"), ["programme_id", "segment_id"]).withColumn("_split", (F.col("_groups") > 1) & ~authoritative(F.col("status")))
    worded = worded.withColumns({"span_unresolved": (F.col("_groups") > 1) & authoritative(F.col("status")), "_s": F.col("_ws"), "_e": F.col("_we")})
    bare = seg.filter("not has_words and (is_music or status in ('edited', 'approved'))").withColumn("word_index", F.lit(0)).withColumns({"s": F.col("start_ms"), "e": F.col("end_ms")})
    bare = intervals.best_overlap(bare, turns, long=True).withColumn("cluster", F.coalesce("cluster", "first_cluster"))
    bare = bare.withColumns({"group_no": F.lit(0), "n_words": F.lit(0), "_s": F.col("start_ms"), "_e": F.col("end_ms"), "_split": F.lit(False), "span_unresolved": F.lit(False)}).drop("word_index", "s", "e", "overlap_ms")
    out = worded.unionByName(bare, allowMissingColumns=True)
    counts = ["unresolved_words", "exhausted_words", "near_zero_words", "below_floor_words", "cleared_words", "uncovered_words", "absorbed_ms", "max_shift_ms", "gap_ms", "restored_ms", "rejected_ms", "expansion_ms"]
    out = out.fillna(0, counts).fillna(False, ["restored", "rejected", "collapsed", "onset_moved"])
    out = out.withColumn("provider", provider_boundary(F.col("_split"), F.col("start_ms"), F.col("end_ms"), F.col("carried_start"), F.col("carried_end"), F.col("boundary_source")))
    out = out.withColumns({"pb_start": F.col("provider.start_ms"), "pb_end": F.col("provider.end_ms"), "start_ms": F.col("_s"), "end_ms": F.col("_e"), "text": output_text(F.col("status"), F.col("source_text"), F.col("machine_text"))})
    out = out.withColumn("authored_preserved", (F.col("n_words") == 0) & ~F.col("is_music")).join(plan, ["programme_id", "cluster"], "left")
    order = Window.partitionBy("programme_id").orderBy("start_ms", "end_ms", "segment_id", "group_no")
    out = out.withColumn("sequence_index", (F.row_number().over(order) - 1).cast("long"))
    return out.drop("provider", "_s", "_e", "_ws", "_we", "_split", "_groups", "first_cluster", "machine_text", "carried_start", "carried_end", "has_words", "source_text", "boundary_source")


def cluster_counts(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy("programme_id", "cluster").agg(F.count(F.lit(1)).alias("n_rows"))


def word_evidence(words: DataFrame, most: int = 100) -> DataFrame:
    """First unresolved words of each segment, in order, at most `most`, as a list."""
    item = F.struct("word_index", "text", "ps", "pe", "s", "e", "reason")
    g = words.filter("unresolved").groupBy("programme_id", "segment_id").agg(F.sort_array(F.collect_list(item)).alias("words"))
    return g.select("programme_id", "segment_id", F.slice("words", 1, most).alias("words"))
