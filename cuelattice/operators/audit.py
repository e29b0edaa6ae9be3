"""Audit of final rows: defects, same-speaker overlaps, and each row's state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..staging import stage
from . import folds

#: Fixed values that results depend on.
REPAIR_MS = 250
EPSILON_MS = 10
#: Defects from the mildest to the most severe; of several the most severe labels a row.
DEFECTS = ("provider_capture_divergence", "alignment_collapse", "same_speaker_overlap", "unresolved_timing")
STATES = ("VALIDATED", "VALIDATED_WITH_OVERRIDE", "UNRESOLVED_TIMING", "UNRESOLVED_SPEAKER", "MANUALLY_OVERRIDDEN")
BLOCKING = ("UNRESOLVED_TIMING", "UNRESOLVED_SPEAKER")


def most_severe(*findings: tuple[Column, str, Column]) -> Column:
    """struct(defect, size) of the most severe of findings (whether it applies, defect,
    size); of equal ones the first; null if none applies."""
    rank = {d: k for k, d in enumerate(DEFECTS)}
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(rank[d]).alias("rank"), F.lit(-k).alias("first"), F.lit(d).alias("defect"), size.cast("long").alias("size"))) for k, (c, d, size) in enumerate(findings)]))
    return F.array_max(found)


def own_defects(rows: DataFrame) -> DataFrame:
    """Adds inflation_ms, divergence_ms, defect and defect_ms from the row alone;
    the most severe finding is kept."""
    talk = ~F.col("is_music")
    inflation = F.when(talk & ~F.col("rejected"), F.greatest(F.lit(0), F.col("end_ms") - F.col("start_ms") - F.col("capture_ms")))
    r = rows.withColumn("inflation_ms", F.coalesce(inflation, F.lit(0)).cast("long"))
    r = r.withColumn("divergence_ms", F.when(talk, F.greatest("gap_ms", "inflation_ms")).otherwise(F.lit(0)).cast("long"))
    out_of_order, unplaced = F.col("conflict_ms") > 0, talk & (F.col("unresolved_words") + F.col("exhausted_words") > 0)
    diverges = F.col("divergence_ms") > X.DIVERGENCE_MS
    worst = most_severe((out_of_order, "unresolved_timing", F.col("conflict_ms")), (unplaced, "unresolved_timing", F.lit(0)), (talk & F.col("collapsed"), "alignment_collapse", F.lit(0)), (diverges, "provider_capture_divergence", F.col("divergence_ms")))
    return r.withColumn("_worst", worst).withColumns({"defect": F.col("_worst.defect"), "defect_ms": F.col("_worst.size")}).drop("_worst")


def overlap_sweep(rows: DataFrame) -> DataFrame:
    """programme_id, sequence_index, other_index, overlap_ms, repaired: each row that
    begins before the furthest earlier row of its speaker ends. A short overlap that
    erases no word pulls the earlier end back. The furthest row depends on earlier
    repairs, so a speaker's rows are gone through in order, in blocks."""
    return folds.furthest_row(rows, rows.schema["programme_id"].dataType.simpleString(), EPSILON_MS, REPAIR_MS)


def audit(rows: DataFrame) -> DataFrame:
    """Rows with final windows and conflict_ms -> defect, defect_ms, repaired; ends
    pulled back where a repair applies."""
    r = own_defects(rows)
    hits = stage(overlap_sweep(r))
    starts = r.select("programme_id", "sequence_index", F.col("start_ms").alias("_new_end"))
    pulled = hits.filter("repaired").join(starts, ["programme_id", "sequence_index"]).groupBy("programme_id", F.col("other_index").alias("sequence_index")).agg(F.min("_new_end").alias("_new_end"))
    # Both sides of a kept overlap are marked with the first overlap they meet, in
    # order of the later row's start.
    pair = hits.filter("not repaired").join(r.select("programme_id", "sequence_index", F.struct("start_ms", "end_ms", "sequence_index").alias("_at")), ["programme_id", "sequence_index"])
    sides = pair.withColumn("sequence_index", F.explode(F.array("sequence_index", "other_index")))
    marked = sides.groupBy("programme_id", "sequence_index").agg(F.min_by("overlap_ms", "_at").alias("_overlap"))
    r = r.join(pulled, ["programme_id", "sequence_index"], "left").join(marked, ["programme_id", "sequence_index"], "left")
    take = F.col("_overlap").isNotNull() & F.coalesce(F.col("defect") != "unresolved_timing", F.lit(True))
    r = r.withColumns({"defect_ms": F.when(take, F.col("_overlap")).otherwise(F.col("defect_ms")), "defect": F.when(take, "same_speaker_overlap").otherwise(F.col("defect"))})
    r = r.withColumns({"repaired": F.col("_new_end").isNotNull(), "end_ms": F.coalesce("_new_end", "end_ms")})
    return r.drop("_new_end", "_overlap")


def clamp_words(words: Column, boundary: Column) -> Column:
    """Array of (start_ms, end_ms, ...): ends past the boundary come back to it,
    except of words that begin there or later."""
    cut = lambda w: (w["end_ms"] > boundary) & (w["start_ms"] < boundary)
    return F.transform(words, lambda w: F.when(cut(w), w.withField("end_ms", boundary)).otherwise(w))


def would_erase(words: Column, boundary: Column) -> Column:
    return F.coalesce(F.exists(words, lambda w: F.coalesce(w["start_ms"] >= boundary, F.lit(False))), F.lit(False))


def recompute_max_shift(words: Column) -> Column:
    """Largest distance of a word's start or end from the provider's, absent ones 0."""
    gap = lambda w, a, b: F.coalesce(F.abs(w[a] - w[b]), F.lit(0))
    worst = lambda a, w: F.greatest(a, gap(w, "start_ms", "provider_start_ms"), gap(w, "end_ms", "provider_end_ms"))
    return F.coalesce(F.aggregate(words, F.lit(0).cast("long"), worst), F.lit(0))


def integrity_report(audited: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per programme over audited rows; hits is the overlap sweep of the
    rows before repairs."""
    g = audited.groupBy("programme_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("repaired").alias("repaired_rows"), F.count_if(~F.col("is_music") & F.col("collapsed")).alias("collapse_defects"),
        F.count_if(F.col("divergence_ms") > X.DIVERGENCE_MS).alias("divergence_defects"), F.max("inflation_ms").alias("worst_inflation_ms"),
        F.count_if(F.col("inflation_ms") > X.DIVERGENCE_MS).alias("inflated_rows"), F.count_if("onset_moved").alias("onset_rows"), F.count_if("restored").alias("restored_rows"),
        F.count_if("rejected").alias("rejected_rows"), F.count_if(F.col("conflict_ms") > 0).alias("conflict_rows"),
        F.sort_array(F.collect_list(F.when(F.col("defect").isNotNull(), F.col("sequence_index")))).alias("defect_sequences"),
    )
    h = hits.groupBy("programme_id").agg(F.count_if("repaired").alias("overlap_repairs"), F.count_if(~F.col("repaired")).alias("overlap_defects"), F.max("overlap_ms").alias("worst_overlap_ms"))
    return g.join(h, "programme_id", "left").fillna(0, ["overlap_repairs", "overlap_defects", "worst_overlap_ms"])


def repaired_rows(audited: DataFrame, words: DataFrame) -> DataFrame:
    """Rows whose end was pulled back, with the timecode of the new end, their words
    (programme_id, segment_id, group_no, word_index, s, e, ps, pe) clamped to it, how many
    of them changed, and the largest shift of what is left."""
    key = ["programme_id", "segment_id", "group_no"]
    fixed = audited.filter("repaired").select(*key, F.col("end_ms"), X.timecode(F.col("end_ms")).alias("tc_out"))
    item = F.struct("word_index", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"), F.col("ps").alias("provider_start_ms"), F.col("pe").alias("provider_end_ms"))
    lists = words.join(fixed.select(*key), key, "left_semi").groupBy(*key).agg(F.sort_array(F.collect_list(item)).alias("_words"))
    out = fixed.join(lists, key, "left").withColumn("words", clamp_words(F.col("_words"), F.col("end_ms")))
    changed = F.size(F.filter(F.zip_with("_words", "words", lambda a, b: a["end_ms"] != b["end_ms"]), lambda x: x))
    return out.withColumns({"clamped_words": F.coalesce(changed, F.lit(0)).cast("long"), "max_provider_shift_ms": recompute_max_shift(F.col("words"))}).drop("_words")


#: policy_version of the report.
POLICY = 9


def run_report(audited: DataFrame, hits: DataFrame, words: DataFrame) -> DataFrame:
    """The whole integrity report, one row per programme: over audited rows, the overlap
    sweep of the rows before repairs, and reconciled words."""
    from . import timing

    row = audited.groupBy("programme_id").agg(
        F.count_if(F.col("divergence_ms") > X.DIVERGENCE_MS).alias("provider_capture_defects"), F.count_if(~F.col("is_music") & F.col("collapsed")).alias("alignment_collapse_defects"), F.count_if("onset_moved").alias("onset_reconstructed_rows"),
        F.count_if("restored").alias("capture_restored_rows"), F.count_if("rejected").alias("provider_timing_rejected_rows"), F.coalesce(F.max(F.when(F.col("divergence_ms") > X.DIVERGENCE_MS, F.col("divergence_ms"))), F.lit(0)).alias("worst_provider_divergence_ms"),
        F.max("inflation_ms").alias("worst_acoustic_inflation_ms"), F.count_if(F.col("inflation_ms") > X.DIVERGENCE_MS).alias("inflated_row_count"), F.count_if(F.col("conflict_ms") > 0).alias("chronology_conflict_rows"), F.max("conflict_ms").alias("worst_chronology_inversion_ms"),
        F.slice(F.sort_array(F.collect_list(F.when(F.col("conflict_ms") > 0, F.col("sequence_index")))), 1, 500).alias("chronology_conflict_sequences"), F.sort_array(F.collect_list(F.when(F.col("defect").isNotNull(), F.col("sequence_index")))).alias("defect_sequences"),
    )
    over = hits.groupBy("programme_id").agg(F.count_if("repaired").alias("same_speaker_overlap_repairs"), F.count_if(~F.col("repaired")).alias("same_speaker_overlap_defects"), F.max("overlap_ms").alias("worst_same_speaker_overlap_ms"))
    out = row.join(over, "programme_id", "left").fillna(0, over.columns[1:])
    for part in (timing.capture_report(words), timing.onset_report(words), timing.acceptance_report(words), timing.reconciliation_report(words)):
        out = out.join(part.drop(*[c for c in part.columns if c.endswith("_keys") or c.startswith("cleared_by")]), "programme_id", "left")
    out = out.withColumnRenamed("unrestorable_words", "unrestorable_capture_words")
    out = out.fillna(0, [c for c in out.columns if c.endswith("_words") or c.endswith("_rows") or c.endswith("_ms") or c.endswith("_repairs")])
    fixed = {"policy_version": POLICY, "auto_repair_ceiling_ms": REPAIR_MS, "provider_divergence_threshold_ms": X.DIVERGENCE_MS, "min_plausible_word_ms": X.MIN_WORD_MS}
    return out.withColumns({k: F.lit(v).cast("long") for k, v in fixed.items()})


#: The sentences that tell an operator what decided a row's state.
CHRONOLOGY = "This line and the line next to it are out of order — one of them begins before the line that precedes it. The two were timed from sources that disagree about their order, so nothing was moved: correcting it automatically would mean guessing which of the two is in the right place."
OUT_OF_ORDER = (" This line is also out of order relative to the line next to it (by ", "ms); nothing was moved, because correcting that automatically would mean guessing which of the two is in the right place.")
SENTENCES = {
    "operator": "An operator explicitly ruled on this line; see the recorded override.",
    "unmeasured_text": "This line's text was authored by an operator and has no measured word timings, so refinement carried its text, window and structure through unchanged. Its timing was not verified against the audio.",
    "unplaced_words": " word(s) could not be placed in the audio after bounded search expansion. The transcriber's timing is kept visible as fallback evidence only — it is not validated timing.",
    "window_edge": " word(s) were placed against the edge of the available audio, so their position is not proven.",
    "too_short": " word(s) ended up with a window too short to contain any speech, and the transcriber's own measurement does not agree that they are that brief.",
    "collapse": "Several words were placed at the same instant and no usable alternative timing existed; a re-transcribe of this line is usually the cleanest fix.",
    "overlap": "This line and another line by the same speaker cover the same moment, so one of the two windows is wrong.",
    "chronology": CHRONOLOGY,
    "divergence": "The transcriber's measurement and the audio check disagree beyond the trust threshold and neither could be accepted on evidence.",
    "no_turn": ("No speaker turn covered ", " word(s) on this line, so its attribution was inherited from a neighbour rather than measured."),
    "several_speakers": "Refinement heard more than one speaker inside this operator-authored line. It was kept whole rather than divided, so its speaker attribution is not proven.",
    "island": "Short speaker island inside overlapping speech; the surrounding evidence favors another speaker, so this attribution is not proven.",
    "no_dialogue": "Non-dialogue line: no spoken words to validate, so its window is carried unchanged.",
    "evidence": "Words, timings, boundary and speaker all passed on evidence with nothing overridden.",
}
SPAN_REASON = (
    "Refinement heard ", " different speakers inside this operator-authored line. The line was kept whole rather than divided — splitting it would mean guessing which words belong to which speaker — so its speaker attribution is not proven and needs an operator ruling.",
)
OVERRIDES = {
    "provider_timing_rejected": "the transcriber's timing was overruled as physically impossible",
    "capture_restored": "the audio check's timing was replaced by the transcriber's measured window",
    "onset_reconstructed": "a word start was pulled forward out of untranscribed audio",
    "unresolved_cleared": " word(s) the aligner could not place credibly were resolved from the transcriber's own measurement",
    "search_extended": ("the audio search was extended ", "ms beyond the transcriber's segment boundary"),
    "boundary_derived": "the segment boundary was re-derived from the validated words",
}


def with_span_reason(rows: DataFrame) -> DataFrame:
    """Adds span_reason: of a line kept whole, how many speakers (n_clusters) were heard in it."""
    said = F.concat(F.lit(SPAN_REASON[0]), F.col("n_clusters").cast("string"), F.lit(SPAN_REASON[1]))
    return rows.withColumn("span_reason", F.when(F.col("span_unresolved"), said))


def derive_state(rows: DataFrame, own_reasons: bool = False) -> DataFrame:
    """Adds unresolved_timing, unresolved_speaker, state, cause (short code of what
    decided it), overrides (codes of disclosed corrections, comma-joined) and
    state_reason, the sentence shown for it. own_reasons: a row's span_reason or
    island_reason stands in place of the sentence for its cause, unless null or empty."""
    unmeasured = F.col("authored_preserved") & ~F.col("is_music")
    timing = (
        F.when(unmeasured, "unmeasured_text").when(F.col("unresolved_words") > 0, "unplaced_words").when(F.col("exhausted_words") > 0, "window_edge").when(F.col("near_zero_words") > 0, "too_short")
        .when(F.col("collapsed") | (F.col("defect") == "alignment_collapse"), "collapse").when(F.col("defect") == "same_speaker_overlap", "overlap")
        .when(F.col("conflict_ms") > 0, "chronology").when(F.col("defect") == "provider_capture_divergence", "divergence")
    )
    span, island = F.coalesce("span_unresolved", F.lit(False)), F.coalesce("island", F.lit(False))
    speaker = F.when(F.col("uncovered_words") > 0, "no_turn").when(span & ~island, "several_speakers").when(island, "island")
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    number = lambda c: F.col(c)
    corrections = (
        ("provider_timing_rejected", F.col("rejected"), None), ("capture_restored", F.col("restored"), None), ("onset_reconstructed", F.col("onset_moved"), None),
        ("unresolved_cleared", F.col("cleared_words") > 0, say(number("cleared_words"), OVERRIDES["unresolved_cleared"])),
        ("search_extended", F.col("expansion_ms") > 0, say(OVERRIDES["search_extended"][0], number("expansion_ms"), OVERRIDES["search_extended"][1])), ("boundary_derived", F.col("boundary") == "validated_words", None),
    )
    applies = lambda c, x: F.when(F.coalesce(c, F.lit(False)), x)
    notes = F.array_compact(F.array(*[applies(c, F.lit(n)) for n, c, _ in corrections]))
    told = F.array_compact(F.array(*[applies(c, F.lit(OVERRIDES[n]) if x is None else x) for n, c, x in corrections]))
    r = rows.withColumns({"_t": timing, "_k": speaker, "_n": notes, "_o": told, "_m": F.col("override").isNotNull()})
    state = (
        F.when(F.col("_m"), STATES[4]).when(F.col("_t").isNotNull(), STATES[2]).when(F.col("_k").isNotNull(), STATES[3])
        .when(F.col("is_music"), STATES[0]).when(F.size("_n") > 0, STATES[1]).otherwise(STATES[0])
    )
    cause = F.when(F.col("_m"), "operator").when(F.col("_t").isNotNull(), F.col("_t")).when(F.col("_k").isNotNull(), F.col("_k")).when(F.col("is_music"), "no_dialogue").when(F.size("_n") > 0, "overrides").otherwise("evidence")
    also = (state == STATES[2]) & (F.col("conflict_ms") > 0) & (F.col("_t") != "chronology")
    counted = {"unplaced_words": "unresolved_words", "window_edge": "exhausted_words", "too_short": "near_zero_words"}
    reason = F.when(cause == "overrides", say("Delivered with disclosed evidence-based overrides: ", F.array_join("_o", "; "), "."))
    for code, text in SENTENCES.items():
        known = say(number(counted[code]), text) if code in counted else say(text[0], number("uncovered_words"), text[1]) if code == "no_turn" else F.lit(text)
        if own_reasons and code in ("several_speakers", "island"):
            known = F.coalesce(F.nullif(F.col("span_reason" if code == "several_speakers" else "island_reason"), F.lit("")), known)
        reason = reason.when(cause == code, known)
    reason = F.when(also, F.concat(reason, say(OUT_OF_ORDER[0], number("conflict_ms"), OUT_OF_ORDER[1]))).otherwise(reason)
    out = r.withColumns({
        "unresolved_timing": F.col("_t").isNotNull(), "unresolved_speaker": F.col("_k").isNotNull(), "state": state, "cause": F.when(also, F.concat(cause, F.lit("+chronology"))).otherwise(cause),
        "overrides": F.array_join("_n", ","), "state_reason": reason,
    })
    return out.drop("_t", "_k", "_n", "_o", "_m")


def state_summary(rows: DataFrame) -> DataFrame:
    """Rows per state and programme, zero-filled; total counts unknown states too."""
    n = [F.count_if(F.col("state") == s).alias(s.lower()) for s in STATES]
    return rows.groupBy("programme_id").agg(*n, F.count_if(F.col("state").isin(*BLOCKING)).alias("blocking"), F.count(F.lit(1)).alias("total"))
