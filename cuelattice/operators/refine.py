"""The whole refinement of programmes, on anybody's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from . import audit, boundaries, islands, speakers, timing


def bounded_rows(words: DataFrame, turns: DataFrame, segments: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """words as the aligner answers them (see `speakers.reconcile`), turns and segments (see
    `speakers.attribute`) -> output rows with their boundaries and chronology conflicts.
    lengths (programme_id, duration_ms), where known, end a programme's last lead-out."""
    return bounded_from(stage(speakers.reconcile(timing.refine_timing(words))), turns, segments, lengths)


def bounded_from(reconciled: DataFrame, turns: DataFrame, segments: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """`bounded_rows` of words that are refined and reconciled already."""
    rows = stage(speakers.attribute(reconciled, turns, segments))
    if lengths is not None:
        rows = rows.join(lengths.select("programme_id", "duration_ms"), "programme_id", "left")
    return boundaries.mark_chronology(boundaries.derive_boundaries(rows, None if lengths is None else "duration_ms"))


def refine_programmes(words: DataFrame, turns: DataFrame, segments: DataFrame, lengths: DataFrame | None = None, own_reasons: bool = True) -> DataFrame:
    """One row per output row with its final window, speaker, defects and state. Without
    own_reasons a disputed speaker is told by the general sentences."""
    return states(bounded_rows(words, turns, segments, lengths), turns, own_reasons)


def states(bounded: DataFrame, turns: DataFrame, own_reasons: bool = True) -> DataFrame:
    """`refine_programmes` of rows that have their boundaries already."""
    rows = islands.detect_islands(stage(bounded), turns)
    return audit.derive_state(audit.audit(stage(audit.own_defects(audit.with_span_reason(rows)))), own_reasons)


def export_gate(states: DataFrame) -> DataFrame:
    """Per programme the state counts, and whether it may be exported: no row blocks, and
    every row is in a known state."""
    s = audit.state_summary(states)
    known = sum((F.col(x.lower()) for x in audit.STATES), F.lit(0))
    return s.withColumn("exportable", (F.col("blocking") == 0) & (known == F.col("total")))
