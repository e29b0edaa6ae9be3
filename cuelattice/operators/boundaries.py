"""Final windows of output rows, and what is out of order among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X

#: Fixed values that results depend on.
LEAD_IN_MS = 120
LEAD_OUT_MS = 200
STABLE_MS = 150


def derive_boundaries(rows: DataFrame, duration_ms: str | None = None) -> DataFrame:
    """Rows with core_start/core_end (null without a trusted word), n_words,
    pb_start/pb_end (null: no comparable provider window) -> new start_ms, end_ms,
    boundary, lead_in_ms, lead_out_ms, delta_start_ms, delta_end_ms, contradicted,
    recovered. duration_ms names a column with the programme's length, if known.

    A row's end never depends on the final end before it, so three window passes do
    what a sequential sweep would."""
    order = Window.partitionBy("programme_id").orderBy("sequence_index")
    so_far = Window.unboundedPreceding, -1
    before = order.rowsBetween(*so_far)
    # Looking ahead is looking back in reverse order: that frame grows row by row.
    after = Window.partitionBy("programme_id").orderBy(F.desc("sequence_index")).rowsBetween(*so_far)
    core = F.col("core_start").isNotNull()
    lost = ~core & (F.col("n_words") > 0)
    usable = lost & F.coalesce((F.col("pb_end") > F.col("pb_start")) & (F.col("pb_start") >= 0), F.lit(False))
    r = rows.withColumns({"_core": core, "_lost": lost, "recovered": usable})
    r = r.withColumns({"_s0": F.when(usable, F.col("pb_start")).otherwise(F.col("start_ms")), "_e0": F.when(usable, F.col("pb_end")).otherwise(F.col("end_ms"))})
    r = r.withColumns({"_span_end": F.coalesce("core_end", "_e0"), "_span_start": F.coalesce("core_start", "start_ms")})
    r = r.withColumns({"_prev": F.last("_span_end", True).over(before), "_next": F.last("_span_start", True).over(after)})
    last_room = F.lit(float(LEAD_OUT_MS)) if duration_ms is None else F.coalesce(F.greatest(F.lit(0.0), (F.col(duration_ms) - F.col("core_end")).cast("double")), F.lit(float(LEAD_OUT_MS)))
    lead_room = F.when(F.col("_prev").isNull(), F.greatest(F.lit(0.0), F.col("core_start").cast("double"))).otherwise(F.greatest(F.lit(0.0), (F.col("core_start") - F.col("_prev")) / 2))
    trail_room = F.when(F.col("_next").isNull(), last_room).otherwise(F.greatest(F.lit(0.0), (F.col("_next") - F.col("core_end")) / 2))
    r = r.withColumns({"_in": X.half_up(F.least(F.lit(float(LEAD_IN_MS)), lead_room)), "_out": X.half_up(F.least(F.lit(float(LEAD_OUT_MS)), trail_room))})
    end = F.col("core_end") + F.col("_out")
    r = r.withColumn("_end", F.when(F.col("_next").isNotNull() & (end > F.col("_next")), F.greatest("core_end", "_next")).otherwise(end))
    keep_end = F.coalesce((F.col("pb_end") >= F.col("core_end")) & (F.abs(F.col("pb_end") - F.col("_end")) <= STABLE_MS) & F.coalesce(F.col("pb_end") <= F.col("_next"), F.lit(True)), F.lit(False))
    r = r.withColumn("_keep_end", F.col("_core") & keep_end)
    r = r.withColumn("_final_end", F.when(~F.col("_core"), F.col("_e0")).when(F.col("_keep_end"), F.col("pb_end")).otherwise(F.col("_end")))
    r = r.withColumn("_fence", F.lag("_final_end").over(order))
    start = F.col("core_start") - F.col("_in")
    r = r.withColumn("_start", F.greatest(F.lit(0), F.when(F.col("_fence") > start, F.least("core_start", "_fence")).otherwise(start)))
    keep_start = F.coalesce((F.col("pb_start") <= F.col("core_start")) & (F.abs(F.col("pb_start") - F.col("_start")) <= STABLE_MS) & F.coalesce(F.col("pb_start") >= F.col("_fence"), F.lit(True)) & (F.col("pb_start") >= 0), F.lit(False))
    r = r.withColumn("_keep_start", F.col("_core") & keep_start)
    r = r.withColumn("_final_start", F.when(~F.col("_core"), F.col("_s0")).when(F.col("_keep_start"), F.col("pb_start")).otherwise(F.col("_start")))
    kind = (
        F.when(F.col("_keep_start") & F.col("_keep_end"), "validated_words_stable").when(F.col("_core"), "validated_words").when(F.col("_lost"), "unresolved_words_preserved")
        .when(F.col("authored_preserved"), "authored_preserved").otherwise("music_preserved")
    )
    zero = lambda c: F.when(F.col("_core"), F.greatest(F.lit(0), c)).otherwise(F.lit(0)).cast("long")
    out = r.withColumns({
        "boundary": kind, "lead_in_ms": zero(F.col("core_start") - F.col("_final_start")), "lead_out_ms": zero(F.col("_final_end") - F.col("core_end")),
        "delta_start_ms": F.coalesce(F.col("_final_start") - F.col("start_ms"), F.lit(0)), "delta_end_ms": F.coalesce(F.col("_final_end") - F.col("end_ms"), F.lit(0)),
        "contradicted": F.col("_core") & (F.coalesce(F.col("pb_start") > F.col("core_start"), F.lit(False)) | F.coalesce(F.col("pb_end") < F.col("core_end"), F.lit(False))),
    })
    out = out.withColumns({"start_ms": F.col("_final_start"), "end_ms": F.col("_final_end")})
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def mark_chronology(rows: DataFrame) -> DataFrame:
    """conflict_ms: the worst inversion of a row's start against a neighbour's, else 0."""
    order = Window.partitionBy("programme_id").orderBy("sequence_index")
    back = F.coalesce(F.lag("start_ms").over(order) - F.col("start_ms"), F.lit(0))
    ahead = F.coalesce(F.col("start_ms") - F.lead("start_ms").over(order), F.lit(0))
    return rows.withColumn("conflict_ms", F.greatest(F.lit(0), back, ahead).cast("long"))


def boundary_report(rows: DataFrame) -> DataFrame:
    """One row per programme over derived and marked rows."""
    kinds = ("validated_words", "validated_words_stable", "music_preserved", "authored_preserved", "unresolved_words_preserved")
    core = F.col("core_start").isNotNull()
    worst = lambda c: F.greatest(F.lit(0), F.coalesce(F.max(F.when(core, c)), F.lit(0))).cast("long")
    clash = F.transform(F.sort_array(F.collect_list(F.when(F.col("conflict_ms") > 0, F.col("sequence_index")))), lambda x: x)
    return rows.groupBy("programme_id").agg(
        *[F.count_if(F.col("boundary") == k).alias(k) for k in kinds], F.count_if("recovered").alias("recovered"), F.count_if("contradicted").alias("contradicted"),
        worst(F.col("end_ms") - F.col("pb_end")).alias("worst_extension_ms"), worst(F.col("pb_end") - F.col("end_ms")).alias("worst_reduction_ms"), worst(F.col("lead_out_ms")).alias("worst_lead_out_ms"),
        F.count_if(F.col("conflict_ms") > 0).alias("conflict_rows"), F.max("conflict_ms").alias("worst_conflict_ms"), F.slice(clash, 1, 500).alias("conflict_sequences"),
    )
