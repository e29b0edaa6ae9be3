"""Very short rows whose surroundings favour another speaker (evidence only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .intervals import NODE, cover, levels_of, touch

#: Fixed values that results depend on.
MAX_WORDS = 2
MAX_MS = 400
TIGHT_MS = 300
CONTACT_MS = 40
PROBE_MS = 400
OVERLAP_MS = 100
REASON = ("Short speaker island inside overlapping speech; surrounding evidence favors ", ".")


def ends_sentence(text: Column) -> Column:
    """Whether the last character but white space and closing marks ends a sentence."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\x0B\x{85}\p{Z}\x{FEFF}]+\z", ""), r"""["'”’»)\]]+\z""", "")
    return bare.rlike(r"[.!?…。！？؟।]\z")


def starts_mid_sentence(text: Column) -> Column:
    """The first character that has two cases is lower-case; false without one."""
    cased = F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), ""), lambda c: F.lower(c) != F.upper(c))
    first = F.try_element_at(cased, F.lit(1))
    return F.coalesce(first == F.lower(first), F.lit(False))


def competing_ms(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """rows (programme_id, sequence_index, start_ms, end_ms, cluster, target) ->
    overlap_ms: longest time that the target's cluster is heard with the row's own
    cluster close to the row, or inside the row itself; 0 if never."""
    r = rows.filter("cluster <> '' and target <> '' and cluster <> target").select("programme_id", "sequence_index", "start_ms", "end_ms", "cluster", "target")
    t = turns.select("programme_id", F.col("cluster").alias("tc"), F.col("start_ms").alias("ts"), F.col("end_ms").alias("te"))
    near = touch(r, levels_of(t, "ts", "te"), F.col("start_ms") - PROBE_MS, F.col("end_ms") + PROBE_MS).join(cover(t, "ts", "te"), NODE)
    near = near.filter((F.col("te") > F.col("start_ms") - PROBE_MS) & (F.col("ts") < F.col("end_ms") + PROBE_MS))
    key = ["programme_id", "sequence_index"]
    rival = near.filter("tc = target").select(*key, "start_ms", "end_ms", F.col("ts").alias("rs"), F.col("te").alias("re")).distinct()
    own = near.filter("tc = cluster").select(*key, "ts", "te").distinct()
    within = F.least("end_ms", "re") - F.greatest("start_ms", "rs")
    both = F.least("te", "re") - F.greatest("ts", "rs")
    # Dealt by programme, as windows have dealt the rows, which then stay where they are.
    hit = rival.join(own, key, "left").select(*key, "start_ms", "end_ms", "rs", "re", "ts", "te").repartition("programme_id").groupBy(*key).agg(F.greatest(F.max(within), F.max(both), F.lit(0)).alias("overlap_ms"))
    return rows.join(hit, key, "left").withColumn("overlap_ms", F.coalesce("overlap_ms", F.lit(0)).cast("long"))


def detect_islands(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """Rows (..., sequence_index, start_ms, end_ms, cluster, is_music, n_words, text)
    with island (boolean), overlap_ms, suggested (the target's cluster), signals and
    island_reason, the sentence that names the favoured speaker; null where no island is
    seen. speaker_index, if there, numbers speakers whose cluster has no number."""
    place = F.col("speaker_index") if "speaker_index" in rows.columns else F.lit(0)
    rows = rows.withColumn("_place", place)
    order = Window.partitionBy("programme_id").orderBy("sequence_index")
    me = F.struct("cluster", "is_music", "start_ms", "end_ms", "text", "_place")
    r = rows.withColumns({"_p": F.lag(me).over(order), "_n": F.lead(me).over(order)})
    other = lambda x: F.coalesce(~F.col(x + ".is_music") & (F.col(x + ".cluster") != F.col("cluster")), F.lit(False))
    r = r.withColumns({"_gb": F.greatest(F.lit(0), F.col("start_ms") - F.col("_p.end_ms")), "_ga": F.greatest(F.lit(0), F.col("_n.start_ms") - F.col("end_ms")), "_cp": other("_p"), "_cn": other("_n")})
    r = r.withColumns({"_gb": F.when(F.col("_p").isNotNull(), F.col("_gb")), "_ga": F.when(F.col("_n").isNotNull(), F.col("_ga"))})
    tight = lambda c: F.coalesce(F.col(c) <= TIGHT_MS, F.lit(False))
    atomic = ~F.col("is_music") & F.col("cluster").isNotNull() & F.col("n_words").between(1, MAX_WORDS) & (F.greatest(F.lit(0), F.col("end_ms") - F.col("start_ms")) <= MAX_MS)
    r = r.withColumns({
        "_atomic": F.coalesce(atomic, F.lit(False)), "_seam": tight("_gb") | tight("_ga"), "_sandwich": F.col("_cp") & F.col("_cn") & F.coalesce(F.col("_p.cluster") == F.col("_n.cluster"), F.lit(False)),
        "_fwd": F.col("_cn") & tight("_ga") & ~ends_sentence(F.col("text")) & starts_mid_sentence(F.col("_n.text")),
        "_bwd": F.col("_cp") & tight("_gb") & ~ends_sentence(F.col("_p.text")) & starts_mid_sentence(F.col("text")),
    })
    r = r.withColumn("_to_next", F.col("_fwd") | (~F.col("_bwd") & F.col("_sandwich")))
    r = r.withColumn("target", F.when(F.col("_atomic"), F.when(F.col("_to_next"), F.col("_n.cluster")).otherwise(F.col("_p.cluster"))))
    r = r.withColumns({"_contact": F.coalesce(F.when(F.col("_to_next"), F.col("_ga")).otherwise(F.col("_gb")) <= CONTACT_MS, F.lit(False)), "_attached": F.col("_fwd") | F.col("_bwd")})
    r = competing_ms(r, turns).withColumn("_over", F.col("overlap_ms") >= OVERLAP_MS)
    symmetric = F.col("_sandwich") & F.when(F.col("_over"), F.col("_seam") | F.col("_attached")).otherwise(F.col("_seam") & F.col("_attached"))
    fires = F.col("_atomic") & ((F.col("_attached") & (F.col("_sandwich") | F.col("_over") | F.col("_contact"))) | symmetric)
    name = lambda c, s: F.when(F.col(c), F.lit(s))
    way = F.when(F.col("_attached"), F.when(F.col("_to_next"), "attached_to_next").otherwise("attached_to_previous"))
    signals = F.array_compact(F.array(
        F.lit("atomic_row"), name("_attached", "directional_attachment"), way, name("_sandwich", "same_speaker_sandwich"), name("_seam", "sub_seam_gap_to_neighbour"),
        name("_contact", "contact_seam"), name("_over", "competing_speaker_activity"), name("_attached", "lexical_continuity"),
    ))
    out = r.withColumn("island", fires & F.col("target").isNotNull())
    favoured = X.speaker_label(F.col("target"), F.coalesce(F.when(F.col("_to_next"), F.col("_n._place")).otherwise(F.col("_p._place")), F.lit(0)))
    out = out.withColumns({
        "suggested": F.when(F.col("island"), F.col("target")), "signals": F.when(F.col("island"), F.array_join(signals, ",")),
        "island_reason": F.when(F.col("island"), F.concat(F.lit(REASON[0]), favoured, F.lit(REASON[1]))),
    })
    return out.drop("target", *[c for c in out.columns if c.startswith("_")])
