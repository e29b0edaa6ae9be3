"""Two providers' words of one programme: lineage, agreement, fragments, captions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .intervals import BUCKET_MS

#: Fixed values that results depend on.
FRAGMENT_MS, FRAGMENT_WORDS, JOIN_MS = 1200, 3, 650
FLOOR_MEAN, MOST_P99, MOST_OUTLIERS = 0.5, 30_000, 0.005


def token(text: Column) -> Column:
    """Lower-case letters and digits. Equal to the NFKD rule on ASCII text."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]", "")


def token_nfkd(column: str) -> Column:
    """Lower-case letters and digits of the text's compatibility form (NFKD), in which
    accents are characters of their own and go. ASCII text takes the native way; the
    rest, in Arrow batches, a function of Python's Unicode tables."""
    text = F.coalesce(F.col(column), F.lit(""))
    ascii_ = ~text.rlike(r"[^\x00-\x7F]")
    return F.when(ascii_, token(F.col(column))).otherwise(token(_decomposed(F.when(~ascii_, text))))


def _decomposed(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")

    return run(text)


def secondary_words(stream: DataFrame) -> DataFrame:
    """(programme_id, n, kind, text, start_s, end_s) -> key `s:{count of kept}`, ms."""
    kept = stream.filter(~F.coalesce("kind", F.lit("word")).isin("spacing", "audio_event") & ~X.punctuation_only(F.col("text")))
    k = F.row_number().over(Window.partitionBy("programme_id").orderBy("n")) - 1
    ms = lambda c: X.half_up(F.col(c) * 1000)
    return kept.select("programme_id", F.concat(F.lit("s:"), k).alias("key"), "text", ms("start_s").alias("s"), ms("end_s").alias("e"))


def lineage_errors(asked: DataFrame, answered: DataFrame) -> DataFrame:
    """Positions at which a response doesn't match its request; empty when verified.
    Both: programme_id, pos, key, text; answered also s, e."""
    b = answered.select("programme_id", "pos", F.col("key").alias("key2"), F.col("text").alias("text2"), "s", "e")
    j = asked.select("programme_id", "pos", "key", "text").join(b, ["programme_id", "pos"], "full")
    fault = (
        F.when(F.col("key2").isNull(), "missing").when(F.col("key").isNull(), "unexpected").when(F.col("key") != F.col("key2"), "key")
        .when(token(F.col("text")) != token(F.col("text2")), "text").when(~F.coalesce(F.col("e") > F.col("s"), F.lit(False)), "window")
    )
    return j.withColumn("fault", fault).filter("fault is not null").select("programme_id", "pos", "fault")


def disagreements(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """primary and secondary (programme_id, key, text, s, e): each primary word with
    the secondary word it overlaps most (ties to the earliest) and agree, differs or
    unmatched; secondary words that nothing overlaps come as unmatched, key2 only."""
    b = lambda df: df.withColumn("b", F.explode(F.sequence(F.floor(F.col("s") / BUCKET_MS), F.floor(F.greatest("s", "e") / BUCKET_MS))))
    t = secondary.select("programme_id", F.col("key").alias("key2"), F.col("text").alias("text2"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    tb = t.withColumn("b", F.explode(F.sequence(F.floor(F.col("s2") / BUCKET_MS), F.floor(F.greatest("s2", "e2") / BUCKET_MS))))
    o = F.least("e", "e2") - F.greatest("s", "s2")
    hit = b(primary).join(tb, ["programme_id", "b"]).withColumn("o", o).filter("o > 0")
    best = hit.groupBy("programme_id", "key").agg(F.max_by(F.struct("key2", "text2"), F.struct(F.col("o"), -F.col("s2"), -F.col("e2"), "key2")).alias("x"))
    p = primary.join(best, ["programme_id", "key"], "left")
    verdict = F.when(F.col("x").isNull(), "unmatched").when(token(F.col("text")) == token(F.col("x.text2")), "agree").otherwise("differs")
    lonely = t.join(hit.select("programme_id", "key2").distinct(), ["programme_id", "key2"], "left_anti")
    return p.select("programme_id", "key", F.col("x.key2").alias("key2"), verdict.alias("verdict")).unionByName(lonely.select("programme_id", F.lit(None).cast("string").alias("key"), "key2", F.lit("unmatched").alias("verdict")))


def alignment_gate(runs: DataFrame) -> DataFrame:
    """runs with verified, mean_confidence, p99_shift, outlier_ratio, max_shift."""
    both = F.col("p99_shift").isNotNull() & F.col("outlier_ratio").isNotNull()
    reason = (
        F.when(~F.coalesce("verified", F.lit(False)), "not_verified").when(~F.coalesce(F.col("mean_confidence") >= FLOOR_MEAN, F.lit(False)), "mean_confidence")
        .when(both & (F.col("p99_shift") > MOST_P99), "p99_shift").when(both & (F.col("outlier_ratio") > MOST_OUTLIERS), "outlier_ratio").when(~both & (F.col("max_shift") > MOST_P99), "max_shift").otherwise("pass")
    )
    return runs.withColumn("verdict", reason)


def merge_fragments(pieces: DataFrame, *carried: str) -> DataFrame:
    """Sentence pieces (programme_id, segment_id, piece, start_ms, end_ms, n_words)
    with merged: short ones join the piece before, else the piece after, across small
    gaps. A segment's few pieces pass through one ordered fold. carried: columns that stay."""
    item = F.struct("piece", "start_ms", "end_ms", "n_words", "next_ms", *carried)
    order = Window.partitionBy("programme_id", "segment_id").orderBy("piece")
    per = pieces.withColumn("next_ms", F.lead("start_ms").over(order)).groupBy("programme_id", "segment_id").agg(F.sort_array(F.collect_list(item)).alias("p"))
    frag = f"(r.end_ms - coalesce(a.cs, r.start_ms) < {FRAGMENT_MS} and r.n_words + a.cn < {FRAGMENT_WORDS})"
    back = f"({frag} and coalesce(coalesce(a.cs, r.start_ms) - a.pe < {JOIN_MS}, false))"
    on = f"(not {back} and {frag} and coalesce(r.next_ms - r.end_ms < {JOIN_MS}, false))"
    out = "array<struct<piece:bigint,merged:bigint>>"
    fold = f"""aggregate(p, named_struct('g', -1L, 'pe', cast(null as bigint), 'cs', cast(null as bigint), 'cn', 0L, 'out', cast(array() as {out})), (a, r) -> named_struct(
        'g', if({back} or {on}, a.g, a.g + 1), 'pe', if({on}, a.pe, r.end_ms), 'cs', if({on}, coalesce(a.cs, r.start_ms), cast(null as bigint)), 'cn', if({on}, a.cn + r.n_words, 0L),
        'out', array_append(a.out, named_struct('piece', r.piece, 'merged', if({back}, a.g, a.g + 1)))), a -> a.out)"""
    if not carried:
        return per.select("programme_id", "segment_id", F.explode(F.expr(fold)).alias("x")).select("programme_id", "segment_id", "x.*")
    x = per.withColumn("m", F.expr(fold)).select("programme_id", "segment_id", F.explode(F.arrays_zip("p", "m")).alias("x"))
    return x.select("programme_id", "segment_id", "x.m.*", *[F.col(f"x.p.{c}") for c in carried])


def language_code(tag: Column) -> Column:
    """Folded language tag; null for auto and blank."""
    t = F.lower(F.regexp_replace(F.trim(tag), "_", "-"))
    # Aliases.
    alias = F.create_map(*[F.lit(x) for x in ("en-us", "en_us", "en-gb", "en_uk", "en-au", "en_au", "nb", "no", "nn", "no", "no", "no", "he", "he", "iw", "he")])
    return F.when(F.coalesce(t, F.lit("")).isin("", "auto"), None).otherwise(F.coalesce(F.try_element_at(alias, t), F.split(t, "-")[0]))


def deterministic_uuid(seed: Column) -> Column:
    """First 16 bytes of SHA-256 with version 4 and variant bits."""
    h = F.sha2(seed, 256)
    nibble = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-4"), F.substring(h, 14, 3), F.lit("-"), nibble, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def retry_after_ms(header: Column, now: Column | None = None) -> Column:
    """Whole seconds, or with `now` (a timestamp) an HTTP date relative to it; at most
    30 s, never below 0; null where the header is neither."""
    h = F.trim(header)
    ms = F.when(h.rlike(r"^\d+$"), h).try_cast("long") * 1000
    if now is not None:
        at = F.try_to_timestamp(F.substring(h, 6, 40), F.lit("dd MMM yyyy HH:mm:ss z"))
        ms = F.coalesce(ms, F.unix_millis(at) - F.unix_millis(now))
    return F.when(ms.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(30_000), ms))).cast("long")
