"""Mixing sources to target weights.

Efraimidis-Spirakis sampling: each document draws an exponential key divided by
its quality weight; documents of a source are taken in key order until their
summed sizes reach the source's token budget. Complete epochs come first: a
source whose target is e times its size plus a remainder gives every document e
times and the remainder by the sample.

Only DataFrame functions are used. No source is ever sorted whole: keys fall
into monotone buckets (about `BUCKET_ROWS` documents each), bucket totals are
summed map-side, and only the one bucket per source in which the budget runs
out is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3
BUCKET_ROWS = 2_000
MAX_SOURCE_BUCKETS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column, size: Column) -> Column:
    """Default quality weight in (0.5, 1.5]: texts whose mean word takes about six
    characters weigh most. Empty texts weigh 0.5."""
    per_word = F.length(text) / size
    return F.when(size > 0, 0.5 + 6.0 / (6.0 + F.abs(per_word - 6.0))).otherwise(0.5)


def sampling_key(doc_id: Column, weight: Column, seed: int = 1) -> Column:
    """-ln(u)/weight with u in (0, 1] from an MD5 of the id, so reruns agree."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + 1) / F.lit(float(2**48))
    return -F.log(u) / weight


def _bucket(key: Column, n_docs: Column) -> Column:
    """Monotone in the key; about BUCKET_ROWS documents in each."""
    n = F.least(F.ceil(n_docs / BUCKET_ROWS), F.lit(MAX_SOURCE_BUCKETS)).cast("int")
    return F.least(F.floor(n * (1.0 - F.exp(-key))), n - 1).cast("int")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n_docs) -> the same and target.

    Sources in code-point order, null last, weigh `weights` in turn and share all
    sizes; no target passes `cap` times its source's size, and what is cut off is
    shared again by weight. With sources ordered by cap * size / weight, the share
    per unit of weight is the largest of what remains per remaining weight.
    One row per source goes through one task.
    """
    turn = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    w = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    s = sources.withColumn("_w", w).withColumn("_room", F.col("source_size") * cap)
    order = Window.orderBy(F.col("_room") / F.col("_w"), F.asc_nulls_last("source"))
    before, after, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_room").over(before), F.lit(0))
    s = s.withColumn("_level", left / F.sum("_w").over(after))
    level = F.max("_level").over(every)
    return s.withColumn("target", F.least(F.col("_room").cast("double"), level * F.col("_w"))).drop("_w", "_room", "_level")


def plan_mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From rows (source, _id, _size, _key): per source its size, n_docs, target,
    epochs, and where the sample ends: bucket `_cut_bucket` and, inside it, the
    last taken (key, id, size), null if none."""
    totals = rows.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    s = source_targets(totals, weights, cap)
    s = s.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    s = materialise(s.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-sources")

    keyed = same_source(rows, s.select("source", "n_docs", "_rest")).withColumn("_bucket", _bucket(F.col("_key"), F.col("n_docs")))
    sums = keyed.groupBy("source", "_bucket", "_rest").agg(F.sum("_size").alias("_words"))
    upto = F.sum("_words").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    crossed = (
        sums.withColumn("_upto", upto).filter(F.col("_upto") > F.col("_rest"))
        .groupBy("source").agg(F.min(F.struct("_bucket", F.col("_upto") - F.col("_words"))).alias("_x"))
        .select("source", F.col("_x._bucket").alias("_cut_bucket"), F.col("_x.col2").alias("_before"))
    )
    crossed = materialise(crossed, "mix-crossed")
    edge = same_source(keyed, crossed).filter(F.col("_bucket") == F.col("_cut_bucket"))
    inside = Window.partitionBy("source").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("_mid", F.col("_before") + F.sum("_size").over(inside) - F.col("_size") / 2)
    cut = edge.filter(F.col("_mid") <= F.col("_rest")).groupBy("source").agg(F.max(F.struct("_key", "_id", "_size")).alias("_cut"))
    return same_source(same_source(s, crossed.drop("_before"), "left"), cut, "left")


def same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null equal to null. The right side has one row per source;
    Spark broadcasts it only below its size threshold."""
    r = right.withColumnRenamed("source", "_r_source")
    return left.join(r, F.col("source").eqNullSafe(F.col("_r_source")), how).drop("_r_source")


def copies(plan_joined: DataFrame) -> DataFrame:
    """Adds `copies`: complete epochs and one more for documents in the sample."""
    b = _bucket(F.col("_key"), F.col("n_docs"))
    inside = F.struct("_key", "_id", "_size") <= F.col("_cut")
    sampled = F.when(F.col("_cut_bucket").isNull(), F.lit(F.col("_rest") > 0)).otherwise((b < F.col("_cut_bucket")) | ((b == F.col("_cut_bucket")) & F.coalesce(inside, F.lit(False))))
    return plan_joined.withColumn("copies", F.col("epochs") + sampled.cast("long"))


def mix_sizes(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, seed: int = 1) -> DataFrame:
    """(doc_id, text, source, ...) -> doc_id, source, size, source_size, target,
    copies, taken; one row per input row.

    Null texts have size 0; null sources are one source, last in order; rows that
    agree in id and size are taken alike; an empty table gives an empty result.
    Other columns of the input are ignored, whatever their names.
    """
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("_size"), F.col("text"))
    rows = rows.select("doc_id", "source", "_size", F.col("doc_id").alias("_id"), sampling_key(F.col("doc_id"), text_quality(F.col("text"), F.col("_size")), seed).alias("_key"))
    rows = materialise(rows, "mix-rows")
    out = copies(same_source(rows, materialise(plan_mix(rows, weights, cap), "mix-plan")))
    return out.select("doc_id", "source", F.col("_size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("_size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, seed: int = 1, quality: str | None = None) -> DataFrame:
    """The mix itself: every taken document as often as it is taken, with the
    columns of `docs`, whatever their names. Texts are read twice and never shuffled.

    quality: a column of `docs` with positive weights, such as a classifier's score;
    without it (and where it is null) the weight is `text_quality`. Null texts have size
    0; null sources are one source, last in order; documents without words cost nothing
    and are taken once per complete epoch; rows that agree in id and size, repeated
    rows too, are taken alike; ties of keys go by id and size; an empty table gives an
    empty result."""
    cols = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_doc"))
    size = n_words(F.col("_doc.text"))
    weight = text_quality(F.col("_doc.text"), size)
    if quality:
        weight = F.coalesce(F.col(f"_doc.`{quality}`").cast("double"), weight)
    keyed = own.select("_doc", F.col("_doc.source").alias("source"), size.alias("_size"), F.col("_doc.doc_id").alias("_id"), sampling_key(F.col("_doc.doc_id"), weight, seed).alias("_key"))
    plan = materialise(plan_mix(materialise(keyed.select("source", "_id", "_size", "_key"), "mix-rows"), weights, cap), "mix-plan")
    out = copies(same_source(keyed, plan)).filter(F.col("copies") > 0)
    out = out.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return out.select(*[F.col(f"_doc.`{c}`") for c in cols])
