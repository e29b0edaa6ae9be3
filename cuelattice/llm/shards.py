"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked. The row of rank r among n
has the fractional rank (2r - 1) / 2n, so each source is spread evenly over (0, 1). All
rows, sorted by it, are cut into shards whose counts differ by one at most; a shard is an
interval of fractional ranks and so holds its share of every source, to within a row or two.

Only DataFrame functions are used. Neither a source nor the whole table is sorted in one
task: hashes and fractional ranks are uniform, so both orders are cut in equal buckets of
about BUCKET_ROWS rows, whose counts are summed first (map-side) and then give each
bucket's base.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SHARDS = 8
SEED = 12
BUCKET_ROWS = 2_000
#: Beyond this many buckets of one source, or of all rows, buckets grow instead.
MAX_BUCKETS = 100_000
#: Bits of the shuffling hash; times MAX_BUCKETS it stays within a long.
BITS = 40


def shuffle_key(doc_id: Column, crc: Column, seed: int = SEED) -> Column:
    """Uniform in [0, 2^40), from an MD5 of the id, the text's CRC and the seed: rows that
    share an id, or have none, part where their texts do."""
    said = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), crc.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(said), 1, BITS // 4), 16, 10).cast("long")


def n_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _bases(counts: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """(keys, bucket, n) -> rows before each bucket, as _base. Has at most MAX_BUCKETS rows
    for each of the keys."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))


def _buckets(n: Column) -> Column:
    return F.least(F.ceil(n / BUCKET_ROWS), F.lit(MAX_BUCKETS)).cast("long")


def interleave(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """rows (_source string, _hash long in [0, 2^40), _tie, ...), read more than once, -> the
    same and shard, slot. _source is not null; rows alike in all three are interchangeable."""
    per = materialise(rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows")), "shard-sources")
    keyed = rows.join(per, "_source").withColumn("_bucket", F.shiftright(F.col("_hash") * _buckets(F.col("_rows")), BITS))
    bases = _bases(keyed.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n")), ["_source"], "_bucket")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_hash", "_tie")
    ranked = keyed.withColumn("_in", F.row_number().over(inside)).join(bases, ["_source", "_bucket"])
    total = rows.count()
    n = max(1, min(-(-total // BUCKET_ROWS), MAX_BUCKETS))
    spread = ranked.withColumn("_share", (2 * (F.col("_base") + F.col("_in")) - 1) / (2 * F.col("_rows"))).drop("_bucket", "_base", "_in", "_rows")
    spread = materialise(spread.withColumn("_bucket", F.least(F.floor(F.col("_share") * n), F.lit(n - 1))), "shard-order")
    bases = _bases(spread.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_all", F.lit(0)), ["_all"], "_bucket").drop("_all")
    inside = Window.partitionBy("_bucket").orderBy("_share", "_source", "_hash", "_tie")
    at = spread.withColumn("_in", F.row_number().over(inside)).join(bases, "_bucket").withColumn("_at", F.col("_base") + F.col("_in") - 1)
    shard = F.expr(f"cast((_at * {shards}L) div {max(total, 1)}L as int)")
    start = F.expr(f"(cast(shard as bigint) * {total}L + {shards - 1}L) div {shards}L")
    return at.withColumn("shard", shard).withColumn("slot", F.col("_at") - start).drop("_source", "_hash", "_tie", "_share", "_bucket", "_in", "_base", "_at")


def _keyed(docs: DataFrame, payload: list[Column], seed: int) -> DataFrame:
    """A null source is one of its own, apart from every name."""
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source"),
        shuffle_key(F.col("doc_id"), F.col("_crc"), seed).alias("_hash"), F.struct("doc_id", "_size", "_crc").alias("_tie"), *payload,
    )


def shard_digest(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, text, source, ...) -> doc_id, size, text_crc32, law (`rows`), shard, slot,
    grown_shard (null), one row per input row. Texts are read once and never shuffled.

    Counts of shards differ by one at most, which equal texts held together could not
    give: copies are spread like other rows. Null texts have size 1 and the CRC of the
    empty text; null sources are one source; null ids and repeated rows take part, and
    rows alike in id, size and CRC are interchangeable; an empty table gives an empty
    result. Other columns are ignored, whatever their names."""
    slim = docs.select("doc_id", "source", n_bytes(F.col("text")).alias("_size"), crc(F.col("text")).alias("_crc"))
    out = interleave(materialise(_keyed(slim, [], seed).withColumn("_row", F.col("_tie")), "shard-rows"), shards)
    return out.select(
        "_row.doc_id", F.col("_row._size").alias("size"), F.col("_row._crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """docs with shard and slot; a column of either name is replaced, all others stay,
    whatever their names. Nulls, ties, repeats and empty tables as in `shard_digest`; rows
    alike in id, size and CRC of the text are told apart by a hash of all they hold."""
    cols = [c for c in docs.columns if c not in ("shard", "slot")]
    whole = F.struct(*[F.col(f"`{c}`") for c in cols])
    own = docs.select(whole.alias("_doc")).select("_doc", "_doc.doc_id", "_doc.source", n_bytes(F.col("_doc.text")).alias("_size"), crc(F.col("_doc.text")).alias("_crc"))
    keyed = _keyed(own, ["_doc"], seed).withColumn("_tie", F.struct("_tie", F.xxhash64("_doc")))
    out = interleave(materialise(keyed, "shard-rows"), shards)
    return out.select(*[F.col(f"_doc.`{c}`").alias(c) for c in cols], "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Parquet folders shard=0, 1, ... under path, rows in order of slot. The writing task
    holds a sorted stretch of one shard; a retried task writes the same rows again."""
    out = shard_documents(docs, shards, seed)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
