"""The registered queries of the training-data operators, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clusters, fingerprints, language, mixing, neighbours, page_text, passages, phrases, pieces, quality, shards, simhash, token_files
from .cluster_sql import cluster_sql
from .common import table


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digest_repeats(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_round_trip(table(spark, sf_dir, "documents"), piece_model_path())


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_tokens(token_files.write_tokens(table(spark, sf_dir, "documents"), word_bpe_path(), end=2))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_digest(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_passages, op3_fingerprints, op4_language, op5_pieces, op6_token_files, op7_neighbours, op8_page_text, op9_simhash, op10_quality,
        op11_clusters, op12_shards, op13_phrases,
    )
}

ORACLES = {
    "op1_mix_sources": r"""
with w as (select doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) size from documents),
k as (select *, -ln((cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':1'), 1, 12) as bigint) + 1) / 281474976710656.0)
    / (case when size > 0 then 0.5 + 6.0 / (6.0 + abs(length(text) / size - 6.0)) else 0.5 end) key from w),
s as (select source, cast(sum(size) as bigint) source_size from k group by source),
t as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double wt, source_size * 3 room from s),
l as (select *, (sum(source_size) over () - coalesce(sum(room) over (order by room / wt, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(wt) over (order by room / wt, source nulls last rows between current row and unbounded following) lev from t),
p as (select source, source_size, least(room::double, max(lev) over () * wt) target from l),
e as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end epochs from p),
r as (select k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size rest,
    sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.size rows between unbounded preceding and current row) - k.size / 2 mid from k join e on k.source is not distinct from e.source)
select doc_id, size, source_size, target, cast((epochs + case when mid <= rest then 1 else 0 end) * size as bigint) taken from r""",
    "op11_clusters": cluster_sql(),
    "op12_shards": r"""
with t as (select list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) order by i) t from (select unnest(range(256)) i)),
b as (select doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: cast('0x' || h as bigint)) x from documents),
c as (select doc_id, source, size, xor(list_reduce([4294967295] || x, lambda s, y: xor(s >> 8, t[(xor(s, y) & 255) + 1])), 4294967295) crc from b, t),
k as (select *, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || crc || ':12'), 1, 10) as bigint) h, coalesce('=' || source, '') src from c),
r as (select *, (2 * row_number() over (partition by src order by h, doc_id nulls first, size, crc) - 1)::double / (2 * count(*) over (partition by src))::double share from k),
p as (select *, row_number() over (order by share, src, h, doc_id nulls first, size, crc) - 1 pos, count(*) over () total from r)
select doc_id, size, crc text_crc32, 'rows' law, cast(pos * 8 // total as integer) shard, cast(pos - ((pos * 8 // total) * total + 7) // 8 as bigint) slot, cast(null as integer) grown_shard from p""",
    "op13_phrases": r"""
with p as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from p), i as (select lang, w, unnest(range(1, len(w) + 1)) i from w),
n as (select lang, count(*) n from i group by lang),
g as (select lang, k words, array_to_string(w[i:i + k - 1], ' ') phrase from i, range(1, 6) t(k) where i + k - 1 <= len(w)),
f as materialized (select lang, words, phrase, count(*) a from g group by all having count(*) >= 100),
c as (select f.*, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') lp, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') rp from f, range(1, 5) t(k) where k < words),
s as (select c.lang, c.words, c.phrase, c.a, n.n, k, x.a l, y.a r, (1000::hugeint * c.a * n.n) // (x.a::hugeint * y.a) score from c join f x on x.lang = c.lang and x.phrase = lp join f y on y.lang = c.lang and y.phrase = rp join n on n.lang = c.lang),
m as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
h as (select lang, array_to_string(string_split(phrase, ' ')[j:j + k - 1], ' ') phrase, max(a) longer from f, range(2, 5) t(k), range(1, 5) u(j) where k < words and j + k - 1 <= words group by 1, 2),
o as (select m.*, row_number() over (partition by m.lang order by score desc, a desc, phrase) rk from m left join h using (lang, phrase) where longer is null or 100 * longer < 100 * a)
select lang, rk rank, phrase, a, l, r, n, cast(score as bigint) score from o where rk <= 2000""",
}
