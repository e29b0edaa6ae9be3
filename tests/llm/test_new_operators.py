"""Clusters, shards and phrases against brute force on small, awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cuelattice.llm import clusters, common, phrases, shards

VECTORS = "vec_id long, embedding array<double>, cluster string, pos int, total int, _hash string, _whole int, inertia int"


def brute_clusters(rows, k, rounds, dims, scale, seed):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x * scale) < 2.0**80 for x in v):
            kept.append((i, [math.floor(x * scale) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)].append(v)
        for c, vs in groups.items():
            centroids[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    last = [(i, nearest(v), far(v, centroids[nearest(v)])) for i, v in kept]
    per = Counter()
    for _, c, d in last:
        per[c] += d
    long = lambda n: n if n < 2**63 else None
    return [(i, c, long(d), long(per[c]), long(sum(per.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in last]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, "h", 3, 4) for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("dims,k,rounds,wide", [(4, 3, 4, 1.0), (4, 8, 10, 0.01), (3, 5, 3, 1e6), (3, 4, 3, 1e9), (2, 3, 2, 1e20)])
def test_clusters(spark, dims, k, rounds, wide):
    rng = random.Random(dims * k)
    rows = [(i, [rng.choice([-1, 0, 1, rng.uniform(-1, 1)]) * wide for _ in range(dims)]) for i in range(120)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, [0.0] * dims), (None, [wide] * dims), (200, None), (201, []), (202, [0.0] * (dims + 1)), (203, [float("nan")] * dims), (204, [float("inf"), *[0.0] * (dims - 1)]), (205, [None, *[0.0] * (dims - 1)]), (206, [1e200] * dims), (207, [1e308] * dims)]
    rows += [(300 + i, rows[3][1]) for i in range(60)]
    out = clusters.cluster(vectors(spark, rows), k=k, rounds=rounds, dims=dims)
    got = sorted(map(str, (tuple(r) for r in out.collect())))
    assert got == sorted(map(str, brute_clusters(rows, k, rounds, dims, 1024, 3)))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_of_few_or_no_vectors(spark):
    for rows in ([], [(1, None)], [(1, [0.0, 1.0])], [(1, [0.0, 1.0]), (2, [0.0, 1.0])]):
        got = clusters.cluster(vectors(spark, rows), dims=2).collect()
        assert sorted(map(tuple, got)) == sorted(brute_clusters(rows, 8, 10, 2, 1024, 3))


def test_a_test_of_zero_keeps_the_smaller_number():
    x, won, far = clusters.Tournament([[0, 0], [2, 0], [0, 2], [2, 2]]).play(np.array([[1.0, 1.0], [1.0, 0.0], [2.0, 1.0], [0.0, 1.0]]))
    assert won.tolist() == [0, 0, 1, 0] and far.tolist() == [2, 1, 1, 1]


def test_both_arithmetics_agree():
    rng = np.random.default_rng(1)
    c = rng.integers(-2000, 2000, (6, 8)).tolist()
    x = np.floor(rng.normal(size=(500, 8)) * 1000)
    player = clusters.Tournament(c)
    plain = player.play(x)
    player.widest = 2**60
    exact = player.play(x)
    assert exact[0].dtype == object and plain[0].dtype == np.float64
    assert (plain[1] == exact[1]).all() and (plain[2] == exact[2].astype(float)).all()


DOCS = "doc_id long, text string, lang string, source string, shard string, slot int, _source int, _hash int, _tie int, rank int, n int, a int, `a.b` int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1, 2, 3, 4, 5, 6, 7, 8) for i, t, lang, s in rows], DOCS).repartition(3)


def awkward(n=300):
    rng = random.Random(2)
    rows = [(i, rng.choice(["", "a", "same text", f"text {i}", "é" * (i % 50)]), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]
    rows += [(None, None, None, None)] * 3 + [(None, f"n{i}", None, "a") for i in range(5)] + [(4, "same text", "en", "a")] * 4 + [(9999, "long " * 60_000, None, "z")]
    return rows


def brute_shards(rows, shards_, seed):
    keyed = []
    for i, t, _, s in rows:
        b = (t or "").encode()
        said = f"{'' if i is None else i}:{zlib.crc32(b)}:{seed}"
        keyed.append(("" if s is None else "=" + s, int(hashlib.md5(said.encode()).hexdigest()[:10], 16), (i is not None, i or 0), len(b) + 1, zlib.crc32(b)))
    of = Counter(k[0] for k in keyed)
    rank, order = Counter(), []
    for k in sorted(keyed):
        rank[k[0]] += 1
        order.append(((2 * rank[k[0]] - 1) / (2 * of[k[0]]), *k))
    n, out = len(order), []
    starts = [-(-s * n // shards_) for s in range(shards_)]
    for p, (_, _, _, i, size, crc) in enumerate(sorted(order)):
        s = p * shards_ // n
        out.append((i[1] if i[0] else None, size, crc, "rows", s, p - starts[s], None))
    return out


@pytest.mark.parametrize("bucket,n", [(2000, 8), (7, 8), (1, 3)])
def test_shards(spark, monkeypatch, bucket, n):
    monkeypatch.setattr(shards, "BUCKET_ROWS", bucket)
    rows = awkward()
    out = shards.shard_digest(documents(spark, rows), shards=n)
    got = [tuple(r) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_shards(rows, n, 12)))
    per = Counter(r[4] for r in got)
    assert max(per.values()) - min(per.values()) <= 1
    assert all(sorted(r[5] for r in got if r[4] == s) == list(range(per[s])) for s in per)


def test_every_shard_matches_the_mixture(spark):
    rows = [(i, f"t{i}", "en", "a" if i % 3 else "b" if i % 2 else f"c{i % 5}") for i in range(3000)]
    out = shards.shard_documents(documents(spark, rows))
    per = {(r["shard"], r["source"]): r["n"] for r in out.groupBy("shard", "source").agg(F.count("*").alias("n")).collect()}
    whole = Counter(r[3] for r in rows)
    assert all(abs(per.get((s, k), 0) - n / 8) <= 2 for k, n in whole.items() for s in range(8))


def test_shards_keep_columns_and_files(spark, tmp_path):
    docs = documents(spark, awkward(40))
    out = shards.shard_documents(docs, 3)
    assert sorted(out.columns) == sorted(docs.columns) and out.filter("`a.b` = 8 and _source = 2").count() == docs.count()
    digest = shards.shard_digest(docs, 3)
    key = lambda df: sorted(map(str, df.select("doc_id", "shard", "slot").collect()))
    assert key(out) == key(digest)
    shards.write_shards(docs, f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert key(back.withColumn("shard", F.col("shard").cast("int"))) == key(digest)
    assert shards.shard_digest(docs.limit(0)).count() == 0 == shards.shard_documents(docs.limit(0)).count()


def brute_phrases(rows, least, longest, top, percent):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang, _ in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        keep = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        drop = {p[i:j] for p, a in keep.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= percent * keep[p[i:j]]}
        scored = []
        for p, a in keep.items():
            if p not in drop:
                s, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return out


def talk(seed=4, n=160):
    rng = random.Random(seed)
    words = ["a", "b", "c", "New", "york", "été", "x\x1cy", "日本", "d'e", " q", "É", "İ"]
    said = lambda k: rng.choice(["", " ", "\t"]).join("".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ", "\r\n"])) for _ in range(k))
    rows = [(i, said(rng.randint(0, 40)), rng.choice(["en", "de", None, "und"]), None) for i in range(n)]
    rows += [(1, None, "en", None), (2, "", "fr", None), (3, "...", "it", None), (4, "one", "it", None), (5, said(3000), "en", None), (6, "new york city hall now " * 30, "en", None)]
    return rows + [(7, "same words here again", "de", None)] * 25


@pytest.mark.parametrize("least,longest,shards_,slots,chunk", [(5, 5, 4, None, 200), (3, 4, 3, 16, 50), (8, 5, 1, 64, None)])
def test_phrases(spark, monkeypatch, least, longest, shards_, slots, chunk):
    """Tables of steps so small that most phrases share slots, and chunks of a text or two."""
    if slots:
        monkeypatch.setattr(phrases, "LEAST_SLOTS", slots)
        monkeypatch.setattr(phrases, "MOST_SLOTS", slots)
    if chunk:
        monkeypatch.setattr(phrases, "CHUNK", chunk)
        monkeypatch.setattr(phrases, "OPEN", 3 * chunk)
    rows = talk()
    out = phrases.collocations(documents(spark, rows), least, longest, 40, 100, shards_)
    assert sorted(map(tuple, out.collect())) == sorted(brute_phrases(rows, least, longest, 40, 100))


def test_phrases_drop_by_share_and_empty_tables(spark):
    rows = talk(9)
    docs = documents(spark, rows)
    assert sorted(map(tuple, phrases.collocations(docs, 4, 4, 500, 60).collect())) == sorted(brute_phrases(rows, 4, 4, 500, 60))
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("doc_id in (1, 2, 3, 4)")).count() == 0


def test_phrase_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000_000
    rows = [("en", 1, "a", big), ("en", 1, "b", big - 7), ("en", 2, "a b", big - 9)]
    got = phrases.weakest_cuts(spark.createDataFrame(rows, "lang string, words int, phrase string, a long"), spark.createDataFrame([("en", 9 * big)], "lang string, n long")).collect()
    assert [r["score"] for r in got] == [1000 * (big - 9) * 9 * big // (big * (big - 7))]


@pytest.mark.parametrize("n,size", [(300, 2), (65_535, 2), (65_536, 4)])
def test_numbers_of_a_chunk_take_two_bytes_where_they_are_enough(n, size):
    chunk = phrases._Chunk()
    said = [f"w{i}" for i in range(n)]
    chunk.add(memoryview((" ".join(said) + ". w7 w8").encode()))
    _, _, total, words, ids = chunk.row("en", 0)
    numbers = np.frombuffer(ids, phrases._number(n))
    assert numbers.itemsize == size and len(ids) == size * len(numbers) and total == n + 2
    assert [words[i - 1].decode() for i in numbers.tolist() if i] == [*said, "w7", "w8"]


def test_a_steps_shuffle_files_go_and_phrases_lie_in_order(spark, tmp_path):
    """While steps run, files of the steps before are deleted; keys of a chunk that begin alike lie together."""
    words, ids = pa.array(["a", "b", "c"]), np.array([2, 1, 0, 1, 2, 0, 1, 3, 0], np.int32)
    got = pa.Table.from_batches(list(phrases._keys(words, ids, "en", 2, np.array([0, 6, 3]), np.array([1, 1, 0]), np.array([5, 6, 7])))).to_pydict()
    assert got == {"key": ["!en\ta b", '"en\ta c', '"en\tb a'], "a": [7, 6, 5]}
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: sum(f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()))
    docs = documents(spark, talk(2)).repartition(3)
    chunks = common.materialise(phrases.cut_in_chunks(docs, 2), "test-chunks")
    before, setting = held(), spark.conf.get(phrases.CLEANUP, None)
    phrases.frequent(chunks, 5, 4, 2)
    assert held() <= before and spark.conf.get(phrases.CLEANUP, None) == setting
