"""Held-out accuracy, exact comparisons and awkward inputs of the training-data operators."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cuelattice.llm import fingerprints, language, layouts, mixing, neighbours, page_text, passages, pieces, quality, queries, simhash, token_files, units

DATA = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


def brute_spans(texts, length):
    """Removed bytes and maximal runs of each text by definition."""
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=False) if not g)).hexdigest()))
    return out


def test_passages_count_what_they_remove(spark):
    rng = np.random.default_rng(5)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    a, b = word(400), word(230)
    texts = [a + word(50) + b, word(30) + b + word(20) + a[100:350] + word(9), "x" * 450, "", None, a, word(500), b[:199], "é" * 150]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in passages.digest_repeats(docs).collect()}
    assert got == dict(enumerate(brute_spans([(t or "").encode() for t in texts], 200)))


def test_longest_factors_by_definition():
    rng = np.random.default_rng(2)
    base = rng.integers(97, 99, 500).astype(np.uint8)
    data = np.concatenate([base, base[50:400], rng.integers(97, 99, 300).astype(np.uint8)])
    at = np.arange(len(data) - 200)
    when = rng.permutation(len(at))
    raw = bytes(data)

    def common(i, j):
        n = 0
        while n < 200 and raw[i + n] == raw[j + n]:
            n += 1
        return n

    got = passages.longest_factors(data, at, when)
    for i in rng.choice(len(at), 60, replace=False):
        assert got[i] == max((common(at[i], at[j]) for j in range(len(at)) if when[j] < when[i]), default=0)
    both = passages.longest_factors(data, at, when, both=True)
    for i in rng.choice(len(at), 60, replace=False):
        assert (both[i] >= 200) == (max(common(at[i], at[j]) for j in range(len(at)) if j != i) >= 200)


def test_nearest_smaller():
    for x in (np.arange(9), np.arange(9)[::-1], np.random.default_rng(1).permutation(200)):
        want = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(len(x))]
        assert passages.nearest_smaller(x).tolist() == want


def runs_of_words(text):
    out = Counter()
    for p in text.split("\n"):
        w = p.split()
        if w:
            out.update(" ".join(w[i : i + 8]) for i in range(max(1, len(w) - 7)))
    return out


def test_likeness_is_near_the_exact_share(spark):
    texts = [r["text"] for r in table(spark, "documents").filter("length(text) > 1500").limit(40).collect()]
    errors = []
    for x in texts:
        y = "put before " + x[: len(x) * 2 // 3]
        a, b = runs_of_words(x), runs_of_words(y)
        exact = 1 - sum((a[k] - b[k]) ** 2 for k in a.keys() | b.keys()) / (sum(v * v for v in a.values()) + sum(v * v for v in b.values()))
        e, l = fingerprints.fingerprint_arrays([x, y])
        errors.append(fingerprints.likeness(e[:1], l[:1], e[1:], l[1:])[0] - exact)
    assert np.sqrt(np.mean(np.square(errors))) < 0.1
    line = "these are eight words on every single line"
    e, l = fingerprints.fingerprint_arrays(["\n".join([line] * 70_000), "\n".join([line] * 69_000)])
    assert fingerprints.likeness(e[:1], l[:1], e[1:], l[1:])[0] > 0.99


def test_language_held_out(spark):
    docs = table(spark, "documents")
    out = queries.op4_language(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    right, n = out.select(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 20 and right / n > 0.97
    word = lambda k: chr(97 + k % 20) * 2 + chr(97 + k // 20) * 3
    many = spark.createDataFrame([(i, f"{word(i % 300)} " * 5, f"l{i % 300}") for i in range(1200)], "doc_id long, text string, lang string")
    model = language.train(many)
    assert len(model.langs) > 250  # no cap on languages
    names, score = language.classify([f"{word(7)} {word(7)}", "", "12", None], model)
    assert model.word_scores(["zzz", "qqq"]).shape == (2, len(model.langs)) and model.word_scores([]).shape == (0, len(model.langs))
    assert names[0] == "l7" and names[1:] == ["und"] * 3 and score[1:].tolist() == [0, 0, 0]


def test_quality_held_out(spark):
    larger = DATA.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", "quality")
    out = queries.op10_quality(spark, larger).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = out[out["quality"] == 1]["score"].to_numpy(), out[out["quality"] == 0]["score"].to_numpy()
    auc = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert len(good) > 5 and len(bad) > 5 and auc > 0.9


def test_page_text_on_layouts_never_seen(spark):
    texts = page_text.sample_texts(table(spark, "pages"))
    model = page_text.fit(texts)
    right = n = 0
    for found, marked in page_text.labelled(texts, pages=150, seed=11):
        states = model.decode(page_text.block_features(found))
        right, n = right + sum(a == b for a, b in zip(states, marked, strict=True)), n + len(marked)
    assert right / n > 0.95
    long = "This sentence stands in the article and has quite a few words. " * 4
    pages = {
        f"<body><nav><a href=a>Home</a></nav><article><h1>Areas</h1><p>The area is <math>a*b</math> square metres, as was said.</p></article><footer>&copy; me</footer></body>": "Areas\nThe area is a*b square metres, as was said.",
        f"<body><article><h1>Areas</h1><p>{long}</p><p>{long}</p><div id='disqus_thread'><p>I liked it, thanks.</p></div></article></body>": f"Areas\n{long.strip()}\n{long.strip()}",
        f"<body><div><a href=1>Home</a> <a href=2>News</a></div><div>{long}</div><div>{long}</div><div>&copy; 2020</div></body>": f"{long.strip()}\n{long.strip()}",
    }
    for page, want in pages.items():
        assert page_text.main_text(page, model) == want
    out = {r["page_id"]: r["text"] for r in queries.op8_page_text(spark, DATA).collect()}
    for r in table(spark, "pages").collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer|$)", r["html"] or "", re.S)
        assert out[r["page_id"]] == "\n".join(b.text for b in page_text.blocks(inside[1] if inside else ""))


def test_layouts_are_labelled():
    assert sum(len(labels) for _, labels in layouts.labelled_pages([], pages=30)) > 100


def test_neighbours_of_small_far_groups(spark):
    """Groups of three, far apart, among many: every query gets ten, nearly all of them right."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 16))
    for g in range(20):
        x[g * 75 : g * 75 + 3] = rng.normal(size=16) * 200 + rng.normal(size=(3, 16)) * 0.01
    x[300] = x[301]
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9000, [0.0] * 16), (9100, None), (9200, [float("nan")] + [1.0] * 15), (9300, [1.0] * 4)], "vec_id long, embedding array<double>")
    out = neighbours.search(t, every=25).toPandas()
    assert out.groupby("query_id").size().eq(10).all() and out["query_id"].nunique() == 60
    hits = 0
    for q, part in out.groupby("query_id"):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len(set(np.lexsort((np.arange(len(x)), d))[:10]) & set(part["vec_id"]))
        assert np.allclose(part.sort_values("rank")["score"], d[part.sort_values("rank")["vec_id"]])
    assert hits / 600 >= 0.9


def test_gray_index_of_many_groups():
    rng = np.random.default_rng(0)
    f = rng.integers(0, 2**63, 60).astype(np.uint64)
    f = np.concatenate([f, *[f ^ (np.uint64(1) << rng.integers(0, 63, 60).astype(np.uint64)) for _ in range(4)]])
    g = np.unique(np.sort(rng.integers(0, 30, len(f))), return_inverse=True)[1]
    near = (np.bitwise_count(f[:, None] ^ f[None]) <= 4) & (g[:, None] == g[None])
    want = np.arange(len(f))
    while not ((new := np.where(near, want[None], len(f)).min(1)) == want).all():
        want = new
    assert (simhash.forest(f, g) == want).all()


def test_token_ids_equal_the_library_on_awkward_texts():
    from tokenizers import Tokenizer

    enc, tok = token_files.CachedEncoder(queries.word_bpe_path()), Tokenizer.from_file(queries.word_bpe_path())
    texts = ["", " ", "A.b,c'S don't", "<|ENDOFTEXT|> <|endoftext|>", "été.́x", " x y", "İstanbul, ΑΣ.", "a\x1cb\x85c", "日本.語,1.5a", "x" * 3000 + ".", "\t\n .,.,a"]
    for t in texts + texts[::-1]:
        assert np.frombuffer(enc.encode([t], None)[0], enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_unit_table_forgets_and_stays_right(monkeypatch):
    t = units.UnitTable(lambda u: (np.array([len(x) for x in u]), np.frombuffer(b"".join(u), np.uint8)), 20, np.uint8)
    apart = np.zeros((256, 256), bool)
    apart[:, 32] = True
    rng = np.random.default_rng(3)
    for _ in range(40):
        texts = [" ".join("abcdefgh"[: rng.integers(1, 8)] * rng.integers(1, 9) for _ in range(5)).encode() for _ in range(4)] + [b""]
        for lo, hi, data, ends in units.blocks(texts, b""):
            ids, upto = t.encode(data, *units.cut(data, ends, apart.ravel()))
            assert [ids[s:e].tobytes() for s, e in zip([0, *upto[:-1]], upto, strict=True)] == texts[lo:hi]


def test_pieces_digest(spark):
    docs = spark.createDataFrame([(1, "Hello  world,\n\nün ▁ x"), (None, None), (3, ""), (3, ""), (4, "日本")], "doc_id long, text string")
    out = pieces.digest_round_trip(docs, queries.piece_model_path()).collect()
    assert len(out) == 5 and {r["n_tokens"] for r in out if not r["n_chars"]} == {0}
    assert all(r["round_trip"] for r in out if r["doc_id"] in (3, 4, None))


CLASHES = ("target", "source_size", "n_docs", "epochs", "_cut", "_size", "_key", "_id", "copies", "_copy", "_kept", "_row", "_doc", "component", "score", "lang_pred", "rid", "cuts", "fp", "a.b")


@pytest.mark.parametrize("stage", [mixing.mix_documents, simhash.keep_one, language.keep_identified, passages.remove_repeats])
def test_stages_keep_clashing_columns(spark, stage):
    base = table(spark, "documents").limit(40)
    docs = base.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    out = stage(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in CLASHES)
    assert stage(docs.limit(0)).count() == 0


def test_mix_by_a_weight_column(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "s" if i < 200 else "t", 10.0 if i % 2 else 0.1) for i in range(600)], "doc_id long, text string, source string, w double")
    taken = Counter(r["doc_id"] % 2 for r in mixing.mix_documents(docs, weights=(1.0, 9.0), quality="w").filter("source = 's'").collect())
    assert taken[1] > 3 * taken[0]


def test_pipeline_runs_whole(spark):
    docs = table(spark, "documents")
    out = corpus_pipeline.run(spark, DATA)
    rows = out.collect()
    kept = docs.filter("lang is not null and length(text) > 0").count()
    assert out.columns == ["doc_id", "n_tokens", "ids"] and 0.3 * kept < len({r["doc_id"] for r in rows}) <= kept
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
    odd = docs.limit(3).unionByName(docs.limit(3)).unionByName(docs.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes]))
    for start in (odd, docs.limit(0)):
        step = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            step = stage(spark, step, DATA)
            assert step.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, step, DATA).count() >= 0
