"""Each training-data operator against brute force on small, awkward tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row

from cuelattice.llm import copies, fingerprints, language, mixing, neighbours, page_text, passages, pieces, quality, queries, simhash, token_files
from cuelattice.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, _bucket int, key int"


def sample():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, base = prose(60), prose(200)
    texts = [None, "", "   ", "one", "a\nb\n\nb", prose(50), base, base, base + " x", base.replace("a", "A", 1), prose(30) + shared + prose(30), prose(10) + shared, "ab" * 400, "zz " * 300, prose(5000)]
    rows = [(i * 3, t, None if i % 4 == 3 else "ab"[i % 2], None if i == 5 else f"s{i % 3}", 0, "x", 1, 2) for i, t in enumerate(texts)]
    return rows + [(9, "one", None, "s0", 0, None, 1, 1), (None, base, "a", "s1", 0, None, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_mix(docs, empty):
    rows = mixing.mix_sizes(docs).collect()
    assert len(rows) == len(sample())
    total = sum(r["size"] for r in rows)
    target = {r["source"]: r["target"] for r in rows}
    assert abs(sum(target.values()) - total) < 1e-6
    for s, t in target.items():
        own = [r for r in rows if r["source"] == s]
        assert t <= 3 * sum(r["size"] for r in own) + 1e-6
        assert abs(sum(r["taken"] for r in own) - t) <= max(r["size"] for r in own)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sizes(docs).collect()))
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in rows)
    assert mixing.mix_sizes(empty).count() == 0 == mixing.mix_documents(empty).count()


def brute_repeats(texts, keep):
    seen, out = {}, []
    for k, b in enumerate(texts):
        for i in range(len(b) - 199):
            seen.setdefault(b[i : i + 200], []).append((k, i))
    for k, b in enumerate(texts):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            at = seen[b[i : i + 200]]
            if len(at) > 1 and (keep == "none" or at[0] != (k, i)):
                gone[i : i + 200] = b"\1" * 200
        out.append(bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("hot", [3, 3000])
def test_passages(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    texts = [(r[1] or "").encode() for r in sample()]
    want = sorted((str(r[0]), len(t), hashlib.sha256(k).hexdigest()) for r, t, k in zip(sample(), texts, brute_repeats(texts, "none"), strict=True))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["kept_sha256"]) for r in passages.digest_repeats(docs).collect()) == want
    assert passages.digest_repeats(empty).count() == 0


def test_passages_keep_first(docs, empty):
    out = passages.remove_repeats(docs)
    assert out.columns == docs.columns
    left = Counter()
    for r in out.collect():
        b = (r["text"] or "").encode()
        left.update(b[i : i + 200] for i in range(len(b) - 199))
    whole = [(r[1] or "").encode() for r in sample()]
    alone = {b[i : i + 200] for b in whole for i in range(len(b) - 199)}
    assert len(left) and max(left.values()) == 1 and len(left) <= len(alone)
    assert passages.remove_repeats(empty).count() == 0


def test_fingerprints(docs, empty):
    rows = sorted(((r[0], r[1] or "") for r in sample()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    got = {(r["doc_id"], r["edited_sha256"]): r for r in fingerprints.fingerprint_edits(docs).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        e = fingerprints.edited(t, n)
        r = got[i, hashlib.sha256(e.encode()).hexdigest()]
        assert r["n_chars"] == len(t) and (r["near_edited"] == 1.0) == (e == t) and 0 <= r["near_next"] <= 1
    assert fingerprints.fingerprint_edits(empty).count() == 0
    fp = lambda t: fingerprints.to_hex(*fingerprints.fingerprint_arrays([t]))[0]
    assert fp("a b\nc d") == fp("c d\na b") == fingerprints.combine(fp("a b"), fp("c d")) and fingerprints.combine(fp("a b\nc d"), fp("c d"), -1) == fp("a b")


def test_likeness_of_a_shifted_copy():
    rng = random.Random(7)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    e, l = fingerprints.fingerprint_arrays([text, "new " + text, text.replace(" ", " new ", 1)])
    assert (fingerprints.likeness(e[:1], l[:1], e[1:], l[1:]) > 0.9).all()


def test_language(spark, docs, empty):
    out = {r["doc_id"]: r for r in language.predict(docs).collect()}
    assert out[0]["lang_pred"] == out[3]["lang_pred"] == out[6]["lang_pred"] == "und" and all(0 <= r["score"] <= 1 for r in out.values())
    assert out[9]["held_out"] == (zlib.crc32(b"9") % 4 == 2)
    assert language.predict(empty).count() == 0 and language.keep_identified(docs).columns == docs.columns
    data = spark.createDataFrame([(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, lang string")
    new = language.identify(spark.createDataFrame([(1, "die katze und catze"), (2, "thee dogs and")], "doc_id long, text string"), language.train(data)).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in new] == ["de", "en"]


def test_pieces_equal_the_library(docs, empty):
    import sentencepiece

    path = queries.piece_model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    toks = pieces.encode_documents(docs, path)
    got = sorted((str(r["doc_id"]), r["ids"]) for r in toks.collect())
    assert got == sorted((str(r[0]), sp.encode(r[1] or "")) for r in sample())
    assert sorted(str(r["text"]) for r in pieces.decode_documents(toks, path).collect()) == sorted(r[1] or "" for r in sample())
    assert pieces.encode_documents(empty, path).count() == 0


def test_unigram_viterbi_equals_the_library():
    import struct

    import sentencepiece

    num = lambda v: bytes([v]) if v < 128 else bytes([v & 127 | 128]) + num(v >> 7)
    msg = lambda k, b: num(k << 3 | 2) + num(len(b)) + b
    rng = random.Random(2)
    words = {"▁", "a", "b", "c", "▁a", "▁b"} | {"▁" * rng.randint(0, 1) + "".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(60)}
    plist = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(w, -rng.uniform(1, 9), 1) for w in sorted(words)]
    proto = b"".join(msg(1, msg(1, t.encode()) + b"\x15" + struct.pack("<f", s) + num(3 << 3) + num(k)) for t, s, k in plist)
    proto += msg(2, num(3 << 3) + num(1)) + msg(3, msg(1, b"identity") + num(3 << 3) + num(1) + num(4 << 3) + num(0) + num(5 << 3) + num(1))
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    texts = ["".join(rng.choice("abc  d") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    m = pieces.Pieces(model_proto=proto)
    assert not m.merges
    assert [x.tolist() for x in m.encode(texts)] == [sp.encode(t) for t in texts]


def test_token_files(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.word_bpe_path())
    rows = sorted(((r[0], r[1] or "") for r in sample()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    got = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in token_files.read_tokens(token_files.write_tokens(docs, queries.word_bpe_path())).collect()}
    start, want = 0, {}
    for i, t in rows:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        want[i, start] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    assert token_files.read_tokens(token_files.write_tokens(empty, queries.word_bpe_path())).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).round(3)
    x[50:90] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1100, [0.0] * 8), (1200, [float("nan")] * 8), (1300, [None] * 8)]
    out = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    hits = 0
    for q in range(0, 600, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(600), d))[:10].tolist()
        got = [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])]
        hits += len(set(want) & set(got))
        assert len(got) == 10 and q not in got
    assert hits >= 0.9 * 60 and {r["query_id"] for r in out} == set(range(0, 600, 100))
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_neighbours_fill_up(spark, monkeypatch):
    """Queries alone in their list, on a centroid; probed as usual, and one list only."""
    monkeypatch.setattr(neighbours, "LIST", 8)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)) * 0.01 + rng.integers(0, 5, (400, 1)) * 10
    x[::20] = rng.normal(size=(20, 8)) * 1000
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for choose in (neighbours.probes_for, lambda graph, v: list(graph.search(v)[0][:, :1])):
        monkeypatch.setattr(neighbours, "probes_for", choose)
        out = neighbours.search(table, every=20).collect()
        assert sorted((r["query_id"], r["rank"]) for r in out) == [(q, k) for q in range(0, 400, 20) for k in range(1, 11)]


def test_page_text(spark):
    pages = [
        (1, "u", "<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy now.</div><article><h1>Title</h1><p>First &amp; main text,\n with <b>bold</b> words.</p><p>Second.</p></article><footer>&copy; x</footer></body></html>"),
        (2, None, None), (3, "u", ""), (4, "u", "<script>var a = '<p>no</p>'</script><!-- <p>no</p> -->"), (1, "u", "<p"),
    ]
    rows = page_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    got = [r["text"] for r in rows if r["page_id"] == 1 and r["text"]]
    assert got == ["Title\nFirst & main text, with bold words.\nSecond."] and len(rows) == 5 and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert page_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_simhash(docs, empty, monkeypatch):
    monkeypatch.setattr(simhash, "LIMIT", 4)
    rows = sample()
    fps = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        import xxhash

        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)))
    root = list(range(len(rows)))
    for _ in rows:
        for a, b in itertools.combinations(range(len(rows)), 2):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[a] = root[b] = min(root[a], root[b])
    low = {k: min((r[0] for r, x in zip(rows, root, strict=True) if x == k and r[0] is not None), default=None) for k in set(root)}
    want = sorted((str(r[0]), f, low[x]) for r, f, x in zip(rows, fps, root, strict=True))
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, r["component_id"]) for r in simhash.components(docs).collect()) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(low.values())
    assert simhash.components(empty).count() == 0


def test_keep_one_of_null_and_repeated_ids(spark):
    rng = random.Random(8)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (4, c), (4, d), (4, e), (2, e), (2, a.upper() + " x")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(str(Row(doc_id=i, text=t)) for i, t in [(2, a.upper() + " x"), (None, b), (4, c), (4, d), (2, e)])


def test_keep_one_takes_candidates_from_the_index(spark, monkeypatch):
    """Without pairs of the prefix filter, what the index links and the exact check affirms is one."""
    said = " ".join(f"w{i}" for i in range(400))
    rows = [(2, said), (1, said + " more"), (3, "quite another text " * 9), (4, None), (5, "")]
    seen, links = [], copies._links

    def kept_of_index(pairs, sets, rows, overlap=None):
        seen.append(overlap)
        return links(pairs if overlap is None else pairs.limit(0), sets, rows, overlap)

    monkeypatch.setattr(copies, "_links", kept_of_index)
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4] and seen[0] is None


def test_near_copies_are_listed_once_and_only_if_they_may_be_alike(spark, monkeypatch):
    """120 edits of one text, too far from one another: next to no pair is listed. Closer
    ones are still found, each pair about once, though they share many hashes."""
    rng, rows, found, open_pairs = random.Random(3), [], [], copies.open_pairs
    word = lambda: f"w{rng.randrange(10**6)}"
    for k, edits in ((0, 16), (1, 7)):
        base = [word() for _ in range(400)]
        for i in range(120):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(400)] = word()
            rows.append((1000 * k + i, " ".join(text)))

    def listed(open_):
        found.append(open_pairs(open_).collect())
        return open_pairs(open_)

    monkeypatch.setattr(copies, "LEADS", 1)
    monkeypatch.setattr(copies, "open_pairs", listed)
    got = copies.components(spark.createDataFrame(rows, "_row long, text string").repartition(3)).collect()
    sets = {i: set(copies.shingle_set(t.encode()).tolist()) for i, t in rows}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    of = {r["_row"]: r["component"] for r in got}
    assert len(set(zip(root.values(), (of[i] for i in root), strict=True))) == len(set(root.values())) == len(set(of.values()))
    pairs = Counter((r["nodex"], r["nodey"]) for r in found[0])
    assert sum(pairs.values()) <= 3 * len(pairs) and len(pairs) < 120 * 119 // 2


def test_large_groups_of_near_copies_are_not_paired_with_one_another(spark, monkeypatch):
    """300 edits of one text, many pairs of them alike: leaders that change connect them, so
    that few pairs are left to list, and the same ones are together."""
    rng, rows, tried, links = random.Random(5), [], [], copies._links
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(400)]
    for i in range(300):
        text = list(base)
        for _ in range(rng.choice([4, 5, 5, 6])):
            text[rng.randrange(400)] = word()
        rows.append((i, " ".join(text)))

    def counted(pairs, sets, rows, overlap=None):
        pairs = copies.materialise(pairs, "test-pairs")
        tried.append(pairs.count())
        return links(pairs, sets, rows, overlap)

    monkeypatch.setattr(copies, "close_pairs", lambda rows, sets: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(copies, "_links", counted)
    of = {r["_row"]: r["component"] for r in copies.components(spark.createDataFrame(rows, "_row long, text string").repartition(3)).collect()}
    sets = {i: set(copies.shingle_set(t.encode()).tolist()) for i, t in rows}
    alike = [(a, b) for a, b in itertools.combinations(sets, 2) if copies.alike(len(sets[a] & sets[b]), len(sets[a]), len(sets[b]))]
    root = {i: i for i in sets}
    for a, b in alike:
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()} if low < high else root
    assert len(set(zip(root.values(), (of[i] for i in root), strict=True))) == len(set(root.values())) == len(set(of.values()))
    assert len(alike) > 5_000 and tried[-1] < 4 * copies.LEADS * len(rows), (len(alike), tried)


@pytest.mark.parametrize("n", [0, 1, 500, 513, 3000])
def test_sketches_never_pass_the_difference(n):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, 2**62, n))
    y = np.unique(np.r_[x[: n // 2], rng.integers(0, 2**62, n // 3)])
    a, b = copies.sketch(x), copies.sketch(y)
    for k in {copies.SKETCH, min(len(a), len(b))}:
        apart = np.bitwise_count((copies.folded(a, k) ^ copies.folded(b, k)).view(np.uint64)).sum()
        assert apart <= len(np.setxor1d(x, y)) and len(copies.folded(a, k)) == k


def test_keep_one_reaches_similarity(spark):
    """Copies planted at five-word Jaccard 0.75 to 0.99, against all pairs."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    tail, texts = [word() for _ in range(40)], []
    for k in range(60):
        base = [word() for _ in range(rng.randint(6, 300))] + (tail if k % 3 == 0 else [])
        texts.append(base)
        for edits in range(rng.randint(1, 4)):  # each of the next is an edit of the one before
            base = list(base)
            for _ in range(max(1, len(base) * edits // 100)):
                base[rng.randrange(len(base))] = word()
            texts.append(base)
        texts.append(base + [word() for _ in range(len(base) // 5)])
    sets = [{" ".join(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root, near = list(range(len(texts))), 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            near += 1
            root = [root[a] if r == root[b] else r for r in root]
    low = {r: min(i for i, x in enumerate(root) if x == r) for r in set(root)}
    assert near > 60 and len(low) > 60
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(low.values())


def test_gray_index():
    rng = np.random.default_rng(4)
    f = rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)
    f = np.unique(np.concatenate([f, *[f ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(6)]]))
    q, x = simhash.GrayIndex(f).links(f, 4)
    assert set(zip(q.tolist(), x.tolist(), strict=True)) == {(i, j) for i in range(len(f)) for j in range(len(f)) if int(f[i] ^ f[j]).bit_count() <= 4}


def test_components(spark):
    e = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 100), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(e, "a long, b long")).distinct().collect())
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 200: 100}


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([Row(doc_id=r[0], quality=int(len(r[1] or "") > 100), toxic=0) for r in sample() if r[0] is not None] + [Row(doc_id=77, quality=1, toxic=0)])
    out = quality.score(docs, labels).collect()
    assert len(out) == len(sample()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert {r["score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5} and quality.score(empty, labels).count() == 0
