"""Near copies: texts whose sets of five-word shingles are alike to 0.8 or more.

Candidates come from the SimHash index first. A 64-bit SimHash puts many such texts so far
apart (see the README) that no radius of an index reaches them all; those beyond it are
found by an exact prefix filter:

1. A text is its set of distinct shingle hashes; equal sets are one node. All sets
   are put in one order, hashes frequent in a sample last. Sets alike to 0.8 or more
   share a hash among the first fifth of each; only these prefixes go on.
2. Sets that the SimHash index links, directly or not, are paired with the first of their
   group. Then a set is paired with up to four others, those that lead (are first by four
   orders in) most of its hashes, if they lead a quarter of them; this connects groups of
   copies by a few pairs for each. Hashes that still join many components go through turns
   with other orders, so other leaders, as long as these connect much. At last, in hashes that
   join different components, pairs of different components that may be alike. What is left
   out is connected already, so components are those of all pairs.
3. Every set has a sketch: the parities of how many of its hashes fall to each of its bits,
   about as many as hashes, which fold to 512. Two sets differ in at least as many hashes as
   their sketches in bits, so a pair whose sketches differ too much for 0.8 goes. A pair is
   listed for the first hash that both share: not for one that stands too late in either
   order to be the first of 0.8, nor where one of the few before it is shared too. What is
   left is decided by the exact Jaccard similarity of both texts.

Nothing is lost but by collisions of 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .common import by_bytes, give_back, let_go, materialise, narrowed, release, text_views
from .components import connected_components

#: Similarity PART / OF; alike if overlap * (PART + OF) >= PART * (size + size).
WORDS, PART, OF = 5, 4, 5
#: The order of hashes is fitted on about SAMPLE texts; any order gives the same result.
SAMPLE, FREQUENT, HOT = 5_000, 3, 200_000
#: Which pairs are tried first; the others are tried after, so the result doesn't depend on it.
#: The first of a hash by each order is its smallest node once the bits of ORDERS are flipped.
LEADS, ORDERS = 4, (0, -1, 1 << 62, ~(1 << 62))
#: A hash of more components goes through turns; such a group then makes about so many pairs a set.
CROWD = 16
#: Numbers of 64 bits in a folded sketch, and in the widest. A hash comes with the BEFORE ahead of it.
SKETCH, WIDEST, BEFORE = 8, 1024, 4
SKETCHES = [f"sketch{k}" for k in range(SKETCH)]


def shingle_set(text: bytes) -> np.ndarray:
    """Distinct 63-bit hashes of the runs of WORDS words, ascending."""
    return np.unique(np.array(simhash.shingle_hashes(text, WORDS), np.uint64) >> np.uint64(1)).view(np.int64)


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of how many hashes of a set fall to each bit, as SKETCH numbers or, for
    large sets, the power of two that has a bit for each hash."""
    bits = 64 * min(max(SKETCH, 1 << (-(-len(s) // 64) - 1).bit_length() if len(s) else 0), WIDEST)
    return np.packbits((np.bincount(s & (bits - 1), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def folded(bits: np.ndarray, n: int) -> np.ndarray:
    """The sketch of n numbers that the same set has."""
    while len(bits) > n:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def alike(overlap: int, a: int, b: int) -> bool:
    return overlap * (PART + OF) >= PART * (a + b)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        views = text_views(batch)
        for lo, hi in by_bytes(views, 4_000_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingle_set(bytes(v or b"")) for v in views[lo:hi]]))], names=["token"])


def _prefixes(hot):
    """Rows (_row, text) -> _row, node (hash of the set), size, prefix, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        last = hot.value
        for batch in batches:
            views, nodes, sizes, prefixes, wide = text_views(batch), [], [], [], []
            for v in views:
                s = shingle_set(bytes(v or b""))
                n = len(s)
                nodes.append(xxhash.xxh64_intdigest(s.tobytes()))
                sizes.append(n)
                wide.append(sketch(s))
                if len(last):
                    rare = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] != s
                    s = np.r_[s[rare] + np.int64(-(2**63)), s[~rare]]
                prefixes.append(s[: n - -(-n * PART // OF) + 1] if n else s)
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes])))
            bits = np.array([folded(x, SKETCH) for x in wide], np.int64).reshape(-1, SKETCH).T
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), lists, *map(pa.array, bits), pa.array([x.tobytes() for x in wide], pa.binary())], names=["_row", "node", "size", "prefix", *SKETCHES, "wide"])

    return run


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, sizes, widea, wideb) -> those whose sketches, folded alike, allow 0.8."""
    for batch in batches:
        keep = []
        for sizes, x, y in zip(*(batch.column(k).to_pylist() for k in ("sizes", "widea", "wideb")), strict=True):
            n = min(len(x), len(y)) // 8
            apart = np.bitwise_count(folded(np.frombuffer(x, np.uint64), n) ^ folded(np.frombuffer(y, np.uint64), n)).sum()
            keep.append(int(apart) * (OF + PART) <= sizes * (OF - PART))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b) -> those alike."""
    let_go()
    held, own = None, None
    for batch in batches:
        keep = []
        for a, x, y in zip(batch.column(0).to_pylist(), text_views(batch, "text_a"), text_views(batch, "text_b"), strict=True):
            if a != held:
                held, own = a, shingle_set(bytes(x or b""))
            other = shingle_set(bytes(y or b""))
            keep.append(alike(len(np.intersect1d(own, other, assume_unique=True)), len(own), len(other)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    give_back()


def may_be_alike(x: str, y: str) -> Column:
    """Whether the sizes and sketches of two sets allow 0.8; their columns end in x and y."""
    sizes = F.col("size" + x) + F.col("size" + y)
    apart = sum((F.bit_count(F.col(c + x).bitwiseXOR(F.col(c + y))) for c in SKETCHES), F.lit(0))
    near = F.least("size" + x, "size" + y) * OF >= F.greatest("size" + x, "size" + y) * PART
    return near & (apart * (OF + PART) <= sizes * (OF - PART))


def _links(pairs: DataFrame, sets: DataFrame, rows: DataFrame, overlap: bool | None = None) -> DataFrame:
    """Those of the candidates (a, b) that are alike; sizes and sketches are asked before texts
    are read; if overlap is set, they have been, and whole sketches are. overlap False, with a
    column n: n is what a leads of b's prefix."""
    if overlap:
        for k in "ab":
            pairs = pairs.join(sets.select(F.col("node").alias(k), *[F.col(c).alias(c + k) for c in ("size", "wide")]), k)
        pairs = pairs.select("a", "b", (F.col("sizea") + F.col("sizeb")).alias("sizes"), "widea", "wideb").mapInArrow(_near, "a long, b long")
    for k in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(k), *[F.col(c).alias(c + k) for c in ("size", "first", *([] if overlap else SKETCHES))]), k)
    if not overlap:
        pairs = pairs.filter(may_be_alike("a", "b"))
    if overlap is False:
        pairs = pairs.filter(F.col("n") * LEADS >= F.col("sizeb") - F.ceil(F.col("sizeb") * PART / OF) + 1)
    pairs = materialise(pairs.select("a", "b", "firsta", "firstb"), "copies-pairs")
    asked = materialise(pairs.select(F.explode(F.array("firsta", "firstb")).alias("_row")).distinct(), "copies-asked")
    texts = materialise(narrowed(rows.select("_row", "text"), asked, "_row", "left_semi"), "copies-texts")
    found = pairs
    for k in "ba":  # text_a last: pairs of one a then lie together
        found = found.join(texts.select(F.col("_row").alias(f"first{k}"), F.col("text").alias(f"text_{k}")), f"first{k}")
    out = materialise(found.select("a", "b", "text_a", "text_b").mapInArrow(_decide, "a long, b long"), "copies-links")
    release(pairs, asked, texts)
    return out


def close_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets (node, first) -> pairs (a, b): each set whose text the SimHash index links to
    others, directly or not, with the set of the first text among them."""
    firsts = sets.select(F.col("first").alias("doc_id"))
    found = simhash.components(narrowed(rows.select(F.col("_row").alias("doc_id"), "text"), firsts, "doc_id", "left_semi"))
    found = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("of_b"), F.col("component_id").alias("of_a"))
    for k in "ab":
        found = found.join(sets.select(F.col("first").alias(f"of_{k}"), F.col("node").alias(k)), f"of_{k}")
    return found.select("a", "b")


def leaders(tokens: DataFrame) -> DataFrame:
    """(token, node, at, leads) -> a, b, n: for each node b and order the node a that leads most
    of its hashes, and how many. A hash of few sets has few leaders."""
    led = tokens.select("node", F.posexplode("leads").alias("by", "a")).filter("node <> a")
    most = led.groupBy("node", "by", "a").agg(F.count(F.lit(1)).alias("n")).groupBy("node", "by").agg(F.max(F.struct("n", "a")).alias("m"))
    return most.groupBy(F.col("m.a").alias("a"), F.col("node").alias("b")).agg(F.max("m.n").alias("n"))


def _rooted(sets: DataFrame, edges: DataFrame) -> DataFrame:
    out = sets.join(connected_components(edges), "node", "left").select("node", "size", F.coalesce("root", "node").alias("root"), *SKETCHES)
    return materialise(out, "copies-roots")


def _shared(tokens: DataFrame, rooted: DataFrame) -> DataFrame:
    """(token, node) -> token, roots: of those that join different components, how many."""
    held = tokens.select("token", "node").join(rooted.select("node", "root"), "node").select("token", "root").distinct()
    return held.groupBy("token").agg(F.count(F.lit(1)).alias("roots")).filter("roots > 1")


def other_leads(tokens: DataFrame, turn: int) -> DataFrame:
    """(token, node, root) -> token, node, leads: the token's first nodes by orders of this turn,
    the node itself in place of those of its own root."""
    masks = [F.lit(x).cast("long") for x in np.random.default_rng([simhash.SEED, turn]).integers(-(2**63), 2**63, len(ORDERS)).tolist()]
    firsts = [F.min(F.struct(F.col("node").bitwiseXOR(m).alias("far"), "root")) for m in masks]
    first = tokens.groupBy("token").agg(*[x.alias(f"f{k}") for k, x in enumerate(firsts)])
    leads = [F.when(F.col(f"f{k}.root") == F.col("root"), F.col("node")).otherwise(F.col(f"f{k}.far").bitwiseXOR(m)) for k, m in enumerate(masks)]
    return tokens.join(first, "token").select("token", "node", F.array(*leads).alias("leads"))


def gathered(tokens: DataFrame, crowd: DataFrame, rooted: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """`rooted` after turns over the tokens in crowd (token, roots): each set is paired with those
    of other roots that lead most of its tokens. A token takes part as long as it has more than
    CROWD roots and a turn takes a quarter of them; the others are left to `open_pairs`."""
    own = materialise(tokens.join(crowd.select("token"), "token").select("token", "node"), "copies-crowded")
    for turn in count():
        play = own.join(crowd.select("token"), "token").join(rooted.select("node", "root"), "node")
        more = _links(leaders(other_leads(play, turn)).select("a", "b"), sets, rows)
        new = _rooted(sets, more.unionByName(rooted.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))))
        left = _shared(own, new).join(crowd.select("token", F.col("roots").alias("was")), "token")
        left = materialise(left.filter((F.col("roots") > CROWD) & (F.col("roots") * 4 <= F.col("was") * 3)).select("token", "roots"), "copies-crowd")
        release(more, rooted, crowd)
        rooted, crowd = new, left
        if crowd.isEmpty():
            release(own, crowd)
            return rooted


def open_pairs(open_: DataFrame) -> DataFrame:
    """(token, node, at, size, root, sketch) -> nodex, nodey of sets of different roots that
    share a hash and may be alike. at: hashes before it in the set's order. The first
    that two alike sets share leaves both enough hashes from there on, and none before."""
    before = F.collect_list("token").over(Window.partitionBy("node").orderBy("at").rowsBetween(-BEFORE, -1))
    open_ = open_.withColumn("before", before)
    x, y = (open_.select("token", *[F.col(c).alias(c + k) for c in ("node", "at", "size", "root", "before", *SKETCHES)]) for k in "xy")
    rest = F.least(F.col("sizex") - F.col("atx"), F.col("sizey") - F.col("aty"))
    early = rest * (PART + OF) >= (F.col("sizex") + F.col("sizey")) * PART
    pairs = x.join(y, "token").filter((F.col("nodex") < F.col("nodey")) & (F.col("rootx") != F.col("rooty")))
    return pairs.filter(early & may_be_alike("x", "y") & ~F.arrays_overlap("beforex", "beforey")).select("nodex", "nodey")


def components(rows: DataFrame) -> DataFrame:
    """(_row, text), _row distinct -> _row, component: one number for all rows that
    steps between alike texts connect. Texts without words are alike."""
    spark = rows.sparkSession
    share = min(1.0, SAMPLE / max(1, rows.count()))
    often = rows.sample(share, seed=simhash.SEED).select("text").mapInArrow(_tokens, "token long").groupBy("token").count()
    often = often.filter(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "token").limit(HOT).select("token").toPandas()["token"]
    hot = spark.sparkContext.broadcast(np.sort(often.to_numpy(np.int64)))
    of = materialise(rows.select("_row", "text").mapInArrow(_prefixes(hot), "_row long, node long, size long, prefix array<long>, " + ", ".join(f"{c} long" for c in SKETCHES) + ", wide binary"), "copies-rows")
    sets = materialise(of.groupBy("node").agg(F.first("size").alias("size"), F.min("_row").alias("first"), *[F.first(c).alias(c) for c in (*SKETCHES, "wide")]), "copies-sets")
    nodes = materialise(of.select("_row", "node"), "copies-nodes")
    once = narrowed(of, sets.select(F.col("first").alias("_row")), "_row", "left_semi")
    by = Window.partitionBy("token")
    tokens = once.select("node", F.posexplode("prefix").alias("at", "token")).withColumn("k", F.count(F.lit(1)).over(by))
    firsts = [F.min(F.col("node").bitwiseXOR(F.lit(x).cast("long"))).over(by).bitwiseXOR(F.lit(x).cast("long")) for x in ORDERS]
    tokens = tokens.filter("k > 1").withColumn("leads", F.array_distinct(F.slice(F.array(*firsts), F.lit(1), F.least(F.col("k") - 1, F.lit(len(ORDERS))).cast("int"))))
    tokens = materialise(tokens.select("token", "node", "at", "leads"), "copies-tokens")
    release(of)

    # each set with the first of those that the SimHash index puts close to it
    close = _links(close_pairs(rows, sets), sets, rows)

    # each set with those that lead most of its hashes, if those are many
    links = _links(leaders(tokens), sets, rows, False)
    rooted = _rooted(sets, links.unionByName(close))
    release(links, close)
    shared = materialise(_shared(tokens, rooted), "copies-shared")

    # where hashes still join many components, with others that lead them
    crowd = materialise(shared.filter(F.col("roots") > CROWD), "copies-crowd")
    if not crowd.isEmpty():
        rooted = gathered(tokens, crowd, rooted, sets, rows)
        release(shared)
        shared = materialise(_shared(tokens, rooted), "copies-shared")

    # all others that share a hash and may be alike
    held = tokens.select("token", "node", "at")
    open_ = materialise(held.join(shared.select("token"), "token").select("token", "node", "at"), "copies-open")
    pairs = open_pairs(open_.join(rooted, "node")).select(F.col("nodex").alias("a"), F.col("nodey").alias("b")).distinct()
    more = _links(pairs, sets, rows, True)
    known = rooted.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    whole = connected_components(more.unionByName(known))
    release(tokens, shared, open_, more)
    return nodes.join(whole, "node", "left").select("_row", F.coalesce("root", "node").alias("component"))
