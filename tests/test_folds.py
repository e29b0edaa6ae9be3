"""Ordered folds in ranges against one plain pass."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cuelattice.operators import audit, folds, islands

RUNS = "programme_id long, _run long, aligned_ok boolean, prov_ok boolean, t long, before long, prov_max long, aligned_max long"


def made_up_runs(seed, programmes=4, n=300, still=False):
    """Runs whose provider's and aligned ends often decide otherwise for what follows."""
    rng, out = random.Random(seed), []
    for p in range(programmes):
        now = 0
        for i in range(n):
            now += 0 if still else rng.randint(0, 120)
            t = None if rng.random() < 0.05 else now + rng.randint(-300, 300)
            before = None if rng.random() < 0.3 else now + rng.randint(-500, 50)
            prov = rng.random() < 0.7
            out.append((p, 2 * i + rng.randint(0, 1), rng.random() < 0.2, prov, t, before, now + rng.randint(-100, 400) if prov or rng.random() < 0.5 else None, now + rng.randint(-100, 600)))
    rng.shuffle(out)
    return out


def brute_runs(runs):
    last, out = {}, []
    for p, run, aligned, prov, t, before, pmax, amax in sorted(runs, key=lambda r: r[:2]):
        seen = [x for x in (last.get(p), before) if x is not None]
        f = max(seen) if seen else None
        back = prov and not aligned and (f is None or t is None or f <= t)
        out.append((p, run, aligned, back, f))
        end = pmax if back else amax
        last[p] = max([x for x in (f, end) if x is not None], default=None)
    return out


@pytest.mark.parametrize("seed,size,still", [(1, 8_192, False), (2, 50, False), (3, 7, False), (4, 2, True), (5, 33, True)])
def test_furthest_end(spark, seed, size, still):
    runs = made_up_runs(seed, still=still)
    got = folds.furthest_end(spark.createDataFrame(runs, RUNS).repartition(3), "bigint", size < 600, size)
    assert sorted(map(tuple, got.collect())) == brute_runs(runs)


def test_composed_runs_are_the_function_they_stand_for():
    rng = random.Random(8)
    for _ in range(200):
        steps = [(rng.random() < 0.8, rng.randint(0, 60), rng.randint(0, 60), rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(1, 12))]
        low, high = sorted((rng.randint(-5, 65), rng.randint(-5, 65)))
        pieces = [(high, folds.NEVER)]
        for may, t, b, p, a in steps:
            pieces = folds.compose(pieces, low - 1, may, t, b, p, a)
        assert len(pieces) <= len(steps) + 1
        for f in range(low, high + 1):
            want = f
            for may, t, b, p, a in steps:
                want = max(want, b)
                want = max(want, p if may and want <= t else a)
            assert folds.at(pieces, f) == want


def test_one_programme_of_a_million_runs_takes_many_tasks(spark):
    n = 1_000_000
    i = F.col("id")
    h = lambda k: F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1000))
    runs = spark.range(n).select(
        F.lit(7).cast("long").alias("programme_id"), i.alias("_run"), (h(1) < 200).alias("aligned_ok"), (h(2) < 700).alias("prov_ok"), (i * 60 + h(3) - 500).alias("t"),
        F.when(h(4) < 600, i * 60 + h(5) - 800).alias("before"), (i * 60 + h(6) - 200).alias("prov_max"), (i * 60 + h(7) - 200).alias("aligned_max"),
    ).cache()
    got = folds.furthest_end(runs, "bigint", True).withColumn("task", F.spark_partition_id()).cache()
    assert got.select("task").distinct().count() >= 4
    want = {r[1]: r[3:] for r in brute_runs([tuple(r) for r in runs.toLocalIterator()])}
    assert all(want[r["_run"]] == (r["restored"], r["f_in"]) for r in got.toLocalIterator()) and got.count() == n
    runs.unpersist()
    got.unpersist()


ROWS = "programme_id long, cluster string, start_ms long, end_ms long, sequence_index long, last_word_start long"


def brute_rows(rows):
    groups, out = defaultdict(list), []
    for r in rows:
        groups[r[:2]].append(r)
    low = lambda x: (x is not None, x or 0)
    for own in groups.values():
        far = None
        for p, _, s, e, i, w in sorted(own, key=lambda r: (low(r[2]), low(r[3]), r[4], -1 if r[5] is None else r[5])):
            if far and far[1] is not None and s is not None and far[1] - s > 10:
                over = far[1] - s
                fix = over <= 250 and s > far[0] and far[3] < s
                out.append((p, i, far[2], over, fix))
                if fix:
                    far[1] = s
            if far is None or far[1] is None or (e is not None and e > far[1]):
                far = [s, e, i, -1 if w is None else w]
    return out


@pytest.mark.parametrize("seed,size", [(1, 8_192), (2, 10), (3, 1)])
def test_furthest_row(spark, seed, size):
    rng, rows = random.Random(seed), []
    for p in range(3):
        now = 0
        for i in range(300):
            now += rng.randint(0, 300)
            end = now + rng.choice([50, 200, 400, 900, 5000 if rng.random() < 0.1 else 300])
            rows.append((p, rng.choice(["a", "b", None]), now, end, i, rng.choice([None, end - 30, now])))
    rows += [(9, "a", None, 5, 1, None), (9, "a", 3, None, 2, None), (9, "a", 4, 400, 3, 4), (9, "a", 390, 500, 4, None)]
    got = folds.furthest_row(spark.createDataFrame(rows, ROWS).repartition(3), "bigint", 10, 250, size)
    assert sorted(map(tuple, got.collect())) == sorted(brute_rows(rows))
    assert folds.furthest_row(spark.createDataFrame([], ROWS), "bigint", 10, 250).count() == 0


def test_rows_tell_their_own_reasons(spark):
    base = {c: 0 for c in ("unresolved_words", "exhausted_words", "near_zero_words", "cleared_words", "uncovered_words", "expansion_ms", "conflict_ms")} | {c: False for c in ("authored_preserved", "is_music", "collapsed", "rejected", "restored", "onset_moved")}
    base |= {"defect": None, "boundary": "x", "override": None, "span_unresolved": False, "island": False, "span_reason": None, "island_reason": None, "n_clusters": 3}
    rows = [base | {"span_unresolved": True, "span_reason": "mine"}, base | {"span_unresolved": True, "span_reason": ""}, base | {"island": True, "island_reason": "other"}, base | {"island": True, "span_unresolved": True, "span_reason": "mine"}, base]
    kinds = {bool: "boolean", int: "long", str: "string", type(None): "string"}
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{k} {kinds[type(v)]}" for k, v in base.items()))
    said = [r["state_reason"] for r in audit.derive_state(df, True).collect()]
    assert said == ["mine", audit.SENTENCES["several_speakers"], "other", audit.SENTENCES["island"], audit.SENTENCES["evidence"]]
    assert audit.derive_state(df).first()["state_reason"] == audit.SENTENCES["several_speakers"]
    assert "heard 3 different" in audit.with_span_reason(df).first()["span_reason"] and islands.REASON[0].endswith("favors ")
