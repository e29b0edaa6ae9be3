"""Cascade plans, compare-and-set publishing, quantile sketches."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cuelattice import ledger
from cuelattice.operators import publish, ranges, sketches
from cuelattice.operators.cascades import Link, deletion_order, plan_cascade


def test_order_of_deletion():
    links = [Link("b", "x", "a", "x"), Link("c", "x", "b", "x"), Link("d", "x", "b", "x"), Link("d", "y", "c", "y"), Link("z", "x", "q", "x")]
    order = deletion_order(links, "a")
    assert set(order) == set("abcd") and order[-1] == "a" and all(order.index(x.child) < order.index(x.parent) for x in links if x.parent in "abc")
    with pytest.raises(ValueError, match="b -> c -> b"):
        deletion_order([*links, Link("b", "y", "c", "x")], "a")
    with pytest.raises(ValueError, match="a -> a"):
        deletion_order([Link("a", "boss", "a", "id")], "a")


def test_rows_go_once_and_null_keys_stay(spark):
    t = {
        "p": spark.createDataFrame([(1,), (2,), (3,)], "id long"), "q": spark.createDataFrame([(10, 1), (11, 2), (12, None), (13, 1)], "id long, p long"),
        "r": spark.createDataFrame([(1, 10, 1), (2, 11, 2), (3, None, None), (4, 11, 1), (5, 10, 2), (6, 99, None), (1, 10, 1)], "n long, q long, p long"),
    }
    links = [Link("q", "p", "p", "id"), Link("r", "q", "q", "id"), Link("r", "p", "p", "id")]
    plan = plan_cascade(t, links, "p", t["p"].filter("id = 1"))
    assert [name for name, _, _ in plan] == ["r", "q", "p"]
    got = {name: (sorted(r[0] for r in going.collect()), sorted(r[0] for r in staying.collect())) for name, going, staying in plan}
    assert got == {"r": ([1, 1, 4, 5], [2, 3, 6]), "q": ([10, 13], [11, 12]), "p": ([1], [2, 3])}
    assert all(going.columns == t[name].columns == staying.columns for name, going, staying in plan)
    assert [going.count() for _, going, _ in plan_cascade(t, links, "p", t["p"].limit(0))] == [0, 0, 0]
    with pytest.raises(ValueError, match="no table is given for r"):
        plan_cascade({k: t[k] for k in "pq"}, links, "p", t["p"])


def test_second_publisher_from_one_version_is_refused(spark, tmp_path):
    s = spark.createDataFrame([(1, "a"), (2, "b")], "programme_id long, text string")
    count = lambda df: df.groupBy("programme_id").agg(F.count(F.lit(1)).alias("n_rows"))
    base = ledger.Ledger(spark, str(tmp_path)).current()
    new = publish.publish_over(s, count(s), str(tmp_path), base)
    other = s.filter("programme_id = 1")
    with pytest.raises(ledger.Conflict):
        publish.publish_over(other, count(other), str(tmp_path), base)
    assert publish.current_segments(spark, str(tmp_path)).count() == 2
    with pytest.raises(ValueError, match="without a report"):
        publish.publish_over(s, count(other), str(tmp_path), new)
    publish.publish_over(other, count(other), str(tmp_path), new)
    assert publish.current_segments(spark, str(tmp_path)).count() == 1


def test_quantiles_of_merged_sketches(spark):
    rng = random.Random(5)
    rows = [(g, f"2024-01-{d:02d} 10:00:00", rng.choice([rng.expovariate(0.01), float(rng.randint(0, 50))])) for g in "ab" for d in range(1, 9) for _ in range(4000 if g == "a" else 20)]
    rows += [("a", "2024-01-03 00:00:00", None), ("c", "2024-01-03 00:00:00", None)]
    df = spark.createDataFrame(rows, "g string, at string, v double").repartition(5)
    days = sketches.sketch_days(df, ["g"], "v", F.col("at").cast("timestamp"), 500)
    ranks = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    for first, last in ((None, None), ("2024-01-03", "2024-01-06")):
        got = {r["g"]: r for r in sketches.merged_quantiles(days, ["g"], ranks, first, last, 500).collect()}
        assert set(got) == {"a", "b"}
        for g, r in got.items():
            own = sorted(v for h, at, v in rows if h == g and v is not None and (first is None or first <= at[:10] <= last))
            assert r["n"] == len(own) and r["largest"] == own[-1] and abs(r["total"] - sum(own)) < 1e-6 * sum(own)
            for name, p in ranks.items():
                low, high = sum(v < r[name] for v in own) / len(own), sum(v <= r[name] for v in own) / len(own)
                assert low - 2 * sketches.rank_error(500) <= p <= high + 2 * sketches.rank_error(500)
        b = sorted(v for h, at, v in rows if h == "b" and (first is None or first <= at[:10] <= last))
        assert got["b"]["p50"] == b[-(-len(b) // 2) - 1]
    assert sketches.merged_quantiles(days.limit(0), ["g"], ranks).count() == 0


def test_running_sums_by_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, None]), i, rng.choice([None, rng.randint(-5, 9)])) for i in range(200)]
    for span in (10_000, 7, 1):
        got = ranges.sum_before(spark.createDataFrame(rows, "run long, at long, v long").repartition(3), ["run"], "at", "v", "spent", span).collect()
        assert {r["at"]: r["spent"] for r in got} == {i: sum(v or 0 for k, j, v in rows if k == run and j < i) for run, i, _ in rows}


def test_exact_quantiles_whatever_the_sketches_say(spark):
    v = [(("a", None)[k % 2], (k * 7919) % 9001 / 100 if k % 10 else None, f"2024-01-{1 + k % 9:02d}") for k in range(12_000)]
    df = spark.createDataFrame([*v, ("one", 2.5, "2024-01-03"), ("early", 1.0, "2024-01-01")], "g string, v double, at string")
    ranks, at = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}, F.col("at").cast("timestamp")
    days = sketches.sketch_days(df, ["g"], "v", at, 8)
    lying = days.withColumn("sketch", F.first("sketch").over(Window.orderBy(F.desc("g"), "day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    for sketched, k in ((days, 8), (lying, 8)):
        got = {r["g"]: r for r in sketches.exact_quantiles(df, sketched, ["g"], "v", at, ranks, "2024-01-02", "2024-01-08", k).collect()}
        assert set(got) == {"a", None, "one"}
        for g in got:
            own = sorted(r["v"] for r in df.collect() if r["g"] == g and r["v"] is not None and "2024-01-02" <= r["at"] <= "2024-01-08")
            assert (got[g]["n"], got[g]["largest"]) == (len(own), own[-1])
            for name, p in ranks.items():
                assert got[g][name] == own[max(1, math.ceil(Decimal(str(p)) * len(own))) - 1], (g, name)


def test_a_worker_gives_memory_back_before_it_holds_a_model(monkeypatch):
    from cuelattice.llm import common

    calls = []
    monkeypatch.setattr(common, "_HELD", {})
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert [common.held(("a model",), lambda: 7) for _ in range(2)] == [7, 7] and calls == [1]
