"""Streams over files in no order of time, restarts, failures and compaction."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from cuelattice import ledger
from cuelattice.operators import refine, rows, runs, timing
from cuelattice.sources import derived
from cuelattice.streaming import jobs, ordered

DATA = "/root/testdata/sf0.001"
SCHEMA = "event_id string, job_id string, queue string, state string, ts timestamp, value double"
DAY = 86_400
BASE = 10_000 * DAY * 1_000_000


def made_up(seed, n=400):
    """Events of few jobs over ten days, some at the same microsecond. A watermark begins at
    the epoch, so they lie well behind it."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = BASE + rng.choice([rng.randint(0, 10 * DAY), rng.randint(0, 20) * DAY // 2]) * 1_000_000 + rng.choice([0, 0, 1, 999])
        out.append((f"e{i:04d}", f"job-{rng.randint(0, 11)}", f"q{i % 3}", rng.choice(["active", "active", "waiting", "completed", "failed", None]), at, float(i % 7)))
    return out


def frame(spark, events):
    df = spark.createDataFrame(events, "event_id string, job_id string, queue string, state string, at long, value double")
    return df.select("event_id", "job_id", "queue", "state", F.timestamp_micros("at").alias("ts"), "value")


def put(spark, path, events):
    frame(spark, events).coalesce(1).write.mode("append").parquet(path)


def tick(at):
    return [("tick", None, None, "active", at, None)]


def streamed(spark, path, make, tmp, name="out"):
    """Drain once; what the stream has sent in all, and its batches."""
    stream = make(jobs.read_events(spark, path, SCHEMA))
    log = jobs.drain(stream.writeStream.format("parquet").option("path", f"{tmp}/{name}"), f"{tmp}/cp-{name}", 300, ordered.STATE_STORE)
    return spark.read.schema(stream.schema).parquet(f"{tmp}/{name}"), log


def same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stale_and_verdicts_from_shuffled_files_and_a_restart(spark, tmp_path, seed):
    events, path, gap = made_up(seed), f"{tmp_path}/in", 5 * 3600
    rng = random.Random(seed)
    files = [[] for _ in range(4)]
    for e in events:
        rng.choice(files).append(e)
    ends = max(e[4] for e in events)
    stale = lambda s: ordered.reclaim_stale(s, gap, "20 days")
    verdicts = lambda s: ordered.live_verdicts(s, gap, 2, "20 days")
    for some in (files[:2], [*files[2:], tick(ends + 20 * DAY * 1_000_000)]):
        for f in some:
            put(spark, path, f)
        claims, log = streamed(spark, path, stale, tmp_path, "stale")
        told, _ = streamed(spark, path, verdicts, tmp_path, "told")
        assert sum(p["dropped"] for p in log) == 0
    batch = frame(spark, events)
    assert claims.count() > 20 and same(claims, runs.stale(batch, gap))
    assert same(ordered.verdicts_now(told), rows.liveness_verdicts(batch, gap, 2, last=True))


def test_disorder_within_the_lateness_and_claims_while_the_stream_runs(spark, tmp_path):
    """Files of about a day each, an hour out of order: claims leave as the watermark passes."""
    rng = random.Random(7)
    events = made_up(5, 600)
    files = {}
    for e in events:
        files.setdefault((e[4] + rng.randint(0, 3600) * 1_000_000) // (2 * DAY * 1_000_000), []).append(e)
    path, seen = f"{tmp_path}/in", []
    for k in sorted(files):
        put(spark, path, files[k])
        out, _ = streamed(spark, path, lambda s: ordered.reclaim_stale(s, 3600, "1 hour"), tmp_path)
        seen.append(out.count())
    assert 0 < seen[0] < seen[1] < seen[-1]
    put(spark, path, tick(max(e[4] for e in events) + 3600 * 1_000_000))
    out, _ = streamed(spark, path, lambda s: ordered.reclaim_stale(s, 3600, "1 hour"), tmp_path)
    assert same(out, runs.stale(frame(spark, events), 3600))


def test_late_event_that_once_made_a_wrong_claim(spark, tmp_path):
    second = 1_000_000
    put(spark, f"{tmp_path}/in", [("a", "j", "q", "active", BASE, 1.0), ("c", "k", "q", "active", BASE + 100 * second, 1.0)])
    put(spark, f"{tmp_path}/in", [("b", "j", "q", "completed", BASE + 10 * second, 1.0)])
    put(spark, f"{tmp_path}/in", tick(BASE + 100 * second + 3600 * second))
    out, _ = streamed(spark, f"{tmp_path}/in", lambda s: ordered.reclaim_stale(s, 60, "1 hour"), tmp_path)
    assert out.count() == 0


def test_rows_without_time_id_or_job(spark, tmp_path):
    events = [("a", None, "q", "active", BASE, None), (None, "j", "q", "active", BASE, None), ("b", "j", "q", "active", None, None), ("c", "j", "q", None, BASE + 5, None), ("d", "j", "q", "active", BASE + 10, None), ("d", "j", "q", "active", BASE + 10, None)]
    put(spark, f"{tmp_path}/in", events)
    put(spark, f"{tmp_path}/in", tick(BASE + DAY * 1_000_000))
    out, _ = streamed(spark, f"{tmp_path}/in", lambda s: ordered.reclaim_stale(s, 60, "1 second"), tmp_path)
    assert sorted(map(str, ((r["job_id"], r["event_id"], r["action"]) for r in out.collect()))) == sorted(map(str, [(None, "a", "dispatch_again"), ("j", "d", "dispatch_again")]))


def test_late_rows_are_as_many_as_spark_dropped(spark, tmp_path):
    second, path = 1_000_000, f"{tmp_path}/in"
    on_time = [[(f"a{i}", "j", "q", "active", i * second, 1.0) for i in range(100)], [(f"b{i}", "j", "q", "active", (1000 + i) * second, 1.0) for i in range(50)], [(f"c{i}", "j", "q", "active", (1100 + i) * second, 1.0) for i in range(20)]]
    late = [[(f"x{i}", "j", "q", "active", (900 + 10 * i) * second, 1.0) for i in range(30)], [(f"y{i}", "j", "q", "active", i * second, 1.0) for i in range(17)]]
    keep = lambda s: jobs.keep_on_time(s, "60 seconds")
    dropped = 0
    for some in (on_time, late[:1], late[1:]):
        for f in some:
            put(spark, path, f)
        out, log = streamed(spark, path, keep, tmp_path)
        dropped += sum(p["dropped"] for p in log)
    side = jobs.late_rows_of(frame(spark, sum(on_time + late, [])), out)
    assert dropped > 17 and side.count() == dropped
    assert {r[0] for r in side.select("event_id").collect()} >= {f"y{i}" for i in range(17)}


def test_rates_and_trends_as_streams_with_a_restart(spark, tmp_path):
    events, path = made_up(9), f"{tmp_path}/in"
    make = {"rates": lambda s: jobs.start_rates(s, "1 hour", 1, "20 days"), "trend": lambda s: jobs.wait_trend(s, "2 hours", "1 hour", "20 days")}
    out = {}
    for some in ([events[::3], events[1::3]], [events[2::3], tick(max(e[4] for e in events) + 21 * DAY * 1_000_000)]):
        for f in some:
            put(spark, path, f)
        for name, f in make.items():
            out[name], log = streamed(spark, path, f, tmp_path, name)
            assert len([p for p in log if p["rows"]]) == 2
    batch = frame(spark, events)
    assert out["rates"].count() > 20 and same(out["rates"], make["rates"](batch))
    assert same(out["trend"], make["trend"](batch))


def folders(path):
    return [n for n in os.listdir(path) if not n.startswith((".", "_"))]


def test_states_stay_in_few_folders(spark, tmp_path):
    events, path = made_up(11, 300), f"{tmp_path}/in"
    random.Random(1).shuffle(events)
    for k in range(30):
        put(spark, path, events[k::30])
    jobs.keep_states(jobs.read_events(spark, path, SCHEMA), f"{tmp_path}/out", f"{tmp_path}/cp", most=5)
    assert len(folders(f"{tmp_path}/out")) <= 2 * 6 and len([n for n in os.listdir(f"{tmp_path}/out/_versions") if n.isdigit()]) <= 8
    assert same(jobs.running_states(spark, f"{tmp_path}/out"), rows.latest_states(frame(spark, events)))
    assert jobs.running_states(spark, f"{tmp_path}/none").count() == 0


def turns_in(spark, path, rows_):
    spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string").coalesce(1).write.mode("append").parquet(path)


def test_incremental_publishing_survives_failures_and_sees_new_files(spark, tmp_path, monkeypatch):
    path, out, cp = f"{tmp_path}/conversations.parquet", f"{tmp_path}/out", f"{tmp_path}/cp"
    rng = random.Random(3)
    said = lambda c, t: (c, t, ["user", "assistant"][t % 2], " ".join(rng.choice(["Hello", "there.", "yes", "no", "maybe,", "well"]) for _ in range(rng.randint(1, 12))))
    first, second = [said(c, t) for c in range(4) for t in range(3)], [said(c, t) for c in (2, 3, 4) for t in range(3, 6)]
    schema = "conv_id long, turn long, role string, text string"

    def tables(ids):
        found = derived.engine_words(derived.words(spark, str(tmp_path))), derived.turns(spark, str(tmp_path)), derived.segment_table(spark, str(tmp_path))
        return tuple(t.join(ids, "programme_id", "left_semi") for t in found)

    def run():
        arrivals = jobs.read_events(spark, path, schema).select(F.col("conv_id").alias("programme_id"))
        jobs.publish_incrementally(arrivals, tables, out, cp)

    turns_in(spark, path, first)
    whole = ledger.Ledger.commit
    monkeypatch.setattr(ledger.Ledger, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(Exception, match="division"):
        run()
    assert jobs.published_rows(spark, out) is None and len(folders(out)) == 1

    def commit_then_fail(self, *a, **k):
        whole(self, *a, **k)
        raise RuntimeError("lost after the flip")

    monkeypatch.setattr(ledger.Ledger, "commit", commit_then_fail)
    with pytest.raises(Exception, match="lost after the flip"):
        run()
    monkeypatch.setattr(ledger.Ledger, "commit", whole)
    run()
    now = ledger.Ledger(spark, out).current()
    assert now["version"] == 1 and len(now["folders"]) == 1 and now["batches"] == {cp: 0}
    turns_in(spark, path, second)
    run()
    assert ledger.Ledger(spark, out).current()["version"] == 2
    want = refine.refine_programmes(*tables(spark.range(5).withColumnRenamed("id", "programme_id")))
    gate = refine.export_gate(want).select("programme_id", "exportable")
    cols = ["programme_id", "segment_id", "group_no", "state", "cause", "start_ms", "end_ms", "exportable"]
    got = jobs.published_rows(spark, out)
    assert got.filter("programme_id = 4").count() > 0 and same(got.select(*cols), want.join(gate, "programme_id").select(*cols))


def test_one_of_two_publishers_wins(spark, tmp_path):
    book = ledger.Ledger(spark, f"{tmp_path}/book")
    base, won, lost = book.current(), [], []
    names = [book.write(spark.range(k + 1), f"w{k}") for k in range(4)]

    def go(k):
        try:
            won.append((k, book.commit(base, [names[k]])))
        except ledger.Conflict:
            lost.append(k)

    threads = [threading.Thread(target=go, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 3
    assert book.read().count() == won[0][0] + 1
    book.sweep()
    assert folders(f"{tmp_path}/book") == [names[won[0][0]]]
    with pytest.raises(ledger.Conflict):
        book.commit(base, names)


def test_refined_words_follow_their_programmes(spark, tmp_path):
    path, out = f"{tmp_path}/conversations.parquet", f"{tmp_path}/out"
    turns_in(spark, path, [(1, 0, "user", "a b c"), (2, 0, "user", "d")])
    turns_in(spark, path, [(2, 1, "user", "e f")])
    arrivals = jobs.read_events(spark, path, "conv_id long, turn long, role string, text string").select(F.col("conv_id").alias("programme_id"))
    words = lambda ids: derived.words(spark, str(tmp_path)).join(ids, "programme_id", "left_semi")
    jobs.refine_incrementally(arrivals, words, out, f"{tmp_path}/cp", most=1)
    want = timing.refine_timing(derived.words(spark, str(tmp_path)))
    assert same(jobs.published_rows(spark, out).select(*want.columns), want)


def test_means_of_a_trend_are_exact(spark):
    """1.005 * 100 + 0.5 is 100.99999999999999 in doubles; a sum of doubles depends on its order."""
    rows = [(k, f"q{q}", "waiting", v) for q, values in enumerate([[1.005], [0.1, 0.2, 0.3, 0.02], [-1.005], [1e22, 0.3, -1e22, 0.02], [float("nan"), 2.0, 2.01]]) for k, v in enumerate(values)] + [(0, "q5", "active", 3.0)]
    e = spark.createDataFrame(rows, "event_id long, queue string, state string, value double").withColumn("ts", F.lit("2024-01-01 00:30:00").cast("timestamp"))
    out = jobs.wait_trend(e, "1 hour", "1 hour").select("queue", jobs.cents(F.col("sum_wait"), F.col("n_wait")).alias("c"), "mean_wait", jobs.cents(F.col("sum_work"), F.col("n_work")).alias("k"))
    assert {r["queue"]: (r["c"], r["k"]) for r in out.collect()} == {"q0": (101, None), "q1": (16, None), "q2": (-100, None), "q3": (16, None), "q4": (201, None), "q5": (None, 300)}
