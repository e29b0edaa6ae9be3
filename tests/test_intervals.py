"""Interval joins over spans of any length against brute force."""

import random

from pyspark.sql import functions as F

from cuelattice.operators import intervals

HOUR = 3_600_000
TURNS = "programme_id long, cluster string, start_ms long, end_ms long"
WORDS = "programme_id long, segment_id long, word_index long, s long, e long"


def spans(rng, n, hours=30):
    out = []
    for i in range(n):
        start = rng.randint(-1000, hours * HOUR)
        out.append((rng.randint(0, 1), f"c{i % 5}", start, start + rng.choice([0, 50, 4_000, 90_000, 700_000, 3 * HOUR, 10 * HOUR, 80 * HOUR])))
    return [*out, (0, "n", None, 5), (1, "n", 7, None), (1, "back", 500, 100)]


def test_a_turn_of_ten_hours_makes_few_rows(spark):
    t = spark.createDataFrame([(1, "a", 12_345, 12_345 + 10 * HOUR)], TURNS)
    assert intervals.cover(t, "start_ms", "end_ms").count() <= 9 and intervals.cover(t, "start_ms", "end_ms", True).count() < 40
    assert intervals.cover(spark.createDataFrame([(1, "a", 0, 79_999)], TURNS), "start_ms", "end_ms", True).count() <= 21


def test_best_overlap_of_short_and_long(spark):
    rng = random.Random(6)
    turns = spans(rng, 150)
    words = [(rng.randint(0, 2), 1, i, s, s + rng.choice([0, 300, 2_000, 200_000, 5 * HOUR])) for i, s in enumerate(rng.randint(0, 30 * HOUR) for _ in range(200))]
    t = [x for x in turns if None not in x]

    def best(p, s, e):
        found = [(min(e, b) - max(s, a), -a, -b, c) for q, c, a, b in t if q == p and min(e, b) > max(s, a)]
        return max(found) if found else None

    want = {}
    for p, g, i, s, e in words:
        x = best(p, s, e)
        want[p, g, i] = (x[3], x[0]) if x else (None, None)
    for long in (False, True):
        got = intervals.best_overlap(spark.createDataFrame(words, WORDS), spark.createDataFrame(turns, TURNS), long).collect()
        assert len(got) == len(words) and {(r["programme_id"], r["segment_id"], r["word_index"]): (r["cluster"], r["overlap_ms"]) for r in got} == want


def test_points_in_spans(spark):
    rng = random.Random(7)
    turns = spans(rng, 100)
    words = [(rng.randint(0, 2), 1, i, rng.choice([rng.randint(0, 40 * HOUR), *[x[2] for x in turns[:5]], *[x[3] for x in turns[:5]]]), 0) for i in range(200)] + [(1, 1, 900, None, 0)]
    got = intervals.points_in(spark.createDataFrame(words, WORDS), spark.createDataFrame(turns, TURNS)).select("word_index", "cluster", "start_ms", "end_ms").collect()
    want = [(i, c, a, b) for p, _, i, s, _ in words for q, c, a, b in turns if p == q and None not in (s, a, b) and a <= s < b]
    assert sorted(map(tuple, got)) == sorted(want) and want
    none = spark.createDataFrame([], TURNS)
    assert intervals.points_in(spark.createDataFrame(words, WORDS), none).count() == 0 == intervals.cover(none, "start_ms", "end_ms").filter(F.lit(True)).count()
