"""Words are dealt no oftener than needed, and what replaces a shuffle gives the same."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cuelattice.operators import folds, speakers, timing
from cuelattice.plans import programme
from cuelattice.sources import derived

DATA = "/root/testdata/sf0.001"
WORDS = "programme_id long, segment_id long, word_index long, text string, ps long, pe long, s long, e long"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def words(seed):
    """Words in disputed runs of all kinds, stacked, null and far-reaching, and long ones between."""
    rng, out = random.Random(seed), []
    for p in range(3):
        now = 0
        for seg in range(25):
            for i in range(rng.randint(1, 12)):
                ps, pe = now, now + rng.choice([5, 90, 250, 400])
                s, e = ps + rng.randint(-20, 20), pe + rng.randint(-20, 20)
                kind = rng.random()
                if kind < 0.2:
                    s, e = ps - rng.choice([900, 4_000]), rng.choice([pe, pe + 2_500])
                elif kind < 0.35 and out:
                    s, e = out[-1][6], out[-1][7]
                elif kind < 0.45:
                    e = s + rng.choice([1, 20, 1_600, 2_200])
                elif kind < 0.5:
                    s = e = None
                elif kind < 0.55:
                    ps = pe = None
                out.append((p, seg, i, rng.choice(["a", "word", "Enhorabuena,"]), ps, pe, s, e))
                now += rng.randint(20, 500)
    return out


@pytest.mark.parametrize("seed,broadcast", [(1, 1_000_000), (2, -1), (3, -1)])
def test_the_furthest_end_comes_with_the_decision(spark, monkeypatch, seed, broadcast):
    monkeypatch.setattr(folds, "BROADCAST", broadcast)
    got = timing.arbitrate(spark.createDataFrame(words(seed), WORDS)).cache()
    want = timing.clamp_onsets(got.drop("_far")).select("programme_id", "segment_id", "word_index", "s", "e", "absorbed")
    own = timing.clamp_onsets(got).select(*want.columns)
    assert sorted(map(str, own.collect())) == sorted(map(str, want.collect()))
    assert want.filter("absorbed > 0").count() > 5 and own.count() == len(words(seed))
    got.unpersist()


def test_refined_words_stay_where_they_are(spark):
    """Runs and their decisions are dealt; no window deals the words by programme again."""
    assert not re.findall(r"Exchange hashpartitioning\(programme_id#\d+L?, \d+\)", plan(timing.refine_timing(derived.words(spark, DATA))))


def test_words_are_dealt_by_segment_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = speakers.grouped_words(*programme._inputs(spark, DATA))
        shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(w))
        assert not [x for x in shuffles if "word_index" in x] and w.filter(F.col("cluster").isNotNull()).count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
