"""Golden cases of the word rules, and the registered SQL on the smallest tables."""

import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cuelattice.functions import exprs as X
from cuelattice.operators import timing
from cuelattice.plans import registry

DATA = "/root/testdata/sf0.001"


def words(spark, rows):
    return spark.createDataFrame([(1, seg, i, t, ps, pe, s, e) for seg, i, t, ps, pe, s, e in rows], "programme_id long, segment_id long, word_index long, text string, ps long, pe long, s long, e long")


@pytest.mark.parametrize(("text", "dur", "rate", "ceiling"), [("News.", 210, 1500, 565), ("leadership.", 115, 1964, 1964), ("Enhorabuena,", 1578, 2143, 2143), ("x" * 25, None, 4464, 4464)])
def test_ceilings(spark, text, dur, rate, ceiling):
    d = F.lit(dur).cast("long")
    assert tuple(spark.range(1).select(X.max_word_ms(F.lit(text)), X.evidence_ceiling(F.lit(text), d)).first()) == (rate, ceiling)


def test_absorbed_onset_is_restored(spark):
    w = words(spark, [(1, 0, "a.", 0, 300, 0, 300), (1, 1, "News.", 5000, 5210, 3210, 5210), (1, 2, "next", 5300, 5700, 5300, 5700)])
    got = {r["word_index"]: (r["outcome"], r["s"], r["e"]) for r in timing.arbitrate(w).collect()}
    assert got[1] == ("restored", 5000, 5210) and got[0][0] == got[2][0] == "undisputed"


def test_leading_seam_over_the_limit_is_refused(spark):
    w = words(spark, [(1, 0, "before", 0, 5349, 0, 5349), (1, 1, "News.", 5000, 5210, 5349, 5350), (1, 2, "next", 5800, 6200, 5800, 6200)])
    got = {r["word_index"]: r["outcome"] for r in timing.arbitrate(w).collect()}
    assert got[1] == "unresolved"


def test_stack_without_evidence_collapses(spark):
    w = words(spark, [(1, i, "word", 100 + i, 103 + i, 500, 501) for i in range(5)])
    assert {r["outcome"] for r in timing.arbitrate(w).collect()} == {"alignment_collapsed"}


def test_null_times_and_empty_table(spark):
    w = words(spark, [(1, 0, "a", None, None, None, None), (1, 1, "b", 0, 100, 0, 100)])
    assert timing.refine_timing(w).count() == 2
    assert timing.refine_timing(w.limit(0)).count() == 0


def test_order_does_not_matter(spark):
    from cuelattice.sources import derived

    w = derived.words(spark, DATA)
    a = timing.refine_timing(w).agg(F.sum(F.xxhash64("programme_id", "segment_id", "word_index", "s", "e", "outcome").cast("decimal(38,0)"))).first()[0]
    b = timing.refine_timing(w.repartition(7)).agg(F.sum(F.xxhash64("programme_id", "segment_id", "word_index", "s", "e", "outcome").cast("decimal(38,0)"))).first()[0]
    assert a == b


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(DATA + "/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    got = registry.QUERIES[name](spark, DATA)
    want = c.sql(registry.ORACLES[name]).df()
    key = lambda rows: sorted(tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    clean = lambda v: None if v is None or pd.isna(v) else (int(v) if isinstance(v, float) and v == int(v) else v)
    a = key([clean(v) for v in r] for r in got.select(*cols).toPandas()[cols].astype(object).values.tolist())
    b = key([clean(v) for v in r] for r in want[cols].astype(object).values.tolist())
    assert a == b


def test_session_stream_runs(spark, tmp_path):
    from cuelattice.sources import derived
    from cuelattice.streaming import jobs

    src = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = derived.job_events(jobs.read_events(spark, str(tmp_path / "in"), src.schema))
    q = jobs.start_rates(stream, "1 hour", 2).writeStream.format("memory").queryName("rates").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("rates").count() > 0
