"""Golden cases of boundaries, islands, audit, runs and evidence."""

import re

from pyspark.sql import functions as F

from cuelattice.operators import audit, boundaries, evidence, islands, runs, speakers
from cuelattice.plans import programme
from cuelattice.sources import derived as D

ROW = "programme_id long, sequence_index long, start_ms long, end_ms long, core_start long, core_end long, n_words long, pb_start long, pb_end long, authored_preserved boolean"


def rows(spark, *items):
    return spark.createDataFrame([(1, k, *x, False) for k, x in enumerate(items)], ROW)


def test_row_without_trusted_word_takes_the_provider_window(spark):
    r = boundaries.derive_boundaries(rows(spark, (30129, 30340, None, None, 2, 29497, 29846))).first()
    assert (r.boundary, r.start_ms, r.end_ms, r.lead_in_ms, r.lead_out_ms) == ("unresolved_words_preserved", 29497, 29846, 0, 0)


def test_lead_out_is_capped(spark):
    r = boundaries.derive_boundaries(rows(spark, (1000, 2000, 1000, 2000, 3, None, None), (3860, 4500, 3860, 4500, 2, None, None))).orderBy("sequence_index").collect()
    assert (r[0].lead_out_ms, r[0].end_ms, r[1].lead_in_ms, r[1].start_ms) == (200, 2200, 120, 3740)


def test_inversion_marks_both_rows(spark):
    df = rows(spark, (125043, 125700, None, None, 0, None, None), (123444, 124000, None, None, 0, None, None))
    assert {r.conflict_ms for r in boundaries.mark_chronology(df).collect()} == {1599}


def test_provider_window_is_carried_forward(spark):
    c = lambda v: F.lit(v).cast("long")
    p = lambda split, carried, source: spark.range(1).select(speakers.provider_boundary(F.lit(split), c(125043), c(125724), *[c(x) for x in carried], F.lit(source)).alias("p")).first().p
    assert tuple(p(False, (120871, 122736), "validated_words")) == (120871, 122736)
    assert tuple(p(False, (None, None), None)) == (125043, 125724)
    assert tuple(p(False, (None, None), "validated_words")) == tuple(p(True, (1, 2), None)) == (None, None)


ISLAND = "programme_id long, sequence_index long, start_ms long, end_ms long, cluster string, is_music boolean, n_words long, text string"
TURNS = "programme_id long, cluster string, start_ms long, end_ms long"


def test_island_at_a_contact_seam(spark):
    df = spark.createDataFrame([(1, 0, 0, 1000, "A", False, 5, "That is it."), (1, 1, 2900, 3200, "A", False, 1, "I"), (1, 2, 3200, 5000, "B", False, 4, "don't know what to say.")], ISLAND)
    got = {r.sequence_index: (r.island, r.suggested) for r in islands.detect_islands(df, spark.createDataFrame([], TURNS)).collect()}
    assert got == {0: (False, None), 1: (True, "B"), 2: (False, None)}


def test_short_answer_is_no_island(spark):
    df = spark.createDataFrame([(1, 0, 0, 1000, "B", False, 5, "Is it?"), (1, 1, 1400, 1700, "A", False, 1, "Yes."), (1, 2, 2200, 5000, "B", False, 4, "Good then.")], ISLAND)
    assert not islands.detect_islands(df, spark.createDataFrame([], TURNS)).filter("island").count()


def test_overlap_is_pulled_back_or_kept(spark):
    schema = "programme_id long, sequence_index long, start_ms long, end_ms long, cluster string, last_word_start long"
    df = spark.createDataFrame([(1, 0, 0, 1100, "A", 800), (1, 1, 1000, 2500, "A", 2000), (1, 2, 1900, 3000, "A", 2600), (1, 3, 2000, 9000, "B", 0), (1, 4, 2995, 3500, "A", 3000)], schema)
    got = sorted(tuple(r) for r in audit.overlap_sweep(df).select("sequence_index", "other_index", "overlap_ms", "repaired").collect())
    assert got == [(1, 0, 100, True), (2, 1, 600, False)]
    assert audit.overlap_sweep(df.limit(0)).count() == 0


def test_words_are_clamped_not_erased(spark):
    w = F.array(*[F.struct(F.lit(a).cast("long").alias("start_ms"), F.lit(b).cast("long").alias("end_ms")) for a, b in ((0, 120), (100, 300), (250, 400))])
    r = spark.range(1).select(audit.clamp_words(w, F.lit(200).cast("long")).alias("c"), audit.would_erase(w, F.lit(200)).alias("x"), audit.would_erase(w, F.lit(260)).alias("y")).first()
    assert [tuple(x) for x in r.c] == [(0, 120), (100, 200), (250, 400)] and r.x and not r.y


def test_flip_twice_is_flip_once(spark):
    active = spark.createDataFrame([(1, "r0", True, None), (2, "r0", True, None)], "row_id long, import_run_id string, is_active boolean, superseded_by string")
    staged = spark.createDataFrame([(2,), (3,), (3,)], "row_id long")
    once = runs.stage_and_flip(active, staged, "r1")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(once) == key(runs.stage_and_flip(once, staged, "r1"))
    assert sorted(r.row_id for r in once.filter("is_active").collect()) == [1, 2, 3]


def test_scalar_rules(spark):
    s = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", s(evidence.deterministic_uuid(F.lit("x"))))
    assert s(evidence.retry_after_ms(F.lit("7"))) == 7000 and s(evidence.retry_after_ms(F.lit("90"))) == 30000 and s(evidence.retry_after_ms(F.lit("soon"))) is None
    now = F.timestamp_seconds(F.lit(1_700_000_000))  # 14 Nov 2023 22:13:20 UTC
    dates = {"Tue, 14 Nov 2023 22:13:25 GMT": 5000, "Tue, 14 Nov 2023 22:13:00 GMT": 0, "Wed, 15 Nov 2023 22:13:00 GMT": 30000}
    assert {d: s(evidence.retry_after_ms(F.lit(d), now)) for d in dates} == dates
    assert [s(evidence.language_code(F.lit(x).cast("string"))) for x in ("en_US", "iw", "pt-BR", "auto", None)] == ["en_us", "he", "pt", None, None]
    assert s(islands.starts_mid_sentence(F.lit("don't"))) and not s(islands.starts_mid_sentence(F.lit("はい"))) and s(islands.ends_sentence(F.lit("«Yes.»")))


def test_words_are_made_once_in_parts_that_grow_with_the_table(spark, tmp_path, monkeypatch):
    text = "one two three four. " * 40
    rows = [(c, t, ("user", "assistant")[t % 2], text) for c in range(60) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    few = D.words(spark, str(tmp_path))
    monkeypatch.setattr(D, "PART_BYTES", 100)
    many = D.words(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() > 4 * few.rdd.getNumPartitions()
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    ids = spark.createDataFrame([(3,), (59,), (99,)], "programme_id long")
    assert sorted(map(tuple, D.words(spark, str(tmp_path), ids).collect())) == sorted(tuple(r) for r in few.collect() if r["programme_id"] in (3, 59))
    monkeypatch.setattr(D, "PART_BYTES", 10**6)
    calls, real = [], D.words
    monkeypatch.setattr(D, "words", lambda *a: calls.append(a) or real(*a))
    for query in (programme.fold_03_repairs, programme.agg_07_run_report):
        calls.clear()
        query(spark, str(tmp_path))
        assert len(calls) == 1


def test_a_sentence_ends_before_any_white_space_as_in_the_sql(spark):
    """White space that trim leaves and a line's end: Spark and DuckDB each saw them in their own way."""
    import duckdb

    from cuelattice.plans import programme_sql

    texts = ["Yes.", "Yes.\n", "Yes.\n\n", "Yes.\xa0", "Yes.”　", "Yes.\t", "Yes\n", "Yes. ", "Yes.)\x85", "Yes.\n)", "Yes", "", " . "]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    got = [r[0] for r in df.orderBy("k").select(islands.ends_sentence(F.col("text"))).collect()]
    sql = re.search(r"(regexp_matches\(regexp_replace\(regexp_replace\(text.*?) es,", programme_sql._ISLANDS).group(1)
    con = duckdb.connect()
    assert got == [con.execute(f"select {sql} from (select ? as text)", [t]).fetchall()[0][0] for t in texts]
    assert got == [True] * 6 + [False] + [True] * 2 + [False] * 3 + [True]
