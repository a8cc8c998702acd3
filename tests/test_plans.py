import datetime as dt

from pyspark.sql import functions as F

from folioflow.operators.admission import admission, first_words, label_set, missing_fields, read_until
from folioflow.operators.classify import best_label, weighted_means
from folioflow.operators.topk import nearest
from folioflow.plans import artifacts, compare
from folioflow.plans.harness import PeakMemory, environment, timed
from folioflow.sources.tables import flat, patch, read_or_empty, upsert


def test_failures_are_never_reused(spark):
    prints = artifacts.fingerprints(spark.createDataFrame([("d1", "s1"), ("d2", "s2")], "pdf_id string, sha256 string"))
    extract = prints.where("stage = 'extract'")
    kept = extract.withColumn("status", F.when(F.col("pdf_id") == "d1", "ok").otherwise("oom"))
    todo, reuse = artifacts.split_cached(extract, kept)
    assert [r.pdf_id for r in todo.collect()] == ["d2"] and [r.pdf_id for r in reuse.collect()] == ["d1"]


def test_a_changed_source_changes_every_identity(spark):
    rows = artifacts.fingerprints(spark.createDataFrame([("d1", "s1"), ("d1", "s2")], "pdf_id string, sha256 string"))
    assert rows.groupBy("stage").agg(F.count_distinct("identity").alias("n")).where("n <> 2").count() == 0
    assert rows.select("identity").distinct().count() == 14


def test_latest_settles_ties(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", t, 1), ("a", t, 2), ("a", None, 3), ("b", None, None)], "k string, created_at timestamp, v int")
    assert {(r.k, r.v) for r in artifacts.latest(df, ["k"]).collect()} == {("a", 2), ("b", None)}


def test_medians_ignore_null(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0, None), ("a", 2.0, None, None), ("a", 4.0, 7.0, None)], "k string, wall_time_sec double, peak_ram_mb double, peak_vram_mb double")
    r = artifacts.median_timings(df, ["k"]).first()
    assert (r.wall_time_sec, r.peak_ram_mb, r.peak_vram_mb) == (2.0, 6.0, None)


def test_index_status(spark):
    verdicts = spark.createDataFrame([("a", "accepted"), ("b", "rejected")], "pdf_id string, status string")
    stages = spark.createDataFrame([("b", "error"), ("c", "oom"), ("a", "ok")], "pdf_id string, status string")
    assert {(r.pdf_id, r.status) for r in artifacts.index_status(verdicts, stages).collect()} == {("a", "accepted"), ("b", "error"), ("c", "error")}


def test_jaccard_and_adjacent_runs(spark):
    df = spark.createDataFrame([("d", "r1", False, "x", ["a", "b"]), ("d", "r2", True, None, ["b", "c"]), ("d", "r3", True, None, None), ("e", "r1", True, None, None)], "pdf_id string, run_id string, rejected boolean, predicted_label string, phrases array<string>")
    rows = [(r.left_run, r.status_changed, r.label_changed, r.keyphrase_jaccard) for r in compare.adjacent(df).orderBy("left_run").collect()]
    assert rows == [("r1", True, True, 0.333), ("r2", False, False, 0.0)]


def test_upsert_and_patch(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c", "z"), (3, "d", "q")], "k int, v string, w string")
    assert {tuple(r) for r in upsert(old, new, ["k"]).collect()} == {(1, "a", "x"), (2, "c", "z"), (3, "d", "q")}
    assert {tuple(r) for r in patch(old, new, ["k"], ["v"]).collect()} == {(1, "a", "x"), (2, "c", "y")}


def test_missing_table_is_empty(spark, tmp_path):
    schema = spark.createDataFrame([(1, [1])], "k int, a array<int>").schema
    assert read_or_empty(spark, str(tmp_path / "no"), schema).count() == 0
    assert flat(spark.createDataFrame([(1, [1])], schema)).first().a == "[1]"


def test_weighted_means_and_ties(spark):
    rows = spark.createDataFrame([("d", "a", 0.2, 1), ("d", "a", 0.6, 3), ("d", "b", 0.5, 4), ("e", "a", 0.9, 0), ("e", "b", 0.1, 0)], "d string, l string, s double, w int")
    means = weighted_means(rows, ["d"], "l", "s", "w", 0.5)
    assert {(r.d, r.l): round(r.s, 6) for r in means.collect()} == {("d", "a"): 0.5, ("d", "b"): 0.5, ("e", "a"): 0.5, ("e", "b"): 0.5}
    assert {r.l for r in best_label(means, ["d"], "l", "s", ("b", "a")).collect()} == {"b"}


def test_admission(spark):
    df = spark.createDataFrame([("http://x", 9), ("a", None), ("b", 10), ("c", 5000)], "p string, n long")
    assert [r.r for r in df.select(admission(F.col("p"), F.col("n")).alias("r")).collect()] == ["url_not_supported", "file_not_found", "file_too_small", None]
    df = spark.createDataFrame([("x", None), ("x", ""), ("x", "y")], "a string, b string")
    assert [r.m for r in df.select(missing_fields(F.col("a"), F.col("b")).alias("m")).collect()] == [True, True, False]


def test_reading_until_enough(spark):
    df = spark.createDataFrame([("a", ["x", "word " * 30, "z"]), ("b", ["x", "y"]), ("c", ["q"] * 12), ("d", [])], "k string, pages array<string>")
    got = {r.k: (r.pages_used, r.stop_reason) for r in read_until(df, ["k"]).collect()}
    assert got == {"a": (2, "threshold_met"), "b": (2, "no_more_pages"), "c": (10, "max_pages_reached")}


def test_labels_and_heads(spark):
    df = spark.createDataFrame([([" B", "a", "A ", ""], "one  two three")], "l array<string>, t string")
    r = df.select(label_set(F.col("l")).alias("l"), first_words(F.col("t"), 2).alias("h"), first_words(F.col("t"), 3).alias("w")).first()
    assert (r.l, r.h, r.w) == (["a", "b"], "one two", "one  two three")


def test_nearest_is_exact_in_blocks(spark):
    import numpy as np

    m = np.random.default_rng(1).normal(size=(80, 6)).round(2)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(99, None)], "id int, v array<double>")
    got = {}
    for r in nearest(df, df.where("id % 20 = 0"), "id", "v", 3, block=2).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.id
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(0, 80, 20):
        s = u @ u[q]
        s[q] = -9
        assert [got[q][k] for k in (1, 2, 3)] == list(np.argsort(-s)[:3])


def test_harness(spark):
    result = timed(lambda: spark.range(10), 0, 2)
    assert len(result["seconds"]) == 2 and result["peak_ram_mb"] > 0
    assert environment()["packages"]["pyspark"]
    with PeakMemory() as m:
        pass
    assert m.peak_mb > 0


def test_nearest_by_tiles_equals_one_scan(spark, monkeypatch):
    import numpy as np

    from folioflow.operators import topk

    m = np.random.default_rng(2).normal(size=(60, 4)).round(1)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(60, [float(x) for x in m[0]]), (61, [0.0] * 4)], "id int, v array<double>")
    asked = df.where("id % 20 = 0")
    rows = lambda **o: sorted((r.query_id, r.rank, r.id, round(r.score, 9)) for r in nearest(df, asked, "id", "v", 3, **o).collect())
    monkeypatch.setattr(topk, "TILE", 25)
    assert rows() == rows(block=2) == rows(sent_bytes=0)
    assert nearest(df, df.where("id < 0"), "id", "v", 3).count() == 0
