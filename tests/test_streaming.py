import datetime as dt

from folioflow.streaming.incremental import each_batch, stage_latency_stream, validated_stream


def test_new_bodies_are_judged_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    t = dt.datetime(2026, 1, 1)
    schema = "pdf_id string, run_id string, created_at timestamp, body string"
    spark.createDataFrame([("a", "r", t, "few words"), ("a", "r", t, "few words")], schema).write.parquet(src)
    df = spark.read.parquet(src)
    for _ in range(2):
        validated_stream(spark, src, out, cp, df.schema).awaitTermination()
    assert [(r.pdf_id, r.reason) for r in spark.read.parquet(out).collect()] == [("a", "too_short")]
    spark.createDataFrame([("b", "r", t, None)], schema).write.mode("append").parquet(src)
    validated_stream(spark, src, out, cp, df.schema).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_late_bodies_and_other_bodies_of_one_key_are_judged(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    t = dt.datetime(2026, 1, 1)
    schema = "pdf_id string, run_id string, created_at timestamp, body string"
    batches = [[("a", "r", t, "new")], [("b", "r", t - dt.timedelta(days=40), "late"), ("a", "r", t, "new")], [("a", "r", t, "other words"), ("b", None, None, None), ("b", None, None, None)], [("b", None, None, None), ("c", "r", t - dt.timedelta(days=90), "later")]]
    for batch in batches:
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        validated_stream(spark, src, out, cp, spark.read.parquet(src).schema).awaitTermination()
    rows = sorted((r.pdf_id, r.run_id or "", r.content_words) for r in spark.read.parquet(out).collect())
    assert rows == [("a", "r", 1), ("a", "r", 2), ("b", "", 0), ("b", "r", 1), ("c", "r", 1)]


def test_windowed_latency_and_batches(spark, tmp_path):
    src = str(tmp_path / "s")
    t = dt.datetime(2026, 1, 1, 10, 5)
    spark.createDataFrame([("clean", "ok", 1.0, t), ("clean", "oom", 3.0, t)], "stage string, status string, wall_time_sec double, created_at timestamp").write.parquet(src)
    schema = spark.read.parquet(src).schema
    stage_latency_stream(spark, src, str(tmp_path / "c1"), schema).awaitTermination()
    row = spark.sql("SELECT rows, failed, mean_sec FROM stage_latency").first()
    assert tuple(row) == (2, 1, 2.0)
    seen = []
    each_batch(spark.readStream.schema(schema).parquet(src), lambda b: seen.append(b.count()), str(tmp_path / "c2")).awaitTermination()
    assert seen == [2]


def test_late_rows_count_and_done_batches_are_skipped(spark, tmp_path):
    src, cp = str(tmp_path / "s"), str(tmp_path / "c")
    t = dt.datetime(2026, 1, 1, 10, 5)
    for days in (0, 40, 90):  # each micro-batch is far behind the one before
        spark.createDataFrame([("clean", "ok", 1.0 + days, t - dt.timedelta(days=days)), ("clean", "ok", 3.0, t), ("clean", None, None, None)], "stage string, status string, wall_time_sec double, created_at timestamp").write.mode("append").parquet(src)
        schema = spark.read.parquet(src).schema
        stage_latency_stream(spark, src, cp, schema, "late").awaitTermination()
    rows = {r.hour: (r.rows, r.mean_sec) for r in spark.table("late").collect()}
    assert rows[dt.datetime(2026, 1, 1, 10)] == (4, 2.5) and rows[None] == (3, None) and len(rows) == 4
    seen = []
    work = lambda b: seen.append(b.first().batch_no)
    each_batch(spark.readStream.schema(schema).parquet(src), work, str(tmp_path / "d")).awaitTermination()
    done = len(seen)
    # the same batches under a new checkpoint of the same marks: all are skipped
    import shutil

    shutil.rmtree(tmp_path / "d")
    each_batch(spark.readStream.schema(schema).parquet(src), work, str(tmp_path / "d")).awaitTermination()
    assert done and len(seen) == done
