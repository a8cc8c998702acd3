"""Micro-batches over a growing folder of documents or of stage rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..operators.validate import validate
from ..sources.tables import exists, write_json


_JUDGED = ["pdf_id", "run_id", "created_at", "body_hash"]


def validated_stream(spark: SparkSession, source: str, target: str, checkpoint: str, schema, config: Config = Config(), once: bool = True) -> StreamingQuery:
    """Judges each new cleaned body as it arrives, however late; exact copies of a row are judged once.

    What was judged is known from the target: a row is new if its key and the hash of its body aren't there yet.  So a
    batch that is replayed adds only what it hadn't written.
    """

    def run(batch: DataFrame, number: int) -> None:
        fresh = batch.withColumn("body_hash", F.sha2("body", 256)).dropDuplicates(_JUDGED)
        known = _written(spark, target)
        if known is not None:
            same = [fresh[c].eqNullSafe(known[c]) for c in _JUDGED]
            fresh = fresh.join(known, reduce(lambda a, b: a & b, same), "left_anti")
        judged = validate(fresh, config).select(*_JUDGED, "content_words", "content_chars", "failure_signal", "unique_word_ratio", "status", "reason")
        judged.write.mode("append").parquet(target)

    rows = spark.readStream.schema(schema).parquet(source)
    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _written(spark: SparkSession, target: str) -> DataFrame | None:
    """The keys of the judged rows, if there are any yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path) or not any(f.getPath().getName().endswith(".parquet") for f in files.listStatus(path)):
        return None
    return spark.read.parquet(target).select(*_JUDGED)


def stage_latency_stream(spark: SparkSession, source: str, checkpoint: str, schema, name: str = "stage_latency", target: str | None = None) -> StreamingQuery:
    """Rows, failures and mean time of each stage by hour, as the view ``name``.  Keeps, for each micro-batch, the counts and sums of its rows by hour and stage, in a folder of the batch's number.

    Sums of sums need no state, so no row is too late; a batch that is replayed overwrites its own folder.
    ``stage_latency`` puts the batches together.
    """
    target = target or f"{checkpoint}-sums"

    def run(batch: DataFrame, number: int) -> None:
        by = [F.date_trunc("hour", "created_at").alias("hour"), "stage"]
        sums = batch.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("status") != "ok").alias("failed"), F.count("wall_time_sec").alias("timed"), F.sum("wall_time_sec").alias("seconds"))
        sums.write.mode("overwrite").parquet(f"{target}/batch={number}")
        stage_latency(spark, target).createOrReplaceTempView(name)

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stage_latency(spark: SparkSession, target: str) -> DataFrame:
    """(hour, stage, rows, failed, mean_sec) over all micro-batches so far."""
    sums = spark.read.parquet(target).groupBy("hour", "stage").agg(*(F.sum(c).alias(c) for c in ("rows", "failed", "timed", "seconds")))
    return sums.select("hour", "stage", "rows", "failed", (F.col("seconds") / F.nullif("timed", F.lit(0))).alias("mean_sec"))


def each_batch(stream: DataFrame, work: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Runs a batch job on every micro-batch; a batch whose number is marked as done beside the checkpoint is skipped."""

    def run(batch: DataFrame, number: int) -> None:
        spark, mark = batch.sparkSession, f"{checkpoint}-done/{number}.json"
        if batch.isEmpty() or exists(spark, mark):
            return
        work(batch.withColumn("batch_no", F.lit(number)))
        write_json(spark, {"batch": number}, mark)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
