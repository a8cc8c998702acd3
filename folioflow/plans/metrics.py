"""Run metrics: a row for each stage, a row for each document and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename
from ..operators.clean import raw_sizes, reduction
from ..sources.shared import written
from ..sources.tables import table, write_csv, write_json
from .artifacts import latest
from .harness import environment
from .registry import INFERENCE

STAGE_FIELDS = ("pdf_id", "run_id", "stage", "status", "device", "dtype", "batch_size", "wall_time_sec", "compute_time_sec", "transfer_time_sec", "tokens_in", "tokens_out", "peak_ram_mb", "peak_vram_mb")
KEY = ["pdf_id", "run_id"]


def stage_rows(measured: DataFrame) -> DataFrame:
    """The last measurement of each document's stage in each run."""
    return latest(measured, [*KEY, "stage"]).select(*STAGE_FIELDS)


def stage_times(rows: DataFrame) -> DataFrame:
    """One row for each document and run: the times of its stages side by side, their sums and the peaks."""
    time = lambda s: F.max(F.when(F.col("stage") == s, F.col("wall_time_sec")))
    sums = F.sum(F.when(F.col("stage").isin(*INFERENCE), F.col("wall_time_sec")))
    return rows.groupBy(*KEY).agg(
        F.coalesce(time("extract"), F.lit(0.0)).alias("extraction_time_sec"),
        F.coalesce(time("keywords"), F.lit(0.0)).alias("keyword_time_sec"),
        F.coalesce(time("classify"), F.lit(0.0)).alias("classify_time_sec"),
        F.coalesce(time("summarize"), F.lit(0.0)).alias("summarize_time_sec"),
        F.bround(F.coalesce(sums, F.lit(0.0)), 4).alias("inference_time_sec"),
        F.bround(F.coalesce(F.sum("wall_time_sec"), F.lit(0.0)), 4).alias("total_time_sec"),
        F.max("peak_ram_mb").alias("peak_ram_mb"),
        F.max("peak_vram_mb").alias("peak_vram_mb"),
    )


def document_rows(sources: DataFrame, extracted: DataFrame, cleaned: DataFrame, validated: DataFrame, summarized: DataFrame, measured: DataFrame) -> DataFrame:
    """The documents' metrics; only successful extractions and the last row of each stage count."""
    ok = latest(extracted.where("status = 'ok'"), KEY)
    chars, words = raw_sizes(F.col("pages"))
    raw = ok.select(*KEY, "pages_read", chars.alias("raw_chars"), words.alias("raw_words"))
    body = latest(cleaned, KEY).select(*KEY, F.length(F.coalesce("body", F.lit(""))).alias("clean_chars"))
    judged = latest(validated, KEY).select(*KEY, (F.col("status") == "rejected").alias("rejected"), F.col("reason").alias("reject_reason"))
    said = latest(summarized, KEY).select(*KEY, "prompt_tokens", "generated_tokens", F.col("tokens_per_second").alias("tokens_per_sec"), "summary")
    names = sources.select("pdf_id", basename(F.col("source_path")).alias("pdf_name")).distinct()
    joined = stage_times(stage_rows(measured)).join(raw, KEY, "left").join(body, KEY, "left").join(judged, KEY, "left").join(said, KEY, "left").join(names, "pdf_id", "left")
    return joined.withColumn("reduction_pct", reduction(F.col("raw_chars"), F.col("clean_chars")))


def run_totals(documents: DataFrame) -> DataFrame:
    """Documents and time of each run; one row a run."""
    return documents.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("documents"),
        F.bround(F.sum("total_time_sec"), 2).alias("total_time_sec"),
        F.bround(F.sum("inference_time_sec"), 2).alias("inference_time_sec"),
        F.count_if("rejected").alias("rejected"),
    )


def export(spark: SparkSession, folder: str, target: str) -> dict:
    """Stage and document rows as CSV and the runs' totals as JSON; each device that measured anything has a copy of its own."""
    t = lambda name: table(spark, folder, name)
    stages = written(stage_rows(t("stage_metrics")))
    documents = written(document_rows(t("source_docs"), t("extract_out"), t("clean_out"), t("validate_out"), t("summarize_out"), t("stage_metrics")))
    devices = [r.device for r in stages.select("device").where("device IS NOT NULL").distinct().orderBy("device").collect()]  # a handful
    totals = {}
    for device in [None, *devices]:
        at = target if device is None else f"{target}/{device}"
        mine = stages if device is None else stages.where(F.col("device") == device)
        own = documents if device is None else documents.join(mine.select(*KEY).distinct(), KEY, "left_semi")
        write_csv(mine.orderBy(*KEY, "stage"), f"{at}/stages")
        write_csv(own.orderBy(*KEY), f"{at}/documents")
        totals[device or "all"] = [r.asDict() for r in run_totals(own).orderBy("run_id").collect()]  # one row a run
        write_json(spark, {"runs": totals[device or "all"], "environment": environment(spark)}, f"{at}/metrics.json")
    return totals
