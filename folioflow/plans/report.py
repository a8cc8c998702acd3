"""Reports rebuilt from the stage tables, without any model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename
from .artifacts import latest

KEY = ["pdf_id", "run_id"]


def report_rows(sources: DataFrame, extracted: DataFrame, validated: DataFrame, documents: DataFrame) -> DataFrame:
    """One row for each document and run, ordered fields; values of stages that weren't successful are null."""
    ok = latest(extracted.where("status = 'ok'"), KEY).select(*KEY, "pages_total", "pages_read")
    judged = latest(validated, KEY).select(*KEY, "status", "reason", "signals")
    model = latest(documents, KEY, at="run_id").select(*KEY, "predicted_label", "confidence", "keywords", "chunk_count")
    index = sources.select("pdf_id", basename(F.col("source_path")).alias("file"), F.col("page_count")).distinct()
    joined = judged.join(ok, KEY, "left").join(model, KEY, "left").join(index, "pdf_id", "left")
    return joined.withColumn("pages_total", F.coalesce("pages_total", "page_count")).drop("page_count")


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON object a row; null fields are left out."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("value"))


def run_mode(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", F.concat_ws("-", "backend", "device").alias("mode"))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.agg(F.max("run_id").alias("run_id"))
