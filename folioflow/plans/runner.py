"""Running the stages over a corpus: each stage for all documents, results kept as tables."""

from __future__ import annotations

import logging
import statistics
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, new_run_id
from ..models.backends import backend
from ..operators.clean import clean
from ..operators.classify import classify
from ..operators.context import reduce_context
from ..operators.keywords import keyphrases
from ..operators.summarize import summarize
from ..operators.validate import validate
from ..sources.corpus import extract, hashed, listing, select_documents
from ..sources.tables import quarantine, replace, upsert, write_json
from .artifacts import FINGERPRINTS, fingerprints, index_status, split_cached
from .harness import PeakMemory, environment
from .registry import STAGES, select

LOG = logging.getLogger("folioflow")


@dataclass
class Run:
    run_id: str
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    peak_mb: dict[str, float] = field(default_factory=dict)


def _compute(name: str, documents: DataFrame, done: dict[str, DataFrame], config: Config) -> DataFrame:
    """The stage's results as (doc_id, status, error, payload columns)."""
    ids, models = documents.select("doc_id"), backend(config.backend)
    if name == "extract":
        return extract(documents, config.max_pages)
    ok = {k: v.where("status = 'ok'").join(ids, "doc_id", "left_semi") for k, v in done.items()}
    good = lambda df: df.withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))
    spread = lambda df: df.repartition(config.workers, "doc_id") if config.workers > 1 else df  # noqa: E731 - as many tasks call a model
    if name == "clean":
        return good(clean(ok["extract"].select("doc_id", "pages")).select("doc_id", "title", "body", "block_count", "removed_lines"))
    if name == "validate":
        judged = validate(ok["clean"].select("doc_id", "body"), config).withColumnRenamed("status", "verdict").drop("body")
        return good(judged)
    bodies = ok["clean"].select("doc_id", "body").join(ok["validate"].where("verdict = 'accepted'").select("doc_id"), "doc_id", "left_semi")
    if name == "keywords":
        return good(keyphrases(spread(bodies), "doc_id", backend=models.encoder))
    if name == "classify":
        return good(classify(spread(bodies), config, "doc_id", backend=models.scorer))
    if name == "context":
        phrases = ok["keywords"].select("doc_id", F.transform("keywords", lambda k: k["phrase"]).alias("phrases"))
        return good(reduce_context(bodies.join(phrases, "doc_id"), config.reduced_context_chars).drop("body", "phrases"))
    said = summarize(spread(ok["context"].select("doc_id", "reduced_context")), config, backend=models.generator).drop("reduced_context")
    return said.withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("error"))


def sources(spark: SparkSession, corpus: str, store: str) -> DataFrame:
    """The source dimension (doc_id, path, sha256, bytes, modified): only files that are new or changed since it was written are read and hashed."""
    path, files = f"{store}/sources", listing(spark, corpus)
    known = _existing(spark, path)
    if known is not None:
        files = files.join(known.select("path", "bytes", "modified"), ["path", "bytes", "modified"], "left_anti")
    hashed(files).write.mode("append").parquet(path)
    there = listing(spark, corpus).select("path", "bytes", "modified")
    return spark.read.parquet(path).join(there, ["path", "bytes", "modified"], "left_semi").dropDuplicates(["path"])


def documents_of(found: DataFrame, config: Config, wanted: str | None) -> DataFrame:
    """(doc_id, path, sha256, bytes), one row for each content, by the first of its paths."""
    if wanted:
        found = select_documents(found, wanted)
    documents = found.groupBy("doc_id").agg(F.min(F.struct("path", "sha256", "bytes")).alias("f")).select("doc_id", "f.*")
    return documents.orderBy("path").limit(config.max_pdfs) if config.max_pdfs > 0 else documents


def run(spark: SparkSession, corpus: str, store: str, config: Config = Config(), only: list[str] | None = None, through: str | None = None, wanted: str | None = None, force: bool = False, run_id: str | None = None) -> Run:
    """One pass.  A document's stage is computed only if no successful result with the same three fingerprints is there.

    Documents that were rejected or failed leave the later stages out.  Each stage's new results are appended to
    its own table before the next stage reads them, so nothing is computed twice and a lost executor costs one stage.
    Files are read for their hash when they are new, and once more for extraction; their content is never shuffled.
    """
    stages, forced = select(only, through)
    out = Run(run_id or new_run_id())
    LOG.debug("run %s: %s", out.run_id, config.snapshot())
    documents = documents_of(sources(spark, corpus, store), config, wanted)
    # the run's own documents, kept: every stage below reads this small table
    at = f"{store}/documents/run_id={out.run_id}"
    documents.write.mode("overwrite").parquet(at)
    documents = spark.read.schema(documents.schema).parquet(at)
    total = documents.count()
    if wanted and not total:
        raise ValueError(f"no document matches {wanted!r}")
    prints = fingerprints(documents.select("doc_id", "sha256"), config, "doc_id")
    done: dict[str, DataFrame] = {}
    for stage in stages:
        began = time.monotonic()
        path = f"{store}/{stage.name}"
        mine = prints.where(F.col("stage") == stage.name).select("doc_id", "stage", *FINGERPRINTS)
        existing = _existing(spark, path)
        todo, reuse = (mine, mine.limit(0)) if existing is None or force or stage.name in forced else split_cached(mine, existing.withColumn("stage", F.lit(stage.name)), "doc_id")
        open_ids = _open_documents(documents.select("doc_id"), done)
        todo = todo.join(open_ids, "doc_id", "left_semi")
        work = documents.join(todo.select("doc_id"), "doc_id", "left_semi")
        tags = {"stage_version": F.lit(STAGES[stage.name].version), "run_id": F.lit(out.run_id), "created_at": F.current_timestamp(), "batch": F.lit(uuid.uuid4().hex)}
        with PeakMemory() as memory:
            _compute(stage.name, work, done, config).join(todo.drop("stage"), "doc_id").withColumns(tags).write.mode("append").parquet(path)
        every = spark.read.parquet(path)
        newest = every.join(mine.drop("stage"), ["doc_id", *FINGERPRINTS], "left_semi").groupBy("doc_id").agg(F.max_by("batch", "created_at").alias("batch"))
        done[stage.name] = every.join(newest, ["doc_id", "batch"], "left_semi")
        used = reuse.join(open_ids, "doc_id", "left_semi").select("doc_id", "stage").withColumn("run_id", F.lit(out.run_id))
        used.write.mode("append").partitionBy("run_id").parquet(f"{store}/cached")
        fresh = every.where(F.col("run_id") == out.run_id)
        quarantine(fresh.select("doc_id", F.lit(stage.name).alias("stage"), "run_id", "status", "error", (F.col("status") != "ok").alias("failed")), "failed", f"{store}/quarantine")
        tally = fresh.agg(F.count_if(F.col("status") == "ok").alias("computed"), F.count_if(F.col("status") != "ok").alias("errors")).first()
        cached = used.count()
        out.counts[stage.name] = {"computed": tally.computed, "cached": cached, "errors": tally.errors, "skipped": total - tally.computed - tally.errors - cached}
        out.seconds[stage.name] = round(time.monotonic() - began, 4)
        out.peak_mb[stage.name] = round(memory.peak_mb, 1)
        LOG.info("%s: %s in %.1f s", stage.name, out.counts[stage.name], out.seconds[stage.name])
    _update_index(spark, store, out.run_id, documents, done)
    summary = {"run_id": out.run_id, "config": config.settings(), "stages": out.counts, "seconds": out.seconds, "peak_mb": out.peak_mb, "environment": environment(spark)}
    write_json(spark, summary, f"{store}/runs/{out.run_id}.json")
    return out


def _update_index(spark: SparkSession, store: str, run_id: str, documents: DataFrame, done: dict[str, DataFrame]) -> None:
    """The index (doc_id, path, bytes, page_count, status, run_id) with this run's documents put in; its rows by document."""
    pages = done["extract"].select("doc_id", F.col("pages_total").alias("page_count"))
    failed = [d.select("doc_id", "status") for d in done.values()]
    broken = failed[0]
    for one in failed[1:]:
        broken = broken.unionByName(one)
    verdicts = done["validate"].select("doc_id", F.col("verdict").alias("status")) if "validate" in done else pages.select("doc_id", F.lit("extracted").alias("status"))
    status = index_status(verdicts, broken, "doc_id")
    new = documents.join(pages, "doc_id", "left").join(status, "doc_id", "left").select("doc_id", "path", "bytes", "page_count", "status", F.lit(run_id).alias("run_id"))
    old = _existing(spark, f"{store}/index")
    merged = new if old is None else upsert(old, new, ["doc_id"])
    merged.orderBy("doc_id").write.mode("overwrite").parquet(f"{store}/index-next")
    replace(spark, f"{store}/index-next", f"{store}/index")


def index(spark: SparkSession, store: str) -> DataFrame:
    """The index of a store, by document; empty where no run has been."""
    found = _existing(spark, f"{store}/index")
    return spark.createDataFrame([], "doc_id string, path string, bytes bigint, page_count int, status string, run_id string") if found is None else found.orderBy("doc_id")


def compact(spark: SparkSession, store: str) -> dict[str, int]:
    """Leaves, of each stage's table, the last result of each document and fingerprints; returns the rows left."""
    left = {}
    for name in STAGES:
        rows = _existing(spark, f"{store}/{name}")
        if rows is None:
            continue
        keys = ["doc_id", *FINGERPRINTS]
        last = rows.groupBy(*keys).agg(F.max_by("batch", "created_at").alias("batch"))
        rows.join(last, [*keys, "batch"], "left_semi").write.mode("overwrite").parquet(f"{store}/{name}-next")
        replace(spark, f"{store}/{name}-next", f"{store}/{name}")
        left[name] = spark.read.parquet(f"{store}/{name}").count()
    return left


def measured(spark: SparkSession, corpus: str, store: str, config: Config = Config(), warm_up: int = 1, runs: int = 3) -> dict[str, float]:
    """Median seconds of each stage over forced runs, after a warm-up whose times don't count."""
    passes = [run(spark, corpus, store, config, force=True, run_id=f"{new_run_id()}-{i}") for i in range(warm_up + runs)][warm_up:]
    return {name: round(statistics.median(p.seconds[name] for p in passes), 4) for name in passes[0].seconds}


def by_protocol(spark: SparkSession, corpus: str, store: str, config: Config = Config(), **options) -> dict:
    """Protocol A is one pass that reuses what it can; B a warm-up and three forced passes, of which the medians count."""
    if config.protocol.upper() == "B":
        seconds = measured(spark, corpus, store, config)
        write_json(spark, {"protocol": "B", "config": config.settings(), "median_seconds": seconds, "environment": environment(spark)}, f"{store}/runs/protocol-b-{new_run_id()}.json")
        return {"protocol": "B", "seconds": seconds}
    if config.protocol.upper() != "A":
        raise ValueError(f"no protocol {config.protocol!r}; there are A and B")
    done = run(spark, corpus, store, config, **options)
    return {"protocol": "A", "run_id": done.run_id, "stages": done.counts, "seconds": done.seconds}


def results(spark: SparkSession, store: str) -> DataFrame:
    """(doc_id, rejected, predicted_label, phrases) of a store's last successful results, for comparing runs."""
    last = lambda name, *c: spark.read.parquet(f"{store}/{name}").where("status = 'ok'").groupBy("doc_id").agg(*(F.max_by(x, "created_at").alias(x) for x in c))
    labels = last("classify", "predicted_label") if _existing(spark, f"{store}/classify") is not None else None
    rows = last("validate", "verdict").select("doc_id", (F.col("verdict") == "rejected").alias("rejected"))
    phrases = last("keywords", "keywords").select("doc_id", F.transform("keywords", lambda k: k["phrase"]).alias("phrases"))
    rows = rows.join(phrases, "doc_id", "left")
    return rows.join(labels, "doc_id", "left") if labels is not None else rows.withColumn("predicted_label", F.lit(None).cast("string"))


def run_report(spark: SparkSession, store: str, run_id: str) -> DataFrame:
    """One row for each document of a run, by document: its verdict, labels, phrases and summary, and which of its stages came from the cache."""
    documents = spark.read.parquet(f"{store}/documents/run_id={run_id}").select("doc_id", "path")
    payloads = {"extract": ["pages_total", "pages_read"], "validate": ["verdict", "reason"], "keywords": ["keywords"], "classify": ["predicted_label", "confidence"], "summarize": ["summary"]}
    for name, columns in payloads.items():
        rows = _existing(spark, f"{store}/{name}")
        if rows is not None:
            last = rows.where("status = 'ok'").groupBy("doc_id").agg(*(F.max_by(c, "created_at").alias(c) for c in columns))
            documents = documents.join(last, "doc_id", "left")
    cached = _existing(spark, f"{store}/cached")
    used = spark.createDataFrame([], "doc_id string, stage string") if cached is None else cached.where(F.col("run_id") == run_id).select("doc_id", "stage")
    stages = used.groupBy("doc_id").agg(F.sort_array(F.collect_set("stage")).alias("cached_stages"))
    none = F.array().cast("array<string>")
    return documents.join(stages, "doc_id", "left").withColumn("cached_stages", F.coalesce("cached_stages", none)).orderBy("doc_id")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _open_documents(ids: DataFrame, done: dict[str, DataFrame]) -> DataFrame:
    """Documents that no stage so far has failed on or rejected."""
    for found in done.values():
        shut = F.col("status") != "ok"
        if "verdict" in found.columns:
            shut = shut | (F.col("verdict") == "rejected")
        ids = ids.join(found.where(shut).select("doc_id"), "doc_id", "left_anti")
    return ids
