"""Artifacts: stage results with three fingerprints, what of them can be reused, and how they are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from .registry import STAGES, Stage

FAILED = ("error", "oom")
FINGERPRINTS = ("input_fingerprint", "config_fingerprint", "code_fingerprint")


def input_fingerprint(source_sha256: Column, upstream: Column) -> Column:
    """Of the source and the sorted identities of what a stage needs."""
    return F.sha2(F.array_join(F.concat(F.array(source_sha256), F.sort_array(upstream)), "|"), 256)


def identity(*fingerprints: Column) -> Column:
    return F.sha2(F.concat_ws("|", *fingerprints), 256)


def fingerprints(sources: DataFrame, config: Config = Config(), key: str = "pdf_id", sha: str = "sha256") -> DataFrame:
    """(key, stage, three fingerprints, identity) of every stage of every source; one row of expressions, no shuffle."""
    known: dict[str, Column] = {}
    rows = []
    for stage in _order():
        upstream = F.array(*(known[n] for n in stage.needs)) if stage.needs else F.array().cast("array<string>")
        own, cfg, code = input_fingerprint(F.col(sha), upstream), F.lit(config.fingerprint(stage.config_keys)), F.lit(stage.code_fingerprint())
        known[stage.name] = identity(own, cfg, code)
        rows.append(F.struct(F.lit(stage.name).alias("stage"), own.alias("input_fingerprint"), cfg.alias("config_fingerprint"), code.alias("code_fingerprint"), known[stage.name].alias("identity")))
    return sources.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*")


def _order() -> list[Stage]:
    from .registry import ordered

    return ordered()


def split_cached(wanted: DataFrame, existing: DataFrame, key: str = "pdf_id") -> tuple[DataFrame, DataFrame]:
    """(to compute, to reuse): an artifact is reused if it didn't fail and all three fingerprints are the same."""
    usable = existing.where(~F.col("status").isin(*FAILED)).select(key, "stage", *FINGERPRINTS).distinct()
    on = [key, "stage", *FINGERPRINTS]
    return wanted.join(usable, on, "left_anti"), wanted.join(usable, on, "left_semi")


def latest(rows: DataFrame, keys: list[str], at: str = "created_at") -> DataFrame:
    """The last row of each key; exact copies count once, and rows of one time are settled by their other columns."""
    others = [F.col(c) for c in rows.columns if c not in {*keys, at} and not _nested(rows, c)]
    w = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), *(c.desc_nulls_last() for c in others))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _nested(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("array", "map", "struct")


def counters(rows: DataFrame) -> DataFrame:
    """(stage, computed, errors) and a row of totals with a null stage."""
    return rows.rollup("stage").agg(F.count_if(~F.col("status").isin(*FAILED)).alias("computed"), F.count_if(F.col("status").isin(*FAILED)).alias("errors"))


def index_status(validated: DataFrame, failed: DataFrame, key: str = "pdf_id") -> DataFrame:
    """(key, status): accepted, rejected or, for a document that failed in any stage, error."""
    broken = failed.where(F.col("status").isin(*FAILED)).select(key).distinct().withColumn("_broken", F.lit(True))
    judged = validated.select(key, F.col("status").alias("_status"))
    return judged.join(broken, key, "full").select(key, F.when(F.col("_broken"), "error").otherwise(F.col("_status")).alias("status"))


def median_timings(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Medians over repeated runs; null measurements don't count, and all null stay null."""
    # through a decimal, so that the half between two measurements is rounded as written
    half = lambda c, d: F.bround(F.expr(f"cast(percentile({c}, 0.5) AS decimal(20, 6))"), d).cast("double").alias(c)
    return rows.groupBy(*keys).agg(half("wall_time_sec", 4), half("peak_ram_mb", 1), half("peak_vram_mb", 1))


def stages() -> dict[str, Stage]:
    return STAGES
