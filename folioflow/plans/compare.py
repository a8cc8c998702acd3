"""Comparison of runs over their common documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.bround(F.size(F.array_intersect(a, b)) / union, 3))


def diff(left: DataFrame, right: DataFrame, key: str = "pdf_id") -> DataFrame:
    """(key, status and label changes, jaccard of the keyphrases; null where neither side has any)."""
    a, b = left.alias("l"), right.alias("r")
    none = F.array().cast("array<string>")
    lk, rk = F.coalesce("l.phrases", none), F.coalesce("r.phrases", none)
    return a.join(b, key).select(
        key,
        (~F.col("l.rejected").eqNullSafe(F.col("r.rejected"))).alias("status_changed"),
        (~F.col("l.predicted_label").eqNullSafe(F.col("r.predicted_label"))).alias("label_changed"),
        F.when((F.size(lk) > 0) | (F.size(rk) > 0), jaccard(lk, rk)).alias("keyphrase_jaccard"),
    )


def adjacent(rows: DataFrame, key: str = "pdf_id", run: str = "run_id") -> DataFrame:
    """Each document's run beside its next one: (key, left_run, right_run, changes, jaccard)."""
    w = Window.partitionBy(key).orderBy(run)
    mine = F.struct("rejected", "predicted_label", "phrases")
    pairs = rows.select(key, F.col(run).alias("left_run"), F.lead(run).over(w).alias("right_run"), mine.alias("l"), F.lead(mine).over(w).alias("r")).where("right_run IS NOT NULL")
    none = F.array().cast("array<string>")
    lk, rk = F.coalesce("l.phrases", none), F.coalesce("r.phrases", none)
    return pairs.select(
        key,
        "left_run",
        "right_run",
        (~F.col("l.rejected").eqNullSafe(F.col("r.rejected"))).alias("status_changed"),
        (~F.col("l.predicted_label").eqNullSafe(F.col("r.predicted_label"))).alias("label_changed"),
        F.when((F.size(lk) > 0) | (F.size(rk) > 0), jaccard(lk, rk)).alias("keyphrase_jaccard"),
    )
