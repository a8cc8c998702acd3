"""A bounded context: the sentences that mention a keyphrase, in order, up to a budget of characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mentions, sentences


def within_budget(parts: Column, budget: int) -> Column:
    """The longest prefix whose characters fit the budget; the first part is always in it."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("size"), F.lit(False).alias("over"))

    def add(state: Column, part: Column) -> Column:
        size = state["size"] + F.length(part)
        over = state["over"] | ((F.size(state["kept"]) > 0) & (size > budget))
        return F.when(over, F.struct(state["kept"].alias("kept"), state["size"].alias("size"), F.lit(True).alias("over"))).otherwise(
            F.struct(F.concat(state["kept"], F.array(part)).alias("kept"), size.alias("size"), F.lit(False).alias("over"))
        )

    return F.aggregate(parts, start, add)


def reduce_context(df: DataFrame, budget: int, body: str = "body", phrases: str = "phrases") -> DataFrame:
    """Adds sentences_kept, reduced_context_chars, reduced_context and used_fallback; without a match all sentences are candidates."""
    no_phrases = F.array().cast("array<string>")
    staged = df.withColumn("_all", sentences(F.coalesce(F.col(body), F.lit(""))))
    staged = staged.withColumn("_hit", F.filter("_all", lambda s: mentions(s, F.coalesce(F.col(phrases), no_phrases))))
    staged = staged.withColumn("used_fallback", F.size("_hit") == 0)
    staged = staged.withColumn("_kept", within_budget(F.when(F.col("used_fallback"), F.col("_all")).otherwise(F.col("_hit")), budget))
    return (
        staged.withColumn("sentences_kept", F.size("_kept.kept"))
        .withColumn("reduced_context_chars", F.col("_kept.size"))
        .withColumn("reduced_context", F.array_join("_kept.kept", " "))
        .drop("_all", "_hit", "_kept")
    )
