"""Acceptance of a cleaned body by ordered rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import ascii_words, first_present, strip

# Phrases of bot checks and interstitial pages, in order of precedence.
FAILURES = (
    "checking your browser before accessing", "please enable cookies and reload the page", "attention required", "verify you are a human",
    "enable javascript and cookies to continue", "ray id", "one more step", "sorry, you have been blocked",
)
LEAST_DIVERSITY = 0.3


def validate(df: DataFrame, config: Config = Config(), body: str = "body") -> DataFrame:
    """Adds content_words, content_chars, failure_signal, unique_word_ratio, status and reason; a null body counts as empty."""
    text = F.coalesce(F.col(body), F.lit(""))
    staged = df.withColumn("_words", ascii_words(text))
    ratio = F.when(F.size("_words") > 0, F.size(F.array_distinct("_words")) / F.size("_words")).otherwise(0.0)
    staged = (
        staged.withColumn("content_words", F.size("_words"))
        .withColumn("content_chars", F.length(strip(text)))
        .withColumn("failure_signal", first_present(text, FAILURES))
        .withColumn("_ratio", ratio)
        .drop("_words")
    )
    reason = (
        F.when(F.col("failure_signal").isNotNull(), "failure_signal")
        .when((F.col("content_words") > 0) & (F.col("_ratio") < LEAST_DIVERSITY), "low_unique_word_ratio")
        .when(F.col("content_words") < config.min_words, "too_short")
    )
    if config.min_chars > 0:
        reason = reason.when(F.col("content_chars") < config.min_chars, "too_short")
    staged = staged.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
    return staged.withColumn("unique_word_ratio", F.bround("_ratio", 4)).drop("_ratio")
