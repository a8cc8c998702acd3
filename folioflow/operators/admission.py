"""Admission of sources, incremental page reading and checks of the single-turn path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import present, strip, tokens, word_count

# Wording of pages that block robots.
BLOCKED = ("access to this page has been denied", "press & hold to confirm", "403: forbidden", "captcha", "access denied", "reference id", "automation tools")
LEAST_BYTES = 1024


def admission(path: Column, size: Column, least: int = LEAST_BYTES) -> Column:
    """The reason to refuse a source, or null."""
    return F.when(path.rlike("^https?://"), "url_not_supported").when(size.isNull(), "file_not_found").when(size < least, "file_too_small")


def is_blocked(text: Column) -> Column:
    return F.size(present(F.coalesce(text, F.lit("")), BLOCKED)) > 0


def missing_fields(*columns: Column) -> Column:
    return F.greatest(*(F.coalesce(c, F.lit("")) == "" for c in columns)) if len(columns) > 1 else F.coalesce(columns[0], F.lit("")) == ""


def label_set(labels: Column) -> Column:
    """Sorted distinct labels, stripped and in lower case, without empty ones."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(labels, lambda x: F.lower(strip(x))), lambda x: x != "")))


def first_words(text: Column, most: int = 1000) -> Column:
    """The text, or its first words joined by one space if it has more than that."""
    return F.when(word_count(text) > most, F.array_join(F.slice(tokens(text), 1, most), " ")).otherwise(text)


def read_until(df: DataFrame, keys: list[str], pages: str = "pages", min_chars: int = 100, min_words: int = 20, max_pages: int = 10) -> DataFrame:
    """(keys, pages_used, chars, words, stop_reason): the first page count at which the text so far is long enough.

    Running sums over the pages, then the least page that meets both limits; nothing is read twice.
    Characters are those of the joined text, line breaks between pages included.
    """
    rows = df.select(*keys, F.posexplode(F.slice(F.col(pages), 1, max_pages)).alias("_i", "_p"), F.size(pages).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_i")
    sums = rows.withColumn("chars", F.sum(F.length(F.coalesce("_p", F.lit("")))).over(w)).withColumn("words", F.sum(word_count(F.coalesce("_p", F.lit("")))).over(w))
    met = (F.col("chars") >= min_chars) & (F.col("words") >= min_words)
    state = F.struct((F.col("_i") + 1).alias("pages_used"), "chars", "words")
    ends = sums.groupBy(*keys).agg(F.min(F.when(met, state)).alias("_met"), F.max(state).alias("_last"), F.max("_n").alias("_n"))
    got = F.coalesce("_met", "_last")
    reason = F.when(F.col("_met").isNotNull(), "threshold_met").when(F.col("_n") >= max_pages, "max_pages_reached").otherwise("no_more_pages")
    return ends.select(*keys, got["pages_used"].alias("pages_used"), got["chars"].alias("chars"), got["words"].alias("words"), reason.alias("stop_reason"))
