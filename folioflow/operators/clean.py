"""Cleaning: repeated lines, blocks, scores, title and body, all as array expressions on one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blocks, lines, present, strip, word_count

# Phrases of structural boilerplate.
BOILERPLATE = (
    "cookie", "subscribe", "newsletter", "sign up", "sign in", "log in", "log out", "related articles", "related posts", "you might also like", "read more",
    "share this", "follow us", "all rights reserved", "privacy policy", "terms of service", "terms of use", "advertisement", "skip to content", "skip to main content", "back to top",
)
BODY_SCORE = 15.0
TITLE_WORDS = 15
SHORT_LINE, SHORT_WEIGHT, HIT_WEIGHT = 4, 50, 30


def with_repeated_lines(df: DataFrame, pages: str = "pages", out: str = "removed_lines") -> DataFrame:
    """Adds the sorted distinct lines that stand on more than half of the pages; none for a single page.

    Each page's distinct lines are sorted together once: equal lines are neighbours, so a line that is found again
    ``least`` - 1 places on stands on that many pages.
    """
    per_page = F.transform(pages, lambda p: F.array_distinct(F.filter(F.transform(lines(p), strip), lambda x: x != "")))
    none = F.array().cast("array<string>")
    staged = df.withColumn("_n", F.size(pages)).withColumn("_sorted", F.when(F.col("_n") > 1, F.array_sort(F.flatten(per_page))).otherwise(none))
    least = F.floor(F.col("_n") / 2).cast("int") + 1
    staged = staged.withColumn("_ahead", F.slice("_sorted", least, F.greatest(F.size("_sorted"), F.lit(1))))
    hits = F.filter(F.zip_with("_sorted", "_ahead", lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())
    found = F.when(F.col(pages).isNull(), F.lit(None)).when(F.col("_n") > 1, F.array_distinct(hits)).otherwise(none)
    return staged.withColumn(out, found).drop("_n", "_sorted", "_ahead")


def without_lines(pages: Column, removed: Column) -> Column:
    kept = lambda p: F.array_join(F.filter(lines(p), lambda x: ~F.array_contains(removed, strip(x))), "\n")
    return F.when(F.size(removed) > 0, F.transform(pages, kept)).otherwise(pages)


def page_blocks(pages: Column) -> Column:
    return F.flatten(F.transform(pages, blocks))


def short_line_ratio(block: Column) -> Column:
    filled = F.filter(F.transform(lines(block), strip), lambda x: x != "")
    short = F.size(F.filter(filled, lambda x: word_count(x) <= SHORT_LINE))
    return F.when(F.size(filled) > 0, short / F.size(filled)).otherwise(0.0)


def block_score(block: Column) -> Column:
    return word_count(block).cast("double") - short_line_ratio(block) * SHORT_WEIGHT - F.size(present(block, BOILERPLATE)) * HIT_WEIGHT


def is_title(block: Column) -> Column:
    return ~F.contains(block, F.lit("\n")) & (word_count(block) <= TITLE_WORDS)


def clean(df: DataFrame, pages: str = "pages", title_after_scoring: bool = False) -> DataFrame:
    """Adds title, body, block_count and removed_lines.

    The title is the first block, if it is one short line.  ``title_after_scoring`` looks for it only
    among blocks that aren't boilerplate, so that a menu bar doesn't become the title.
    Null pages give null results; pages without text an empty body.
    """
    staged = with_repeated_lines(df, pages)
    staged = staged.withColumn("_blocks", page_blocks(without_lines(F.col(pages), F.col("removed_lines"))))
    if title_after_scoring:
        staged = staged.withColumn("_blocks", F.filter("_blocks", lambda b: F.size(present(b, BOILERPLATE)) == 0))
    first = F.try_element_at("_blocks", F.lit(1))
    staged = staged.withColumn("title", F.when(is_title(first), first))
    rest = F.when(F.col("title").isNotNull(), F.slice("_blocks", 2, F.greatest(F.size("_blocks"), F.lit(1)))).otherwise(F.col("_blocks"))
    staged = staged.withColumn("_body", F.filter(rest, lambda b: block_score(b) >= BODY_SCORE))
    return staged.withColumn("body", F.array_join("_body", "\n\n")).withColumn("block_count", F.when(F.col("_body").isNotNull(), F.size("_body"))).drop("_blocks", "_body")


def raw_sizes(pages: Column) -> tuple[Column, Column]:
    """(characters, words) of all pages; null for null pages."""
    chars = F.aggregate(pages, F.lit(0), lambda s, p: s + F.length(F.coalesce(p, F.lit(""))))
    words = F.aggregate(pages, F.lit(0), lambda s, p: s + word_count(F.coalesce(p, F.lit(""))))
    return chars, words


def reduction(raw: Column, cleaned: Column) -> Column:
    return F.when(raw > 0, F.bround(100 * (1 - cleaned / raw), 2))
