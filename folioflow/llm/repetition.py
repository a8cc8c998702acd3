"""Problem 5: repeated content inside one document, as a rule bitmask ledger.

Every rule is evaluated once per text; the ledger keeps the measurements and one
bit for each rule that failed.  Policies are versioned bit masks over that
ledger, so a changed policy, or the effect of leaving a rule out, is a bitwise
aggregation of its compact rows; where the ledger is kept as a table (``written``),
no text is read again.

The measure behind ``copied_share``: letters and digits, case folded, in
stretches of at least 40 of them (15 where Chinese or Japanese prevails) that
already stood earlier in the text; a stretch may overlap its earlier copy.

Defined cases: null and empty texts have no ledger row; a text without letters
or digits has shares of 0; rows repeated in the table give one ledger row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_table, code_points, frame, read, strings, texts_of, window_hashes, written

STRETCH, STRETCH_CJK = 40, 15

#: name, threshold (a rule fails at or above it); the place in the list is the rule's bit
RULES = (
    ("copied_share", 0.40),
    ("line_share", 0.30),
    ("paragraph_share", 0.30),
    ("sentence_share", 0.30),
    ("top_fourgram_share", 0.20),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: version -> (rules any of which rejects)
POLICIES = {
    "copied-v1": BIT["copied_share"],
    "lines-v1": BIT["line_share"] | BIT["paragraph_share"],
    "all-v1": sum(BIT.values()),
}

_SENTENCE = re.compile(r"[.!?]+\s+|[。！？।]|\n")
_PARAGRAPH = re.compile(r"\n\s*\n")


def _cjk(codes: np.ndarray) -> np.ndarray:
    return ((codes >= 0x3040) & (codes <= 0x30FF)) | ((codes >= 0x3400) & (codes <= 0x9FFF)) | ((codes >= 0xF900) & (codes <= 0xFAFF)) | ((codes >= 0x20000) & (codes <= 0x3134F))


def copied_share(text: str) -> float:
    codes = code_points(text.lower())
    codes = codes[alnum_table()[codes]]
    if not len(codes):
        return 0.0
    width = STRETCH_CJK if _cjk(codes).mean() >= 0.3 else STRETCH
    hashes = window_hashes(codes, width)
    if len(hashes) < 2:
        return 0.0
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    later = np.zeros(len(hashes), bool)
    later[order[1:]] = ranked[1:] == ranked[:-1]  # the sort is stable: the first of equals is the earliest
    if not later.any():
        return 0.0
    change = np.zeros(len(codes) + 1, np.int64)
    at = np.flatnonzero(later)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    return float((np.cumsum(change[:-1]) > 0).mean())


def _repeated(parts: list[str]) -> float:
    """Share of the characters in parts that already occurred."""
    seen, again, total = set(), 0, 0
    for part in parts:
        part = part.strip()
        if part:
            total += len(part)
            if part in seen:
                again += len(part)
            seen.add(part)
    return again / total if total else 0.0


def _top_fourgram(text: str) -> float:
    """Share of the words that the most frequent sequence of four words covers."""
    words = text.lower().split()
    if len(words) < 8:
        return 0.0
    counts: dict[tuple, int] = {}
    for gram in zip(words, words[1:], words[2:], words[3:]):
        counts[gram] = counts.get(gram, 0) + 1
    top = max(counts.values())
    return min(1.0, top * 4 / len(words)) if top > 1 else 0.0


def measure(text: str) -> tuple[float, ...]:
    return (
        copied_share(text),
        _repeated(text.split("\n")),
        _repeated(_PARAGRAPH.split(text)),
        _repeated(_SENTENCE.split(text)),
        _top_fourgram(text),
    )


def failures(values: tuple[float, ...]) -> int:
    return sum(1 << i for i, ((_, limit), value) in enumerate(zip(RULES, values)) if value >= limit)


def ledger(texts: DataFrame, key: str = "pdf_id") -> DataFrame:
    """(key, failed bits, one column for each measurement) of the column ``text``."""
    names = [key, "failed", *(name for name, _ in RULES)]
    types = [pa.string(), pa.int64(), *[pa.float64()] * len(RULES)]

    def run(it):
        for batch in it:
            rows = [(k, *measure(t)) for k, t in zip(strings(batch, key), strings(batch, "text")) if t]
            columns = list(zip(*((r[0], failures(r[1:]), *r[1:]) for r in rows))) or [[] for _ in names]
            yield frame(names, columns, types)

    schema = f"{key} string, failed bigint, " + ", ".join(f"{name} double" for name, _ in RULES)
    return texts.select(key, "text").mapInArrow(run, schema)


def apply_policy(rows: DataFrame, version: str) -> DataFrame:
    return rows.where(F.col("failed").bitwiseAND(F.lit(POLICIES[version])) != 0)


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: how many rows it fails, and how many only it rejects (those a policy without it would admit)."""
    mask = POLICIES[version]
    parts = [(name, bit) for name, bit in BIT.items() if bit & mask]
    hit = F.col("failed").bitwiseAND(F.lit(mask))
    counts = rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(hit != 0).alias("rejected"),
        *(F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias(f"failed_{name}") for name, bit in parts),
        *(F.count_if(hit == bit).alias(f"only_{name}") for name, bit in parts),
    )
    rule = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"failed_{name}").alias("failed"), F.col(f"only_{name}").alias("only_this")) for name, _ in parts)))
    return counts.select("records", "rejected", rule.alias("r")).select("r.rule", "r.failed", "r.only_this", "records", "rejected")


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts_of(read(spark, sf_dir, "clean_out"), ["pdf_id"], "body")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of which at least 40 % repeats earlier text."""
    return apply_policy(ledger(_bodies(spark, sf_dir)), "copied-v1").select("pdf_id").distinct()


def p5_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger beside the ratio that the old validation gives."""
    old = read(spark, sf_dir, "validate_out").groupBy("pdf_id").agg(F.min("signals.unique_word_ratio").alias("unique_word_ratio"))
    shares = [F.round(name, 6).alias(name) for name, _ in RULES]
    return ledger(_bodies(spark, sf_dir)).distinct().join(old, "pdf_id", "left").select("pdf_id", "failed", *shares, "unique_word_ratio")


def p5_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the full policy rejects, alone and with others."""
    return ablations(written(ledger(_bodies(spark, sf_dir)).distinct()), "all-v1")  # over the ledger as a table; no text is read again
