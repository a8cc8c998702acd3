"""Problem 1: pieces of oversized texts, by content-defined chunking.

Landmarks are positions whose rolling hash (48 code points) is below a threshold,
so they depend only on the text around them.  Each cut snaps to the natural
boundary nearest to the first landmark in reach; an edit therefore moves only
the cuts beside it, and later cuts fall on the same places again.

Defined cases: a null or empty body has no pieces; a body within the limit is
one piece; a piece ends 'hard' only where no natural boundary is in reach of the
limit at all; overlap shrinks (to 0 if need be) where a long unbroken stretch
would otherwise push a piece over the limit.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import code_points, frame, read, strings, texts_of, window_hashes

MAX_LIMITS = 1000
LANDMARK_WIDTH = 48
KINDS = ("end", "paragraph", "sentence", "line", "space", "hard")

_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
_SENTENCE = re.compile(r"[.!?][\"'”’»)\]]*(?=\s)|[。！？।؟۔][”’」』»）)\"']*")
_LINE = re.compile(r"\n")
_SPACE = re.compile(r"[\s。！？।؟۔]")


class Boundaries:
    """Sorted natural cut positions of a text, best kind first."""

    def __init__(self, text: str):
        self.by_kind = [
            [m.start() for m in _PARAGRAPH.finditer(text)],
            [m.end() for m in _SENTENCE.finditer(text)],
            [m.start() for m in _LINE.finditer(text)],
            # at worst a piece ends before or after a white space or a full stop that needs none
            sorted({p for m in _SPACE.finditer(text) for p in (m.start(), m.end())}),
        ]

    def nearest(self, goal: int, low: int, high: int, reach: int) -> tuple[int, str] | None:
        """The boundary in [low, high] to take for ``goal``: of the best kind with one within ``reach``, the nearest."""
        for spread in (reach, high - low):
            for kind, at in zip(KINDS[1:], self.by_kind):
                i = bisect_left(at, goal)
                best = min((p for p in at[max(0, i - 1) : i + 1] if low <= p <= high), key=lambda p: (abs(p - goal), p), default=None)
                if best is not None and abs(best - goal) <= spread:
                    return best, kind
        return None

    def next_after(self, position: int) -> int | None:
        at = self.by_kind[3]
        i = bisect_right(at, position)
        return at[i] if i < len(at) else None

    def last_in(self, low: int, high: int) -> int | None:
        at = self.by_kind[3]
        i = bisect_right(at, high) - 1
        return at[i] if i >= 0 and at[i] >= low else None


def landmarks(codes: np.ndarray, spacing: int) -> np.ndarray:
    """Ends of windows whose hash is in the lowest 1/spacing of all values."""
    hashes = window_hashes(codes, LANDMARK_WIDTH)
    return np.flatnonzero(hashes < np.uint64((1 << 64) // max(2, spacing))) + LANDMARK_WIDTH


def split_text(text: str | None, max_chars: int, overlap: int, bounds: Boundaries | None = None, codes: np.ndarray | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind of end) of each piece; the pieces cover the text, none is longer than ``max_chars``."""
    if not text:
        return []
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    n, overlap = len(text), max(0, min(overlap, max_chars // 2))
    if n <= max_chars:
        return [(0, n, "end")]
    bounds = bounds or Boundaries(text)
    marks = landmarks(code_points(text) if codes is None else codes, max(2, max_chars // 6))
    pieces, start, cut = [], 0, 0
    while n - start > max_chars:
        top = cut + max_chars - (overlap if pieces else 0)
        low = min(cut + max(1, max_chars // 3), top)
        i = np.searchsorted(marks, low)
        goal = int(marks[i]) if i < len(marks) and marks[i] <= top else top
        found = bounds.nearest(goal, low, top, max(1, max_chars // 10))
        if found is None and (p := bounds.last_in(cut + 1, low)) is not None:
            found = p, "space"
        if found is None and (p := bounds.next_after(cut)) is not None and p <= cut + max_chars:
            found = p, "space"
        if found is None:
            found = (n, "end") if n <= cut + max_chars else (cut + max_chars, "hard")
        end, kind = found
        start = max(start, end - max_chars) if pieces else 0
        pieces.append((start, end, kind))
        if end >= n:
            return pieces
        cut = end
        want = max(cut - overlap, 0)
        snapped = bounds.nearest(want, max(0, want - overlap // 4), min(cut, want + overlap // 2), max(1, overlap // 4)) if overlap else None
        start = snapped[0] if snapped else want
    pieces.append((max(start, n - max_chars), n, "end"))
    return pieces


def bounded_limits(limits: DataFrame) -> list[tuple[str, int, int]]:
    """The limits as a list; a table of more than MAX_LIMITS rows is refused, as each row is one pass over the text."""
    rows = limits.select("consumer", "max_chars", "overlap_chars").where("consumer IS NOT NULL AND max_chars > 0").distinct().limit(MAX_LIMITS + 1).collect()
    if len(rows) > MAX_LIMITS:
        raise ValueError(f"more than {MAX_LIMITS} consumers")
    return sorted((r[0], r[1], r[2] or 0) for r in rows)


def pieces(texts: DataFrame, limits: list[tuple[str, int, int]], key: str = "pdf_id") -> DataFrame:
    """(key, consumer, piece_no, start_char, end_char, end_kind) of the column ``text``, for each text and consumer."""
    schema = f"{key} string, consumer string, piece_no int, start_char int, end_char int, end_kind string"
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    names = [key, "consumer", "piece_no", "start_char", "end_char", "end_kind"]

    def run(it):
        for batch in it:
            out: list[list] = [[] for _ in names]
            for k, text in zip(strings(batch, key), strings(batch, "text")):
                if not text:
                    continue
                bounds = codes = None
                for consumer, most, overlap in limits:
                    if len(text) > most and bounds is None:
                        bounds, codes = Boundaries(text), code_points(text)
                    for no, (a, b, kind) in enumerate(split_text(text, most, overlap, bounds, codes), 1):
                        for column, value in zip(out, (k, consumer, no, a, b, kind)):
                            column.append(value)
            yield frame(names, out, types)

    return texts.select(key, "text").mapInArrow(run, schema)


def oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = bounded_limits(read(spark, sf_dir, "chunk_limits"))
    bodies = texts_of(read(spark, sf_dir, "clean_out"), ["pdf_id"], "body")
    least = min((most for _, most, _ in limits), default=0)
    # a body within every limit is one piece; only the others need cutting
    return pieces(bodies.where(F.length("text") > least), limits)


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pieces of every body over a consumer's limit."""
    return oversized(spark, sf_dir).where("piece_no > 1 OR end_kind <> 'end'").distinct()


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies and consumers with a piece that can't end at a natural boundary."""
    return oversized(spark, sf_dir).where("end_kind = 'hard'").select("pdf_id", "consumer").distinct()
