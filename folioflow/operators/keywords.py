"""Keyphrases: n-gram candidates of a text, ranked by the cosine of their encoding with the text's."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CUT, STOP_WORDS, ngram_rows, segment_words, segments
from ..functions.vectors import dot
from ..models.backends import FACTORIES, Known, encoded, live

TOP = 5
_STOPPED = frozenset(STOP_WORDS)
_PHRASES = "array<struct<phrase:string,score:double>>"
# Codes of words that have no slot of their own: the end of a segment, a word left out, one that isn't one token to the encoder.
_CUT, _OUT, _ODD = -1, -2, -3
#: more than single precision can put a score beside its estimate
_SLACK = 1e-5


def keyphrases(df: DataFrame, key: str = "pdf_id", body: str = "body", longest: int = 3, top: int = TOP, backend: str = "hashing") -> DataFrame:
    """(key, keywords array<struct<phrase, score>>), best first; ties go by phrase; a text without candidates has an empty array.

    With an encoder of words a text's own row holds all that is scored, so it is ranked where it lies.  For other encoders
    candidates are exploded and joined with their own text's vector by key, so a long text is spread over tasks.
    """
    texts = df.select(key, F.coalesce(F.col(body), F.lit("")).alias("_t"))
    if getattr(FACTORIES[backend], "of_words", False):
        return texts.select(key, _ranked(F.col("_t"), segment_words(F.col("_t")), longest, top, backend).alias("keywords"))
    vectors = texts.select(key, encoded(F.col("_t"), backend).alias("_v"))
    phrases = ngram_rows(texts, key, "_t", longest).distinct().withColumnRenamed("term", "phrase")
    scored = phrases.withColumn("_p", encoded(F.col("phrase"), backend)).join(vectors, key).select(key, "phrase", dot(F.col("_p"), F.col("_v")).alias("score"))
    best = scored.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "phrase"))).where(F.col("_r") <= top)
    packed = best.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "phrase", "score"))), lambda x: F.struct(x["phrase"].alias("phrase"), x["score"].alias("score"))).alias("keywords"))
    none = F.array().cast(_PHRASES)
    return texts.select(key).join(packed, key, "left").withColumn("keywords", F.coalesce("keywords", none))


def _estimates(codes: np.ndarray, vector: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """For n from 1 on the cosine of the n words from each place on with the vector; not a number where one has no slot."""
    signed = np.stack([-vector, vector], axis=1).astype(float).ravel()
    parts = np.where(codes < 0, np.nan, signed[codes])
    total, squares, same = parts, np.ones(len(codes)), []
    yield total
    for n in range(2, longest + 1):
        if n > len(codes):
            return
        a, b = codes[: 1 - n], codes[n - 1 :]
        same.append(np.where(a >> 1 == b >> 1, np.where(a == b, 2.0, -2.0), 0.0))  # two words in one place
        total = total[:-1] + parts[n - 1 :]
        squares = squares[:-1] + 1 + sum(pairs[n - 1 - lag :][: len(total)] for lag, pairs in enumerate(same, 1))
        yield np.where(squares > 0, total / np.sqrt(np.maximum(squares, 1)), total * 0)


def _near(words: list[str], codes: np.ndarray, vector: np.ndarray, longest: int, top: int) -> set[str]:
    """The phrases that can be among the best: those estimated no worse than the ``top``-th, and those without an estimate."""
    found = list(_estimates(codes, vector, longest))
    scores, firsts = np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])
    sizes = np.repeat(np.arange(1, len(found) + 1), [len(f) for f in found])
    phrase = lambda i: " ".join(words[firsts[i] : firsts[i] + sizes[i]])
    near, least = set(), -np.inf
    known = np.flatnonzero(~np.isnan(scores))
    for i in known[np.argsort(-scores[known])]:
        if scores[i] < least:
            break
        near.add(phrase(i))
        if len(near) == top and least == -np.inf:
            least = scores[i] - _SLACK
    if (codes == _ODD).any():
        cuts = np.concatenate([[0], np.cumsum(codes == _CUT)])
        near.update(phrase(i) for i in np.flatnonzero(np.isnan(scores)) if cuts[firsts[i]] == cuts[firsts[i] + sizes[i]])
    return near


def _entries(encoder, phrase: str) -> list[tuple[int, float]]:
    """Places and values of a phrase's vector, without zeros."""
    row = encoder.encode([phrase])[0]
    places = row.nonzero()[0]
    return list(zip(places.tolist(), row[places].tolist()))


def _score(entries: list[tuple[int, float]], vector: list[float]) -> float:
    """Added up in the order of places, as ``dot`` does."""
    score = 0.0
    for place, value in entries:
        score += value * vector[place]
    return score


def _best(codes_of: Known, entries_of: Known, vector: np.ndarray, runs: str, longest: int, top: int) -> list[tuple[str, float]]:
    words = runs.replace(CUT, f" {CUT} ").split()
    codes = np.fromiter(map(codes_of.__getitem__, words), np.int64, len(words))
    kept = np.flatnonzero(codes != _OUT)
    if not len(kept) or top < 1:
        return []
    near, exact = _near([words[i] for i in kept.tolist()], codes[kept], vector, longest, top), vector.tolist()
    return [(phrase, -score) for score, phrase in heapq.nsmallest(top, ((-_score(entries_of[p], exact), p) for p in near))]


def _ranked(text: Column, runs: Column, longest: int, top: int, backend: str) -> Column:
    factory = FACTORIES[backend]

    @F.pandas_udf(_PHRASES)
    def rank(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        encoder = live(backend, factory)

        def code(word: str) -> int:
            if word == CUT:
                return _CUT
            if len(word) < 2 or word in _STOPPED:
                return _OUT
            slots = encoder.slots(word)
            return slots[0] if len(slots) == 1 else _ODD

        codes_of, entries_of = Known(code), Known(lambda phrase: _entries(encoder, phrase), 50_000)
        for texts, runs_of in batches:
            yield pd.Series([_best(codes_of, entries_of, encoder.encode([t])[0], r, longest, top) for t, r in zip(texts, runs_of)])

    return rank.asNondeterministic()(text, runs)  # else a filter behind it has every text ranked twice


def _most_frequent(segments: list, longest: int, top: int) -> list[tuple[str, int]]:
    counts: Counter = Counter()
    for segment in segments:
        words = [w for w in segment if w not in _STOPPED]
        counts.update(words)
        for n in range(2, longest + 1):
            counts.update(map(" ".join, zip(*(words[i:] for i in range(n)))))
    if len(counts) > top:
        least = sorted(counts.values())[-top]
        counts = {term: n for term, n in counts.items() if n >= least}
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:top]


def top_terms(df: DataFrame, key: str = "pdf_id", body: str = "body", longest: int = 3, top: int = TOP) -> DataFrame:
    """(key, rank, term, n): the most frequent n-grams of each text; ties go by the term.

    A text's own row holds all that is counted, so its n-grams are counted where it lies and nothing is shuffled.
    """

    @F.pandas_udf("array<struct<term:string,n:bigint>>")
    def count(batch: pd.Series) -> pd.Series:
        return pd.Series([_most_frequent(s, longest, top) for s in batch])

    words = F.transform(segments(F.coalesce(F.col(body), F.lit(""))), lambda s: F.regexp_extract_all(F.lower(s), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1)))
    return df.select(key, F.posexplode(count(words)).alias("_i", "_t")).select(key, (F.col("_i") + 1).alias("rank"), "_t.term", "_t.n")
