"""Token windows: whole sentences packed up to a budget, with overlap; and even choices among windows."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def pack(sentences: list[str], budget: int, overlap: float = 0.125, tokenize: Callable[[str], list[str]] = str.split, join: Callable[[list[str]], str] = " ".join) -> list[str]:
    """Windows of whole sentences of at most ``budget`` tokens.

    Over the running totals of tokens, a window's end and the next one's begin are binary searches: it ends at the
    last total within the budget, and the next begins at the last sentence behind which ``overlap`` of the budget
    is left, but always at least one sentence further.  A sentence over the budget makes a window of its own, of
    its first ``budget`` tokens.
    """
    upto = [0, *accumulate(len(tokenize(s)) for s in sentences)]
    out: list[str] = []
    begin, end = 0, 0
    while end < len(sentences):
        end = bisect_right(upto, upto[begin] + budget) - 1
        if end > begin:
            out.append(" ".join(sentences[begin:end]))
        else:
            end = begin + 1
            out.append(join(tokenize(sentences[begin])[:budget]))
        begin = max(begin + 1, min(end, bisect_right(upto, upto[end] - int(budget * overlap)) - 1))
    return out


def token_windows(sentences: Column, budget: int, overlap: float = 0.125) -> Column:
    """The windows of an array of sentences, by white-space tokens; Arrow batches, as the greedy packing looks back."""

    @F.pandas_udf("array<string>")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda s: None if s is None else pack(list(s), budget, overlap))

    return run(sentences)


def even_positions(size: Column, n: int) -> Column:
    """At most n positions from 1, spread evenly over ``size``; all of them if there are no more."""
    every = F.sequence(F.lit(1), size)
    if n <= 1:
        spread = F.array(F.lit(1))
    else:
        spread = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(i * (size - 1) / (n - 1)).cast("int") + 1)
    return F.when(size < 1, F.array().cast("array<int>")).when(size <= n, every).otherwise(spread)


def evenly(items: Column, n: int) -> Column:
    return F.transform(even_positions(F.size(items), n), lambda i: F.element_at(items, i))
