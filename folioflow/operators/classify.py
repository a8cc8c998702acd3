"""Labels of documents from the scores of their windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import sentences
from ..models.backends import FACTORIES, Scorer, live, scores
from .windows import evenly, token_windows

# The label sets.
TOPICS = ("Threats, Attacks & Vulnerabilities", "Security Technology & Industry", "AI Governance & Policy")
FLAGS = ("critical information infrastructure security", "cybersecurity standards, law or policy", "security of a specific technology")
SECTORS = ("energy", "water and wastewater systems", "healthcare and public health", "financial services", "transportation systems", "communications", "government facilities", "food and agriculture", "information technology", "emergency services", "defense industrial base")
THRESHOLD = 0.5
WINDOW_TOKENS = 4096 - 64


def weighted_means(scores: DataFrame, by: list[str], label: str, score: str, weight: str, empty: float) -> DataFrame:
    """(by, label, score): each label's mean over windows, by weight; ``empty`` where the weights are all 0."""
    sums = scores.groupBy(*by, label).agg(F.sum(F.col(score) * F.col(weight)).alias("_s"), F.sum(weight).alias("_w"))
    return sums.select(*by, label, F.coalesce(F.col("_s") / F.nullif(F.col("_w").cast("double"), F.lit(0.0)), F.lit(empty)).alias(score))


def best_label(means: DataFrame, by: list[str], label: str, score: str, order: tuple[str, ...]) -> DataFrame:
    """The label of the highest score; of equal ones the first in the declared order."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(label))
    return means.groupBy(*by).agg(F.max_by(F.struct(label, score), F.struct(F.col(score), -place)).alias("_b")).select(*by, F.col("_b")[label].alias(label), F.col("_b")[score].alias(score))


def ranked(means: DataFrame, by: list[str], score: str, tie: str, out: str = "rank") -> DataFrame:
    return means.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), tie)))


def flags(scores, threshold: float = THRESHOLD):
    return F.transform_values(scores, lambda _, v: v >= threshold)


_ROW = "predicted_label string, confidence double, label_scores map<string,double>, n_windows int, flag_scores map<string,double>, flags map<string,boolean>, sector_scores map<string,double>, sectors array<string>"


def _label(documents: list[list[str]], scorer: Scorer, config: Config) -> list[tuple]:
    """One row of labels for each document's windows; all windows of a batch are scored together."""
    windows = [w for document in documents for w in document]
    weights = np.array([len(w.split()) for w in windows], float)
    begin = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype(int)

    def means(labels: tuple[str, ...], exclusive: bool, wanted: list[int]) -> dict[int, list[float]]:
        """Each document's weighted means; without a word, the even share of labels that exclude each other, else 0."""
        places = [i for d in wanted for i in range(begin[d], begin[d + 1])]
        found = np.zeros((len(windows), len(labels)))
        found[places] = scores(scorer, [windows[i] for i in places], labels, config.hypothesis_template, exclusive)
        out = {}
        for d in wanted:
            own = slice(begin[d], begin[d + 1])
            total = weights[own].sum()
            out[d] = (weights[own] @ found[own] / total).tolist() if total else [1 / len(labels) if exclusive else 0.0] * len(labels)
        return out

    every = list(range(len(documents)))
    topics = means(TOPICS, True, every)
    asked = config.taxonomy in ("flags", "both")
    flagged = means(FLAGS, False, every) if asked else {}
    fired = [d for d in every if asked and flagged[d][0] >= THRESHOLD]
    sectors = means(SECTORS, False, fired)  # only where the first flag fired
    rows = []
    for d in every:
        best = max(range(len(TOPICS)), key=lambda k: (topics[d][k], -k))  # of equal ones the first as declared
        row = (TOPICS[best], topics[d][best], dict(zip(TOPICS, topics[d])), len(documents[d]))
        row += (dict(zip(FLAGS, flagged[d])), dict(zip(FLAGS, (v >= THRESHOLD for v in flagged[d])))) if asked else (None, None)
        row += (dict(zip(SECTORS, sectors[d])), [s for s, v in zip(SECTORS, sectors[d]) if v >= THRESHOLD]) if d in sectors else (None, None)
        rows.append(row)
    return rows


def classify(df: DataFrame, config: Config = Config(), key: str = "pdf_id", body: str = "body", backend: str = "lexical") -> DataFrame:
    """(key, predicted_label, confidence, label_scores, n_windows, flag_scores, flags, sector_scores, sectors); sectors only where the first flag fired, else null.

    One pass where the texts lie: a document's windows are packed, scored and averaged in its own batch, so nothing is shuffled.
    """
    staged = df.select(key, token_windows(sentences(F.coalesce(F.col(body), F.lit(""))), WINDOW_TOKENS).alias("_all"))
    staged = staged.select(key, evenly(F.col("_all"), config.zeroshot_max_chunks).alias("windows"))
    factory, columns = FACTORIES[backend], [name.split()[0] for name in _ROW.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = live(backend, factory)
        for batch in batches:
            rows = _label([list(w) for w in batch["windows"]], scorer, config)
            yield pd.concat([batch[[key]].reset_index(drop=True), pd.DataFrame(rows, columns=columns, dtype=object)], axis=1)

    return staged.mapInPandas(run, f"{key} {staged.schema[key].dataType.simpleString()}, {_ROW}")
