"""Nearest neighbours by cosine: every query against every vector, in bounded blocks of both."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
#: queries of up to this size go to every worker, in one scan of the vectors; beyond it, tiles of both are joined
SENT_BYTES = 64 << 20
TILE = 100_000


def nearest(vectors: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = BLOCK, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """(query_id, rank, key, score) of the k most similar other vectors of each query.

    Each batch, or tile, of vectors yields its best k for a query, so what is shuffled doesn't grow with the number of
    vectors in a batch.  Ties go by key.  Both ways give the same rows; the size of the queries is measured first.
    """
    some = lambda df: df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows, asked = some(vectors), some(queries)
    size = asked.agg(F.coalesce(F.sum(F.size("v") * 8 + 8), F.lit(0))).first()[0]
    every = _by_scan(rows, asked, k, block) if size <= sent_bytes else _by_tiles(rows, asked, k)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id")
    return every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")


def _best(ids: np.ndarray, matrix: np.ndarray, own: np.ndarray, others: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best of some vectors for each query; all that tie with the k-th stay, so that ties are settled by key at the end."""
    q, i, s = [], [], []
    scores = matrix @ others.T
    scores[ids[:, None] == own[None, :]] = -np.inf
    for row, score in enumerate(scores):
        cut = np.partition(score, -min(k, len(score)))[-min(k, len(score))]
        hit = np.flatnonzero((score >= cut - 1e-9) & np.isfinite(score))
        q += [ids[row]] * len(hit)
        i += own[hit].tolist()
        s += score[hit].tolist()
    return q, i, s


def _by_scan(rows: DataFrame, asked: DataFrame, k: int, block: int) -> DataFrame:
    mine = asked.toArrow()  # at most SENT_BYTES
    ids = mine["id"].to_numpy()
    matrix = _unit(np.array(mine["v"].to_pylist(), np.float64)) if len(ids) else np.zeros((0, 1))
    sent = rows.sparkSession.sparkContext.broadcast((ids, matrix))

    def run(it):
        ids, matrix = sent.value
        for batch in it:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(own) or not len(ids):
                continue
            others = _unit(np.array(batch.column(1).to_pylist(), np.float64))
            for at in range(0, len(ids), block):
                yield _result(*_best(ids[at : at + block], matrix[at : at + block], own, others, k))

    return rows.mapInArrow(run, "query_id bigint, id bigint, score double")


def _by_tiles(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Tiles of at most about TILE vectors and TILE queries; each row goes to the tiles of its stripe."""
    stripes = lambda df: max(1, -(-df.count() // TILE))
    down, across = stripes(rows), stripes(asked)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = rows.select("id", "v", own(down).alias("a"), every(across).alias("b")).groupBy("a", "b")
    right = asked.select("id", "v", every(down).alias("a"), own(across).alias("b")).groupBy("a", "b")

    def tile(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[list] = [[], [], []]
        if len(vectors) and len(queries):
            others, matrix = (_unit(np.array(x["v"].tolist(), np.float64)) for x in (vectors, queries))
            for at in range(0, len(queries), 256):
                for column, part in zip(found, _best(queries["id"].to_numpy()[at : at + 256], matrix[at : at + 256], vectors["id"].to_numpy(), others, k)):
                    column += part
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), found))).astype({"query_id": "int64", "id": "int64", "score": "float64"})

    return left.cogroup(right).applyInPandas(tile, "query_id bigint, id bigint, score double")


def _unit(m: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(size > 0, size, 1)


def _result(q: list, i: list, s: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "id", "score"])
