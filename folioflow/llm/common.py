"""Helpers shared by the training-data operators.

Every operator here reads Arrow batches (``mapInArrow``): whole texts go to
Python once, only compact results come back.  Rows are scored where they lie, so
texts are not shuffled; what repeats (a PDF in two runs, exact duplicate rows)
is removed from the compact results instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import local_path, shared_dir, written  # noqa: F401 - used by the operators


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """Key columns and one text column of the rows whose text is neither null nor empty."""
    return df.select(*key, F.col(column).alias("text")).where(F.col("text").isNotNull() & (F.col("text") != ""))


def strings(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def frame(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


@lru_cache(1)
def alnum_table() -> np.ndarray:
    """For each code point, whether it is a letter or digit."""
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(32)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INV, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every window of ``width`` values, by prefix sums."""
    n = len(codes)
    if n < width:
        return np.zeros(0, np.uint64)
    size = 1 << max(10, int(n).bit_length())
    up, down = _powers(size)
    mixed = (codes.astype(np.uint64) + np.uint64(0x51ED)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed * down[:n], out=total[1:])
    out = (total[width:] - total[:-width]) * up[: n - width + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def batches(fn) -> object:
    """Turns a function of one Arrow batch into one of an iterator of batches."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield fn(batch)

    return run
