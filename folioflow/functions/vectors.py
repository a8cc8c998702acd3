"""Vectors in array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def normalized(a: Column) -> Column:
    """To length 1; a zero vector stays as it is."""
    size = norm(a)
    return F.transform(a, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(x.cast("double")))


def mean_pool(df: DataFrame, keys: list[str], vector: str, out: str = "vector") -> DataFrame:
    """The element-wise mean of each group's vectors, normalised; partial sums are formed before the shuffle."""
    parts = df.select(*keys, F.posexplode(vector).alias("i", "x")).groupBy(*keys, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    pooled = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("xs"))
    return pooled.select(*keys, normalized(F.transform("xs", lambda p: p["x"])).alias(out))


def softmax_over(df: DataFrame, by: list[str], logit: str, out: str = "score") -> DataFrame:
    """Scores of rows that compete within a group: they add up to 1."""
    w = Window.partitionBy(*by)
    top = F.max(logit).over(w)
    e = F.exp(F.col(logit) - top)
    return df.withColumn(out, e / F.sum(e).over(w))


def sigmoid_pair(yes: Column, no: Column) -> Column:
    """The share of ``yes`` in a softmax over two classes."""
    return 1 / (1 + F.exp(no - yes))
