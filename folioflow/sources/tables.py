"""Tables: reading with pruning, upserts, patches and exports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty frame of its schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; others stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def patch(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Only the named columns take the new values, where there is a row with the key; null is a value too."""
    fresh = new.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_there"))
    joined = old.join(fresh, keys, "left")
    return joined.select(*(F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns))


def flat(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for CSV."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType | MapType | StructType)}
    return df.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns))


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").csv(path, header=True)


def quarantine(df: DataFrame, flag: str, path: str, raw: str | None = None, name: str = "doc_id") -> None:
    """Appends the flagged rows as JSON lines to a manifest; their raw text, if any, goes to side files of one row each, by safe names."""
    from ..functions.text import safe_filename

    bad = df.where(F.col(flag))
    bad.write.mode("append").json(f"{path}/manifest")
    if raw:
        named = bad.select(safe_filename(F.col(name).cast("string")).alias("name"), F.coalesce(F.col(raw), F.lit("")).alias("value"))
        named.write.mode("append").partitionBy("name").text(f"{path}/raw")


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _file_system(spark, path)
    return files.exists(target)


def replace(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a written folder in another's place."""
    source, files = _file_system(spark, fresh)
    target, _ = _file_system(spark, path)
    files.delete(target, True)
    files.rename(source, target)


def write_json(spark: SparkSession, value: object, path: str) -> str:
    """One JSON document, through Spark's file system, so that a store's URL may be any that Spark reads."""
    target, files = _file_system(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, sort_keys=True, default=str).encode()))
    finally:
        out.close()
    return str(path)
