"""Tables and files in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a folder of this machine, gone at its end, only where none is set in local mode (tests).  A cluster must set one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="folioflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def _own(spark: SparkSession) -> str:
    """The folder in it that this application's tables are in."""
    return f"{shared_dir(spark)}/folioflow-{spark.sparkContext.applicationId}"


def local_path(url: str) -> str | None:
    """The file system path of a shared folder, where it is mounted as one."""
    if url.startswith("file:"):
        return "/" + url[5:].lstrip("/")
    return url if url.startswith("/") and os.path.isdir(url) else None


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and still there if an executor is lost."""
    spark = df.sparkSession
    path = f"{_own(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> None:
    """Removes the tables that this application has written; frames over them can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
