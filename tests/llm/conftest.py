import glob
import os

import pytest

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("runs", "sites", "source_docs", "extract_out", "clean_out", "validate_out", "summarize_out", "document_metrics", "stage_metrics", "documents", "eval_items", "chunk_limits", "boundary_sample", "level_labels")


@pytest.fixture(scope="session")
def data():
    if not glob.glob(f"{DATA}/*.parquet"):
        pytest.skip("no test tables")
    return DATA


@pytest.fixture(scope="session")
def empty_tables(spark, data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        spark.read.parquet(f"{data}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd_tables(spark, data, tmp_path_factory):
    """The tables with rows of nulls, exact copies, and columns whose names clash with those of the operators."""
    from pyspark.sql import functions as F

    folder = tmp_path_factory.mktemp("odd")
    clashing = {"text", "n", "field", "words", "title", "line", "ids", "host", "key"}
    for name in TABLES:
        df = spark.read.parquet(f"{data}/{name}.parquet")
        if name != "documents":  # doc_id is unique there
            df = df.unionByName(df)
        nulls = df.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields))
        df = df.unionByName(nulls)
        for c in sorted(clashing - set(df.columns)):
            df = df.withColumn(c, F.lit("clash"))
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
