"""Places for tables and files that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: While a table is written, shuffle files go when it is written, and Python gets rows in small batches.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}


def workspace(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, the folder that driver and executors share.

    Only where the session has no such folder (tests on one machine), a temporary one is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="caesura-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write(df: DataFrame, path: str) -> None:
    """df as Parquet; its shuffle files go when it is written, not at some later collection of garbage."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in WHILE_WRITING}
    try:
        for k, v in WHILE_WRITING.items():
            conf.set(k, v)
        df.select("*").write.parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written as a shared table and read again: later plans don't recompute it, and a lost executor loses none of it."""
    path = workspace(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize() made and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
