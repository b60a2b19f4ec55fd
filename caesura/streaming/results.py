"""Labelling results as a stream of files: the first line with a custom_id counts, whatever file or batch it comes in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_results(spark: SparkSession, folder: str) -> DataFrame:
    """A streaming DataFrame of custom_id and line. Windows that never get a result are found by a batch job at the end."""
    lines = spark.readStream.text(folder).select(F.get_json_object("value", "$.custom_id").alias("custom_id"), F.col("value").alias("line"))
    return lines.where(F.col("custom_id").isNotNull()).dropDuplicates(["custom_id"])
