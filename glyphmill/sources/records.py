"""Evaluation records as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = (
    "id string, language string, ground_truth string, text string, raw string, finetuned string"
)


def read_records(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Records of one JSON array, with their 0-based ``pos`` in it.

    An array is one document, so one task reads it, and in its order. Large sets
    come as JSON lines or Parquet with an explicit ``pos`` instead.
    """
    records = spark.read.schema(schema).option("multiLine", True).json(path)
    return records.withColumn("pos", F.monotonically_increasing_id())


def read_record_lines(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Records as JSON lines, splittable; the lines bring ``pos`` if order matters."""
    return spark.read.schema(schema + ", pos long").json(path)
