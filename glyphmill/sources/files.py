"""Folders of rendered images and their text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _basename(file_name: Column) -> Column:
    """The name without its last four characters (``.png``, ``.txt``)."""
    return F.substring(file_name, F.lit(1), F.length(file_name) - 4)


def _metadata_name() -> Column:
    """The file name as it is on disk; the metadata column has it as part of a URL."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _last_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def read_images(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    """``basename, path, length`` of the PNG files, with their bytes only if asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(folder)
    named = files.select(
        _basename(_last_part(F.col("path"))).alias("basename"),
        "path",
        "length",
        *(["content"] if content else []),
    )
    return named


def read_texts(spark: SparkSession, folder: str, value: bool = True) -> DataFrame:
    """``basename, text``: one row per text file, its text whole; or the names alone."""
    if not value:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
        return files.select(_basename(_last_part(F.col("path"))).alias("basename"))
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return files.select(
        _basename(_metadata_name()).alias("basename"),
        F.col("value").alias("text"),
    )


def folder_megabytes(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the size of all files below ``folder`` in MB; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)
        .load(folder)
    )
    return files.agg((F.coalesce(F.sum("length"), F.lit(0)) / 1048576).alias("megabytes"))
