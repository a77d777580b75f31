"""What several operators share: reading tables, ASCII lower case, folds."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z lower-cased, every other character as it is.

    Texts of ASCII alone take the built-in, which is much faster and agrees there.
    """
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


#: Rows of an Arrow batch at most: texts may be long, and a task holds a batch several times over.
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS``; smaller ones stay as they are."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_ROWS`` at most for the jobs that run inside; then the session's own setting again."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    bounded_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(key, before)
