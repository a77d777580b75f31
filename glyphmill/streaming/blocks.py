"""Corpus files cut into blocks as they arrive.

Cleaning and cutting look at one row at a time, so the batch expressions run on
a stream unchanged. The checkpoint remembers which files are done, which is what
resuming by row number does for a single file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glyphmill.operators.chunks import row_blocks
from glyphmill.operators.corpus import with_defaults

ROW_SCHEMA = "row_ordinal long, id string, language string, text string"


def stream_blocks(spark: SparkSession, folder: str, seed: int = 42) -> DataFrame:
    """Blocks of the Parquet rows that land in ``folder``; rows bring their ordinal."""
    rows = spark.readStream.schema(ROW_SCHEMA).parquet(folder)
    cut = row_blocks(with_defaults(rows), seed)
    return cut.select(
        "row_ordinal",
        "id",
        "language",
        F.posexplode_outer("blocks").alias("_idx", "block_text"),
    ).filter(F.col("block_text").isNotNull()).withColumn("block_idx", F.col("_idx") + 1).drop("_idx")


def run_available(blocks: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Process every file not seen before, then stop."""
    return (
        blocks.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
