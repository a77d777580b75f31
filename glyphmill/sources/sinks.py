"""Where the datasets go. Every writer can be run again and gives the same files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_flat(flat: DataFrame, path: str, max_rows_per_file: int = 10_000) -> None:
    """The flat dataset, one folder per split, files of bounded size."""
    flat.write.partitionBy("split").option("maxRecordsPerFile", max_rows_per_file).mode(
        "overwrite"
    ).parquet(path)


def write_shards(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One file per ``split`` and ``shard_idx``, its rows in ``split_pos`` order.

    Only the shards present in ``df`` are replaced, so a run resumed at a later
    shard leaves the earlier ones alone and a repeated run changes nothing.
    """
    write_placed(df.repartition("split", "shard_idx"), path, ["split", "shard_idx"], fmt)


def write_placed(df: DataFrame, path: str, folders: list[str], fmt: str = "parquet") -> None:
    """Rows that are with the others of their shard already, in a folder for each value of ``folders``."""
    writer = (
        df.sortWithinPartitions(*folders, "split_pos")
        .drop("split_pos")
        .write.partitionBy(*folders)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        # Null leaves are part of the chat layout.
        .option("ignoreNullFields", False)
    )
    writer.format(fmt).save(path)


def write_instruction_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line, non-ASCII as it is, a folder per split and shard."""
    write_shards(df, path, fmt="json")


def write_records(df: DataFrame, path: str) -> None:
    """The comparison export as JSON lines."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def verify_written(
    spark: SparkSession, written: str, expected: DataFrame, key: str = "id", fmt: str = "parquet"
) -> DataFrame:
    """Read a dataset back: key sets compared both ways, as ``key, problem``; empty if all is well.

    The columns of ``expected`` must be there; a difference raises at once.
    """
    back = spark.read.format(fmt).load(written)
    missing = set(expected.columns) - set(back.columns)
    if missing:
        raise ValueError(f"columns not written: {sorted(missing)}")
    lost = expected.join(back, key, "left_anti").select(key, F.lit("lost").alias("problem"))
    extra = back.join(expected, key, "left_anti").select(key, F.lit("extra").alias("problem"))
    twice = back.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return lost.unionByName(extra).unionByName(twice.select(key, F.lit("twice").alias("problem")))
