"""Deterministic shuffle, exact train/test split, shards, resume and their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.operators.numbering import HASH_BUCKETS, bucket_of, shuffle_key, shuffled_positions

#: Shards whose starts are sent to every task; more are joined by a shuffle.
BROADCAST_SHARDS = 500_000


def split_and_shard(
    df: DataFrame, key: str, shard_size: int, train_ratio: float = 0.9, seed: int = 42
) -> DataFrame:
    """``df`` with ``pos``, ``split``, ``split_pos`` and ``shard_idx``.

    The first ``int(n * train_ratio)`` rows of the shuffled order are train, the
    rest test. Shards are consecutive rows of a split, all full but its last.
    Pass names and sizes only; content is joined to the result.
    """
    placed = shuffled_positions(df, key, seed)
    train = (F.col("total") * F.lit(train_ratio)).cast("long")
    in_train = F.col("pos") < train
    return (
        placed.withColumn("split", F.when(in_train, "train").otherwise("test"))
        .withColumn("split_pos", F.when(in_train, F.col("pos")).otherwise(F.col("pos") - train))
        .withColumn("shard_idx", F.floor(F.col("split_pos") / shard_size).cast("int"))
        .drop("total")
    )


def shard_starts(placed: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """By digest bucket of the shuffle: the shard in force where it begins, and the shards that begin inside it.

    Shards are stretches of the shuffled order, which is that of the digests, so the digest of a key and the
    first digest of every shard tell where the row belongs. One row a bucket, one struct a shard.
    """
    digest = shuffle_key(F.col(key), seed)
    first = placed.groupBy("split", "shard_idx").agg(F.min(F.struct(digest.alias("digest"), F.col(key).alias("key"))).alias("at"))
    start = F.struct("at", "split", "shard_idx")
    inside = first.groupBy(bucket_of(F.col("at.digest")).alias("_bucket")).agg(F.array_sort(F.collect_list(start)).alias("_inside"))
    every = placed.sparkSession.range(HASH_BUCKETS).select(F.col("id").cast("int").alias("_bucket")).join(inside, "_bucket", "left")
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return every.withColumn("_before", F.last(F.element_at("_inside", -1), ignorenulls=True).over(earlier))


def with_shard(df: DataFrame, key: str, starts: DataFrame, seed: int = 42) -> DataFrame:
    """``df`` with the ``split`` and ``shard_idx`` that its keys belong to by stored ``shard_starts``.

    A key that was not placed itself gets the shard of its neighbours; one before the first shard is left out.
    """
    shards = starts.agg(F.sum(F.coalesce(F.size("_inside"), F.lit(0)))).first()[0]
    if shards <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    digest = shuffle_key(F.col(key), seed)
    at = F.struct(digest.alias("digest"), F.col(key).alias("key"))
    begun = F.filter("_inside", lambda s: s["at"] <= F.col("_at"))
    shard = F.coalesce(F.try_element_at(begun, F.lit(-1)), F.col("_before"))
    found = df.withColumns({"_at": at, "_bucket": bucket_of(digest)}).join(starts, "_bucket").withColumn("_shard", shard)
    found = found.withColumns({"split": F.col("_shard.split"), "shard_idx": F.col("_shard.shard_idx")})
    return found.filter(F.col("shard_idx").isNotNull()).drop("_at", "_bucket", "_inside", "_before", "_shard")


def resume_shards(df: DataFrame, train_shard: int = 0, test_shard: int = 0) -> DataFrame:
    """The rows of a sharded table from the given shard of each split on."""
    first = F.when(F.col("split") == "train", train_shard).otherwise(test_shard)
    return df.filter(F.col("shard_idx") >= first)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def shard_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "shard_idx").agg(F.count("*").alias("n"))


def id_manifest(df: DataFrame, key: str) -> DataFrame:
    """Lines of the id manifest, ``split, line_no, line``: a header, then ids in order.

    A table in the order ``train`` before ``test`` and ``line_no``; line 0 is the header.
    """
    header = F.format_string("--- %s SPLIT | Total: %d ---", F.upper("split"), "n")
    headers = split_sizes(df).select("split", F.lit(0).cast("long").alias("line_no"), header.alias("line"))
    ids = df.select("split", (F.col("split_pos") + 1).alias("line_no"), F.col(key).cast("string").alias("line"))
    return headers.unionByName(ids)


def asset_manifest(df: DataFrame, key: str, path: str = "path", length: str = "length") -> DataFrame:
    """Per shard archive: its name, member count, total bytes and the members in order.

    A shard never has more members than the shard size, so the lists are bounded.
    """
    member = F.struct(
        F.col("split_pos"), F.concat(F.col(key).cast("string"), F.lit(".png")).alias("arcname"), F.col(path)
    )
    name = F.format_string("%s_shard_%04d", "split", "shard_idx")
    return (
        df.groupBy("split", "shard_idx")
        .agg(
            F.count("*").alias("members"),
            F.sum(length).alias("total_bytes"),
            F.array_sort(F.collect_list(member)).alias("files"),
        )
        .withColumn("archive", name)
    )
