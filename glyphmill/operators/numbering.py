"""Dense positions over a whole table, without a window over all of its rows.

Rows are range-sorted, or hashed, into runs. Each run is counted, the counts are
summed up in order, and a row's position is the start of its run plus its place
inside it. Counts are summed up in two levels, so that not even they pass through a single task.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphmill.session import materialize

RUN, SPLIT, ROW = "_run", "_split", "_row"
HASH_DIGITS = 4
HASH_BUCKETS = 16**HASH_DIGITS
#: Pieces that ordinals are cut into, whose sizes the driver sees, and the bytes that a task should get.
STRETCHES = 16_384
TASK_BYTES = 16 * 1024 * 1024


def run_starts(df: DataFrame, runs: list[str], first: str) -> DataFrame:
    """Per run: its first ``_row`` and the number of rows in earlier runs.

    ``df`` must be stored, since it is read again. Runs are as many as the tasks
    or file splits that made them. They are summed up in two levels: inside each task of their own sorted table,
    and over these tasks, whose totals (one number a task) go through the driver. The starts are written
    out, so a join with them is a broadcast exactly when their true size is under Spark's threshold.
    """
    per_run = df.groupBy(*runs).agg(
        F.min(ROW).alias("_first_row"), F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first")
    )
    ordered = per_run.repartitionByRange("_first").sortWithinPartitions("_first")
    ordered = ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33))
    ordered = materialize(ordered.drop("_first"), "runs")
    totals = ordered.groupBy("_task").agg(F.sum("_n").alias("n")).orderBy("_task").collect()
    sums = itertools.accumulate((t["n"] for t in totals), initial=0)
    before = [(t["_task"], upto) for t, upto in zip(totals, sums)]
    tasks = df.sparkSession.createDataFrame(before, "_task long, _tasks_before long")
    earlier = Window.partitionBy("_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = ordered.withColumn("_inside", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    starts = inside.join(F.broadcast(tasks), "_task").select(
        *runs, "_first_row", (F.col("_tasks_before") + F.col("_inside")).alias("_before")
    )
    return materialize(starts, "run-starts")


def number_runs(df: DataFrame, runs: list[str], first: str, out: str, start: int) -> DataFrame:
    """Position of every row of stored ``df``; runs are ordered by their least ``first``."""
    numbered = df.join(run_starts(df, runs, first), runs)
    return numbered.withColumn(
        out, F.col("_before") + F.col(ROW) - F.col("_first_row") + start
    ).drop("_before", "_first_row")


def stored_in_order(df: DataFrame, order_by: list[str], out: str, start: int) -> DataFrame:
    """Like ``positions``, but keeps ``_run`` and ``_split`` of the stored, sorted table.

    Inside one ``(_run, _split)`` the rows are consecutive, so later steps can
    number what they make of them without another shuffle.
    """
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(ROW, F.monotonically_increasing_id())
        # The id carries the number of the task that made the row above bit 33.
        .withColumn(RUN, F.shiftright(ROW, 33))
    )
    stored = materialize(ordered, "ordered")
    stored = stored.withColumn(SPLIT, F.col("_metadata.file_block_start"))
    return number_runs(stored, [RUN], RUN, out, start).drop(ROW)


def in_ordinal_order(df: DataFrame, ordinal: str, size: Column | None = None) -> DataFrame:
    """``df`` in tasks that each hold one stretch of ordinals, sorted, with ``_run`` and ``_split``.

    Tasks are even by ``size``, the bytes of a row (or by rows, without it), and as many as keep them near
    ``TASK_BYTES``. Ordinals are cut into at most ``STRETCHES`` equal pieces, whose sizes are added up; a task
    gets whole pieces. The sizes are one pass over the texts, which a range sort would need for its sample too.
    """
    low, high = df.agg(F.min(ordinal), F.max(ordinal)).first()
    low, high = low or 0, high or 0
    width = -(-(high - low + 1) // STRETCHES)
    stretch = F.floor((F.col(ordinal) - low) / width).cast("int")
    bytes_of = F.lit(1) if size is None else size
    sizes = df.groupBy(stretch.alias("at")).agg(F.sum(bytes_of.cast("long")).alias("n")).collect()
    sizes = {r["at"]: r["n"] for r in sizes}
    total = max(1, sum(sizes.values()))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size is not None:
        tasks = max(tasks, -(-total // TASK_BYTES))
    upto = itertools.accumulate((sizes.get(at, 0) for at in range(max(sizes, default=0) + 1)), initial=0)
    # A piece goes where its middle lies.
    task_of = [min(tasks - 1, (2 * before + sizes.get(at, 0)) * tasks // (2 * total)) for at, before in enumerate(upto)]
    task = F.get(F.expr(f"array({', '.join(map(str, task_of))})"), stretch)
    return (
        df.withColumn(RUN, task)
        .repartitionById(tasks, F.col(RUN))
        .sortWithinPartitions(ordinal)
        .withColumn(SPLIT, F.lit(0))
    )


def positions(df: DataFrame, order_by: list[str], out: str = "pos", start: int = 0) -> DataFrame:
    """``df`` with its dense position in the order of the unique key ``order_by``."""
    return stored_in_order(df, order_by, out, start).drop(RUN, SPLIT)


def shuffle_key(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def bucket_of(digest: Column) -> Column:
    """One of ``HASH_BUCKETS`` even buckets, in the order of the digests."""
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("int")


def shuffled_positions(df: DataFrame, key: str, seed: int, out: str = "pos") -> DataFrame:
    """``df`` in a reproducible random order: position and total row count.

    Rows are ordered by a digest of their unique key. Digests are uniform, so
    their first digits are evenly filled buckets that need no sampling pass;
    the bucket starts are at most 65,536 rows and are broadcast. ``df`` is read
    twice, the first time for its key alone: pass a stored table.
    """
    digest = shuffle_key(F.col(key), seed)
    bucket = bucket_of(digest)

    sizes = df.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = sizes.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("total"),
    )
    inside = Window.partitionBy("_bucket").orderBy("_digest", key)
    return (
        df.withColumn("_digest", digest)
        .withColumn("_bucket", bucket)
        .withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(out, F.col("_before") + F.col("_place"))
        .drop("_bucket", "_digest", "_place", "_before")
    )
