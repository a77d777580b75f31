"""Sessions for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("glyphmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GLYPHMILL_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own. On a
    cluster every executor must see the folder, so there it is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="glyphmill-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/glyphmill-{spark.sparkContext.applicationId}"


#: Where ``materialize`` wrote inside the innermost ``temporary_tables``.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``materialize`` stored inside it; nothing read from there may be used any more."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            _delete(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (paths := _written.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for df in stored:
        spark = df.sparkSession
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            if folder.startswith(scratch_dir(spark)) or scratch_dir(spark) in folder:
                _delete(spark, folder)


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application stored in the scratch folder, once its results are written."""
    _delete(spark, scratch_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over ``spark.sql.shuffle.partitions`` tasks, whatever its size.

    For work that costs far more than moving its input, like edit distances.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by a unique key over several tasks a core, so that none is left to run alone at the end.

    A scan of stored files makes about one task a core, or one more, whatever their rows cost.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, key)
