"""Publishing several tables as one: a run is written aside, then counts as a whole or not at all.

A run writes its tables into a folder of its own below ``output``, whose name begins with an underscore, so
that nothing reads it. Then one small file, put in place by a rename, names the folders to drop and those to
move: from that moment the run counts. Moving is repeated from the file until all is done, by whoever comes next,
and each step can be repeated. So a run that is killed before the file is there leaves the earlier tables as
they were, and one that is killed later is finished. ``read_published`` gives the right rows
at any time: it reads folders that are not moved yet where they are.

Folders are renamed, which moves no data on a file system with real folders. One run at a time writes to an output.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMIT = "_commit.json"
_ASIDE = "_run-"


class Publication:
    """The tables that a run puts below ``output``."""

    def __init__(self, spark: SparkSession, output: str) -> None:
        settle(spark, output)
        self.spark, self.output = spark, output.rstrip("/")
        self.folder = f"{_ASIDE}{uuid.uuid4().hex}"
        self._drops: list[str] = []
        self._moves: list[tuple[str, str]] = []

    def aside(self, name: str) -> str:
        """Where the run writes what it calls ``name``."""
        return f"{self.output}/{self.folder}/{name}"

    def put(self, name: str, target: str) -> None:
        """What was written aside as ``name`` shall replace ``target``, a table or a partition of one."""
        self._moves.append((f"{self.folder}/{name}", target))

    def put_parts(self, name: str, table: str, depth: int) -> list[str]:
        """Each of the partitions ``depth`` levels below ``name`` shall replace the one of ``table``; the partitions."""
        parts = partitions(self.spark, self.aside(name), depth)
        for part in parts:
            self.put(f"{name}/{part}", f"{table}/{part}")
        return parts

    def drop(self, target: str) -> None:
        self._drops.append(target)

    def commit(self) -> None:
        journal = json.dumps({"drops": self._drops, "moves": self._moves})
        _write(self.spark, self.aside(COMMIT), journal)
        _rename(self.spark, self.aside(COMMIT), f"{self.output}/{COMMIT}")
        settle(self.spark, self.output)


def settle(spark: SparkSession, output: str) -> None:
    """Finish the moves of a committed run, and delete what runs that never got so far left behind."""
    journal = _journal(spark, output)
    for target in journal["drops"]:
        _delete(spark, f"{output}/{target}")
    for source, target in journal["moves"]:
        if path_exists(spark, f"{output}/{source}"):
            _delete(spark, f"{output}/{target}")
            _make_folder(spark, f"{output}/{target}".rpartition("/")[0])
            _rename(spark, f"{output}/{source}", f"{output}/{target}")
    _delete(spark, f"{output}/{COMMIT}")
    for folder in partitions(spark, output, 1):
        if folder.startswith(_ASIDE):
            _delete(spark, f"{output}/{folder}")


def read_published(
    spark: SparkSession, output: str, table: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame | None:
    """The rows of a table as the last committed run has them, moved or not; None without any."""
    journal, live = _journal(spark, output), f"{output}/{table}"
    gone = [t for t in journal["drops"] if f"{t}/".startswith(f"{table}/")]
    waiting = []
    for source, target in journal["moves"]:
        if f"{target}/".startswith(f"{table}/") and path_exists(spark, f"{output}/{source}"):
            gone.append(target)
            waiting.append((f"{output}/{source.removesuffix(target.removeprefix(table))}", f"{output}/{source}"))
    if table in gone or not path_exists(spark, live):
        kept = []
    elif gone:
        depth = max(t.count("/") for t in gone)
        kept = [(live, f"{live}/{part}") for part in partitions(spark, live, depth) if f"{table}/{part}" not in gone]
    else:
        kept = [(live, live)]
    parts = []
    for base in {base for base, _ in kept + waiting}:
        reader = spark.read.format(fmt).option("basePath", base)
        reader = reader.schema(schema) if schema is not None else reader
        parts.append(reader.load(sorted(path for b, path in kept + waiting if b == base)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The folders ``depth`` levels below ``path``, without hidden ones below the first level."""
    if depth == 0:
        return [""]
    if not path_exists(spark, path):
        return []
    folder = _hadoop_path(spark, path)
    names = sorted(f.getPath().getName() for f in _files(spark, folder).listStatus(folder) if f.isDirectory())
    if depth == 1:
        return names
    return [f"{name}/{below}" for name in names if name[0] not in "_." for below in partitions(spark, f"{path}/{name}", depth - 1)]


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = _hadoop_path(spark, path)
    return _files(spark, folder).exists(folder)


def _journal(spark: SparkSession, output: str) -> dict:
    path = f"{output}/{COMMIT}"
    if not path_exists(spark, path):
        return {"drops": [], "moves": []}
    file = _hadoop_path(spark, path)
    stream = _files(spark, file).open(file)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _hadoop_path(spark: SparkSession, path: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = _hadoop_path(spark, path)
    _files(spark, folder).mkdirs(folder)


def _write(spark: SparkSession, path: str, text: str) -> None:
    file = _hadoop_path(spark, path)
    stream = _files(spark, file).create(file, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _rename(spark: SparkSession, path: str, to: str) -> None:
    source = _hadoop_path(spark, path)
    if not _files(spark, source).rename(source, _hadoop_path(spark, to)):
        raise OSError(f"cannot rename {path} to {to}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = _hadoop_path(spark, path)
    _files(spark, folder).delete(folder, True)
