from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from glyphmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, shuffle_partitions=4, spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    yield session
    session.stop()


@pytest.fixture
def eval_column(spark):
    """Values of an expression of one string column ``t``, in input order."""
    from pyspark.sql import functions as F

    def run(texts, expression):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, t string")
        got = df.select("i", expression(F.col("t")).alias("v")).collect()
        return [r.v for r in sorted(got, key=lambda r: r.i)]

    return run
