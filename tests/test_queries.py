"""Every query against its SQL on the smallest tables, and the driver contract."""

import os
import pathlib

import pytest

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check_oracles import rows_of  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_sql(spark, tables, name):
    got = queries()[name](spark, SF_DIR).toArrow().to_pandas()
    want = tables.sql(oracle_sql()[name]).to_arrow_table().to_pandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
