"""Every raster query against its SQL in an independent engine, at the smallest size."""

import math
from pathlib import Path

import duckdb
import pytest

from tessella import queries as Q

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(df):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        return repr(round(float(v), 6) + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_same_rows(spark, oracle, name):
    got = plain(Q.queries()[name](spark, DATA).toPandas())
    assert got == plain(oracle.execute(Q.oracle_sql()[name]).df())
    assert got


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_runs(spark, name):
    assert Q.queries()[name](spark, DATA).count()


def test_entry_without_the_optional_subpackage(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count()
    assert set(Q.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
