"""Every catalogue query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tessera.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple("null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, tables, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), tables.execute(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
