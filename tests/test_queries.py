"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from quillspark.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "null"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    out = df[sorted(df.columns)].map(cell)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.SQL:
        want = duck.execute(catalog.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        pd.testing.assert_frame_equal(canonical(got), canonical(want))
    else:
        assert len(got)


def test_most_queries_have_sql():
    assert len(catalog.SQL) > 0.9 * len(catalog.QUERIES)
