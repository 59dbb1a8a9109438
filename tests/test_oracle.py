"""Every registered query against its DuckDB oracle on the smallest test scale."""

import datetime
import decimal

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def _canon(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


def _rows(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    return cols, sorted((tuple(_canon(v) for v in r) for r in zip(*data)),
                        key=lambda r: tuple("" if x is None else x for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _keys():
    from lakeforge.plans.catalog import CATALOG
    return sorted(CATALOG)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as E
    sdf = E.queries()[key](spark, SF_SMALL)
    s = sdf.toArrow()
    orc = E.oracle_sql()
    if key not in orc:
        pytest.skip("no SQL oracle for this key")
    d = con.sql(orc[key]).to_arrow_table()
    sc, srows = _rows(s)
    dc, drows = _rows(d)
    assert sc == dc
    assert len(srows) == len(drows)
    assert srows == drows


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
