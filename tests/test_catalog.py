"""Every catalog query against its SQL twin in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from galefold.plans import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, con, name):
    frame = catalog.queries()[name](spark, SMALL)
    names = sorted(frame.columns)
    got = sorted([tuple(plain(r[c]) for c in names) for r in frame.collect()], key=repr)
    want = con.sql(catalog.oracle_sql()[name])
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    assert got == sorted([tuple(plain(r[i]) for i in at) for r in want.fetchall()], key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows_only(spark, name):
    assert catalog.queries()[name](spark, SMALL).count() > 0


def test_entry_module():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
