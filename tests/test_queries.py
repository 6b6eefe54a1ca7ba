import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()


def plain(v):
    if v is None or v != v:
        return None
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    for p in pathlib.Path(sf).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, sql, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    rel = sql.sql(SQL[name])
    assert sorted(rel.columns) == columns
    mine = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    at = [rel.columns.index(c) for c in columns]
    assert mine == sorted(repr(tuple(plain(r[k]) for k in at)) for r in rel.fetchall())


def test_entry_and_contract(spark):
    assert set(SQL) <= set(entry.queries())
    assert entry.entry(spark).columns == ["format_used", "scope", "n", "n_phases", "usfe_sum"]
