"""Every registered geospatial query against its SQL on the smallest tables, in any order of rows."""

import duckdb
import pytest

from urbanframe import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROWS_ONLY = {"bld_dedup", "cover_add", "weld_ends", "chain_merge"}
#: Empty on the smallest tables only.
MAYBE_EMPTY = {"edge_distances", "segment_hits", "stale_runs", "nearest_height", "pairs_within"}


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _plain(value):
    return None if value is None else bool(value) if isinstance(value, bool) else round(float(value), 6) if isinstance(value, (int, float)) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def test_every_query_has_sql_or_a_test_of_its_own():
    assert set(registry.queries()) - set(registry.oracle_sql()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql())))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    found = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    got, expected = _rows(df.columns, df.collect()), _rows(found.columns, found.fetchall())
    assert got == expected
    assert got or name in MAYBE_EMPTY
