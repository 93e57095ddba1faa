"""The reference queries against their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from vellumine import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rounded(rows):
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = own.queries()[name](spark, sf)
    found = con.execute(own.oracle_sql()[name])
    names = [c[0] for c in found.description]
    want = [tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)) for r in found.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert rounded([tuple(r[c] for c in sorted(names)) for r in df.collect()]) == rounded(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_sql(spark, sf):
    for name in sorted(set(own.queries()) - set(own.oracle_sql())):
        assert own.queries()[name](spark, sf).count() > 0
