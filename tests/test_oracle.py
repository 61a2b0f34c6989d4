"""Every core query against its SQL on the small tables."""

import os

import duckdb
import pytest

from talkmill.oracle import ORACLE
from talkmill.queries import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall()), key=repr)
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
