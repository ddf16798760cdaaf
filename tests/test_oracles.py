"""Every registered mirror query against its SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from palimpsest.plans import apply_queries, load_queries, queries

QUERIES = queries.QUERIES | load_queries.QUERIES | apply_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | load_queries.ORACLE_SQL | apply_queries.ORACLE_SQL

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE_SQL[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = Counter(tuple(plain(dict(zip(columns, r))[c]) for c in sorted(columns)) for r in cursor.fetchall())
    assert Counter(tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()) == want
