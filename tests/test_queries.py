"""Every query of the library gives the rows of its SQL on the smallest tables, and each can be read."""

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from ledgerloom.plans import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (float, Decimal)):
        return "null" if math.isnan(v) else f"{float(v):.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return str(v.replace(tzinfo=None))
    if isinstance(v, dt.date):
        return str(dt.datetime(v.year, v.month, v.day))
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    found = registry.queries()[name](spark, str(DATA))
    asked = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in asked.description]
    assert sorted(found.columns) == sorted(names)
    order = sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in asked.fetchall())
    got = sorted(tuple(plain(r[c]) for c in order) for r in found.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert registry.queries()[name](spark, str(DATA)).count() > 0
