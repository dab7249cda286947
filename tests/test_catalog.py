"""Every registered query beside its SQL twin, over the smallest tables."""

import math
import os

import pytest

from chatloom.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.8g}")
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


def rows_of(columns, rows):
    return sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = rows_of(columns, df.collect())
    ran = duck.execute(catalog.SQL[name])
    names = [d[0] for d in ran.description]
    assert sorted(names) == columns
    assert got == rows_of(columns, [dict(zip(names, r, strict=True)) for r in ran.fetchall()])


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in catalog.SQL])
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
