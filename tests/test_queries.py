"""Every query with SQL gives the rows of its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

DATA = os.environ.get("CITELOOM_DATA", "/root/testdata/sf0.001")
TABLES = "events embeddings documents paper_new load_to_zilliz paper_prod coverage_input source_mapping source_list embed_window"


def normal(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float):
        return f"{v:.4f}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_rows_of_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    found = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(normal(r[c]) for c in sorted(names)) for r in df.collect())
    want = sorted(tuple(normal(dict(zip(names, r))[c]) for c in sorted(names)) for r in found.fetchall())
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
