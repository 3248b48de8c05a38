"""Every registered query of the library against its SQL on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import numpy as np
import pytest

from factweave.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return ""
    if isinstance(v, (float, decimal.Decimal, np.floating)):
        return f"{float(v):.6g}"
    if isinstance(v, (list, tuple, np.ndarray)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    names = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*names).collect())
    if name not in SQL:
        assert rows
        return
    got = duck.execute(SQL[name])
    cols = [d[0] for d in got.description]
    assert sorted(cols) == names
    want = sorted(tuple(plain(r[cols.index(n)]) for n in names) for r in got.fetchall())
    assert rows == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_wikitext_nodes_of_whole_texts(spark, tmp_path):
    text = "word " * 400 + "LASTWORD"
    spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert any("LASTWORD" in str(r) for r in QUERIES["g1_wikitext_nodes"](spark, str(tmp_path)).collect())
