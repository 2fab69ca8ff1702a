"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import decimal
import math

import pytest

from brindle import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalog.ORACLES:
        assert got
        return
    cur = duck.execute(catalog.ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)


def test_entry_without_the_subpackage(monkeypatch):
    """The entry module imports and keeps the engine's queries where the subpackage is gone."""
    import importlib
    import sys

    for m in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("brindle.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert set(catalog.QUERIES) == set(entry.queries()) and set(catalog.ORACLES) == set(entry.oracle_sql())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
