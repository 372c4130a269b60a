"""Every core query runs, gives columns without repeats, and equals its SQL on the smallest tables."""

import os

import duckdb
import pytest

from jobloom.plans.registry import core_queries, core_sql


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return int(v) if type(v).__name__ == "Decimal" and v % 1 == 0 else v


@pytest.fixture(scope="module")
def db(small):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(small):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{small}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(core_queries()))
def test_query(spark, small, db, name):
    df = core_queries()[name](spark, small)
    cols = sorted(df.columns)
    assert len(set(cols)) == len(cols)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    if name in core_sql():
        res = db.execute(core_sql()[name])
        at = [[x[0] for x in res.description].index(c) for c in cols]
        assert got == sorted(repr([plain(r[i]) for i in at]) for r in res.fetchall())


def test_entry_runs_without_the_subpackage(spark, monkeypatch):
    import importlib.util

    import __spark_entry__ as entry

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "jobloom.llm" else real(name, *a))
    assert set(entry.queries()) == set(core_queries())
    assert entry.entry(spark).count() > 0


def test_shared_folder(spark, monkeypatch, tmp_path):
    from jobloom.plans import shared

    path = shared.fresh_path(spark, "t")
    spark.range(3).write.parquet(path)
    before = list(shared._written)
    shared._written[:] = before[-1:]
    shared.release()
    assert not os.path.exists(path.removeprefix("file://"))
    shared._written[:] = before[:-1]

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        shared.shared_dir(Cluster)
