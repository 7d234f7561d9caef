"""Every query of the engine's own operators against its SQL in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from weftline import queries as catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for name in os.listdir(data):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{data}/{name}'")
    return c


def plain(value):
    if hasattr(value, "tolist") and not hasattr(value, "isoformat"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return [plain(x) for x in value]
    if isinstance(value, dict):
        return sorted((k, plain(v)) for k, v in value.items())
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 7)
    return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(repr([plain(x) for x in r]) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data, name):
    got = QUERIES[name](spark, data).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_flagship(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
