"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

from trailmark import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, list):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, small, duck, name):
    df = catalog.queries()[name](spark, small)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=repr) == rows


def test_entry_module_without_extras(spark):
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert os.path.exists(__spark_entry__.__file__)


def test_hot_path_stays_in_the_jvm(spark, small):
    """No Python, no cross join, and columns pruned at the scan."""
    for name in ("a2_hourly_content_metrics", "j4_impression_action_inferred", "j6_as_of_user", "a8_daily_sliding_counts"):
        plan = catalog.queries()[name](spark, small)._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert "ReadSchema" in plan
