"""Every catalogue query with an SQL form equals DuckDB on the same parquet."""
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.sources.tables import TABLES, table_path

from .conftest import SF_CHECK


def _canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = table_path(SF_CHECK, t)
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


_DUCK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean", "FLOAT": "float"}


def _duck_type(t):
    t = str(t)
    return f"array<{_duck_type(t[:-2])}>" if t.endswith("[]") else _DUCK.get(t, t.lower())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_CHECK)
    rel = con.sql(entry.oracle_sql()[name])
    assert dict(sdf.dtypes) == {c: _duck_type(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(cols)
    keys = sorted(cols)
    srows = Counter(tuple(_canon(r[k]) for k in keys) for r in
                    (x.asDict(recursive=True) for x in sdf.collect()))
    drows = Counter(tuple(_canon(dict(zip(cols, r))[k]) for k in keys) for r in cur.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_id", "price_mean", "price_sum", "discount_max"]
    assert df.count() > 0


def test_contract_consistency():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) and (f.__doc__ or "").strip() for f in qs.values())
    # of the catalogue, only model queries have no SQL (rows-only checks)
    catalogue = entry.catalogue
    assert all(n.startswith("ml_") for n in catalogue.QUERIES if n not in catalogue.ORACLE)
