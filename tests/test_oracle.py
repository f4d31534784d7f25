"""Every registered query of the library against its DuckDB oracle at sf0.01.

Exact (bit-for-bit) equality is required for every column, averages of doubles included.
"""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
KEYS = [*E.DATASETS, *E.OPTIONS, *E.STORED]
_CONNECTIONS = {}


def con_of(sf):
    if sf not in _CONNECTIONS:
        _CONNECTIONS[sf] = duck(sf)
    return _CONNECTIONS[sf]


@pytest.fixture(scope="module")
def con():
    return con_of(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    r = compare(spark, key, SF_ORACLE, con_of(SF_ORACLE))
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["ok"], {k: v for k, v in r.items() if "sample" not in k}


def test_decimal_columns_listed(spark):
    from pyspark.sql import types as T

    pl = E.pipeline(spark, SF)
    for key, ds in E.DATASETS.items():
        df = getattr(pl, ds)
        dec = tuple(f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType))
        assert dec == tuple(E.DECIMAL_COLUMNS.get(key, ())), key


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue_at_risk" in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def test_column_types_agree(spark, con):
    for key in KEYS:
        q = E.queries()[key]
        s = {f.name: f.dataType.simpleString() for f in q(spark, SF).schema.fields}
        rel = con.sql(E.oracle_sql()[key])
        o = dict(zip(rel.columns, map(str, rel.types)))
        assert {n: SPARK_TO_DUCK.get(t, t) for n, t in s.items()} == o, key
