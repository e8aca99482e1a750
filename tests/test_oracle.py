"""Every registered query equals its DuckDB oracle (row multiset, column names)."""

import pytest

import __spark_entry__ as E
from checks.compare import duck, rows_of
from possum.plans.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    oracles = E.oracle_sql()
    assert key in oracles
    df = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(oracles[key])
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == duck_types[f.name], f.name
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1635
    assert len(df.columns) == 18
