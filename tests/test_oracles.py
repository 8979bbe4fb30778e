"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""
import pytest

from helpers import duck_rows, rows_of
from conftest import SF_SMALL

import __spark_entry__ as E

QUERIES = E.queries()
ORACLE = E.oracle_sql()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(set(ORACLE) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    # same column names and types on both sides
    rel = duck.sql(ORACLE[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types
    got = rows_of(df, cols)
    want = duck_rows(duck, ORACLE[name], cols)
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_oracle_or_is_listed():
    no_sql = set(QUERIES) - set(ORACLE) - set(E.LLM_QUERIES)
    # operators without a SQL form are checked against folds in test_folds / test_streaming
    assert no_sql == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cost" in df.columns
