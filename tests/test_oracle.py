"""The correctness gate in small: every registered query against its
DuckDB oracle (row count, columns, order-insensitive values) at sf0.001."""

import pytest

import __spark_entry__ as E
from postwise.oracle_queries import ORACLE
from postwise.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, rows_key


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert dtypes[f.name] == (t.upper() if t.startswith("decimal") else SPARK_TO_DUCK[t]), f.name
    assert len(srows) == len(drows)
    assert rows_key(srows, cols) == rows_key(drows, dcols)


def test_every_query_has_oracle_or_is_documented():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["industry", "job_postings"]
    assert df.count() > 0
