"""Helpers shared by the tests of the text operators."""

import duckdb
import pytest

from tests.conftest import SMALL
from tests.test_queries import rows

TABLES = ["documents", "pages", "benchmark", "labels", "conversations", "embeddings"]


@pytest.fixture(scope="session")
def texts_duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def same_as_sql(spark, texts_duck):
    """Run a query and its SQL over the small tables and compare all rows."""
    from wardflow.llm import queries

    def check(name):
        got = queries.QUERIES[name](spark, SMALL)
        cursor = texts_duck.execute(queries.ORACLES[name])
        names = [c[0] for c in cursor.description]
        want = cursor.fetchall()
        assert sorted(got.columns) == sorted(names)
        assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want)
        assert want

    return check
