"""The operators' queries against their SQL, and their columns against the contract."""

import duckdb
import pytest
from ebbline.llm import queries, sql
from tools.check_oracle import TABLES, compare

QUERIES = {query.__name__: query for query in queries.QUERIES}


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sql.STATEMENTS)
def test_query_equals_sql(spark, sf_dir, database, name):
    result = QUERIES[name](spark, sf_dir).toPandas()
    assert compare(result, database.sql(sql.STATEMENTS[name]).df()) == ""
    assert len(result) > 0


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(sql.STATEMENTS) <= set(QUERIES)
