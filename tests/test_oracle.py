"""Every registered query with SQL, value for value, on the smallest tables."""

import dataclasses
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from oracle.sql import STATEMENTS
from tools.check_oracle import TABLES, compare


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def few_trees():
    """The registered queries grow all trees; what the tests compare holds for a few as well."""
    full, registry.MODEL = registry.MODEL, dataclasses.replace(registry.MODEL, max_iter=3)
    yield
    registry.MODEL = full
    registry._trained_models.clear()


@pytest.mark.parametrize("name", STATEMENTS)
def test_query_equals_sql(spark, sf_dir, database, name):
    result = registry.queries()[name](spark, sf_dir).toPandas()
    assert compare(result, database.sql(STATEMENTS[name]).df()) == ""
    assert len(result) > 0


def test_statements_belong_to_queries():
    own = {query.__name__ for query in registry.REGISTERED}
    assert set(STATEMENTS) <= own <= set(registry.queries())
    assert own == set(STATEMENTS)


@pytest.mark.parametrize("package", ["ahocorasick", "regex", "public_tokenizers", "xxhash", "ebbline.llm", "corpus_pipeline"])
def test_queries_do_not_need_the_packages_of_text_operators(monkeypatch, package):
    for name in [*sys.modules]:
        if name.startswith("ebbline.llm") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, package, None)
    with pytest.warns(UserWarning, match="not registered"):
        assert set(registry.queries()) == set(registry.oracle_sql()) == set(STATEMENTS)


def test_entry(spark):
    found = registry.entry(spark)
    assert (found.count(), found.select("CustomerID").distinct().count()) == (569, 33)
    assert found.where("Struggle = 1").count() == 29


def test_comparison_notices_differences():
    left = pd.DataFrame({"a": [1, 2], "b": [0.1, 0.2]})
    assert compare(left, left.iloc[::-1]) == ""
    assert compare(left, left.assign(b=[0.1, 0.2000000001])).startswith("1 rows differ")
    assert compare(left, left.iloc[:1]) == "2 rows against 1"
    assert compare(left, left.rename(columns={"b": "c"})).startswith("columns differ")
    assert compare(left, left.assign(a=[1.0, 2.0])).startswith("types differ")
