"""Driver contract and the DuckDB oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_key

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["doc_id", "rank", "term", "tf", "df", "tfidf"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "array<double>": "DOUBLE[]", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == duck_types.get(f.name), f.name
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(ocols, res.fetchall())


def test_bounded_tables_are_broadcast_and_words_written_once(spark):
    from quarry.plans import catalog
    root = "/root/testdata/sf0.001"
    assert "strategy=broadcast" in catalog.QUERIES["count_vectors"](spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert all("/nb-ml/" in f for f in catalog.QUERIES["nb_ml_predictions"](spark, root).inputFiles())
