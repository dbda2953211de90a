"""Every registered query with a SQL counterpart gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as registered
from parity import connect, difference

SQL = registered.oracle_sql()
QUERIES = registered.queries()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert {q for q in set(QUERIES) - set(SQL) if not q.startswith(("op", "pipeline"))} == {"C1_learned_sentences", "F2_distributional", "F5_probed_buckets", "F5_hash_tables", "F5_recall_by_query"}


@pytest.mark.parametrize("name", [n for n in SQL if not n.startswith("op")])
def test_same_rows(spark, small, name):
    sql = SQL[name].replace("/root/testdata/sf0.01/", small + "/")
    got = QUERIES[name](spark, small).toPandas()
    assert difference(got, connect(small).execute(sql).df()) is None


def test_flagship(spark):
    rows = registered.entry(spark).toPandas()
    assert len(rows) == 40 and rows["prompt"].str.contains("Question: ").all()
