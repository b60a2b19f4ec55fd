"""The registry: names, SQL for the engine's queries on the smallest tables, and independence of the corpus operators."""

import os

import pytest

import __spark_entry__
from caesura.plans.oracles import ORACLES
from caesura.plans.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


def test_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(QUERIES)


def test_nothing_else_imports_the_corpus_operators():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(root, "caesura")):
        if os.sep + "llm" not in folder:
            for name in names:
                if name.endswith(".py"):
                    assert "caesura.llm" not in open(os.path.join(folder, name)).read()


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no driver tables")
@pytest.mark.parametrize("name", ["sentence_rows", "window_rows", "student_examples", "parse_issues", "boundary_scores", "segmentation_scores", "routed_results", "training_summary"])
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    got, want = QUERIES[name](spark, TABLES).toPandas(), con.execute(ORACLES[name]).df()
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = lambda x: sorted(map(str, x[names].astype(object).where(x[names].notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
