"""Registered queries on edge-case and empty tables; SQL where there is an oracle."""

import math
import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from edge_tables import edge_dir, empty_dir  # noqa: E402, F401  (fixtures)
from trawl.llm.catalog import ORACLES, QUERIES  # noqa: E402


def rows_of(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return cols, sorted((tuple(norm(x.item() if hasattr(x, "item") else x) for x in r)
                         for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_edge_cases_match_sql(spark, edge_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{edge_dir}/{t}.parquet/*.parquet')")
    assert rows_of(QUERIES[name](spark, edge_dir).toPandas()) == rows_of(con.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op1_url_filters", "op12_centroid_clusters"}))
def test_a_row_per_document(spark, edge_dir, name):
    got = QUERIES[name](spark, edge_dir).select("doc_id").toPandas()["doc_id"].tolist()
    want = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id").toPandas()["doc_id"].tolist()
    assert sorted(got) == sorted(want)
