"""The correctness gate in miniature: registered queries vs their DuckDB
oracles on sf0.001 (row count, column names, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from trawl.sources.tables import TABLES

FAST = ["gopher_filter", "text_kept_ratio", "mask_pii", "pii_totals", "normalize_text",
        "word_ngrams", "line_frequencies", "dedup_lines", "strip_tags", "preview",
        "extract_reference_urls", "urls_per_shard", "assign_chunks", "train_test_split",
        "document_frequency", "last_record_per_uri", "common_uris", "minhash_signature",
        "dedup_minhash", "archive_records", "sampled_archive_masks", "sample_half", "exact_jaccard_documents",
        "write_url_list", "scan_path_manifest", "sentence_counts", "document_store"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["outcome", "n_docs", "kept_chars"]
    assert sum(r.n_docs for r in rows) == 200
