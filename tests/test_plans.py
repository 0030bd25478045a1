"""Plan shape checks: no cartesian products, no row-at-a-time Python, no
single-partition exchange, filters and projections pushed into the scan."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

CHECKED = ["gopher_filter", "mask_pii", "dedup_lines", "line_frequencies", "minhash_signature",
           "lsh_buckets", "strip_tags", "pages_to_text", "document_frequency", "assign_chunks",
           "extract_reference_urls", "last_record_per_uri", "pack_windows", "tokenize_corpus"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """The plan that ran, after adaptive changes."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = _plan(df)
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", CHECKED)
def test_no_cartesian_no_row_python_no_single_partition(spark, name):
    p = _final_plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p
    # the only single-partition step allowed is the prefix over per-partition
    # totals: right below the exchange there is an aggregate by partition id
    lines = p.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[i + 1:] if not re.search("AQEShuffleRead|ShuffleQueryStage|InputAdapter", x))
            assert re.search(r"HashAggregate\(keys=\[_pid", below) or "LocalLimit" in below, below


def test_report_and_term_counts_read_their_input_once(spark):
    for name in ("document_frequency", "langid_nb_sql"):
        assert _plan(E.queries()[name](spark, SF_SMALL)).split("== Initial Plan ==")[0].count("Scan parquet") == 1


def test_projection_and_filter_reach_the_scan(spark):
    p = _plan(E.queries()["filter_english"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in p


def test_gopher_token_chain_computed_once(spark):
    p = _plan(E.queries()["gopher_filter"](spark, SF_SMALL))
    # 7 tokenizer rules + whitespace collapse + edge trim + line strip = 10
    assert p.count("regexp_replace(") == 10


def test_fast_signatures_normalise_once(spark):
    from trawl.operators import minhash as MH
    from trawl.sources.tables import table

    docs = table(spark, SF_SMALL, "documents")
    p = _plan(MH.signature_table(docs, MH.MinHashParams(mode="fast")))
    assert p.count("translate(") == 1


def test_bucketed_store_spares_the_text_exchange(spark):
    """Line dedup, shingle sets and survivors over a bucketed table: no exchange above the scan of the texts."""
    from pyspark.sql import functions as F

    from trawl.operators import dedup_lines as DL
    from trawl.operators import minhash as MH
    from trawl.sources import files as FS
    from trawl.sources.tables import table

    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    store = FS.write_document_store(docs, "plan_test_store", buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = store.where("doc_id % 3 = 0").select("doc_id").distinct()
        jobs = {"lines": (DL.dedup_lines(store), DL.dedup_lines(docs)),
                "sets": (MH.set_table(store, MH.MinHashParams(), ids), MH.set_table(docs, MH.MinHashParams(), ids)),
                "survivors": (store.join(ids, "doc_id", "left_semi"), docs.join(ids, "doc_id", "left_semi"))}
        for name, (bucketed, plain) in jobs.items():
            rows = sorted(map(repr, bucketed.collect()))
            assert rows == sorted(map(repr, plain.collect())), name
            a, b = _final_plan(plain), _final_plan(bucketed)
            assert a.count(" Exchange hashpartitioning(doc_id") == b.count(" Exchange hashpartitioning(doc_id") + 1, name
            assert any("doc_id#" in x and ",text#" in x and "Bucketed: true" in x for x in b.split("\n")), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE plan_test_store")


def test_python_workers_get_batches_of_bounded_bytes(spark):
    """Rows of 100 kB: a batch is closed by its bytes, not by 10,000 rows; a smaller limit of the session stays."""
    import pyarrow as pa
    from trawl import session as S

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["bytes", "n"])
    rows = spark.range(300, numPartitions=1).selectExpr("repeat('x', 100000) AS t").mapInArrow(sizes, "bytes long, n long").collect()
    assert sum(r.n for r in rows) == 300 and max(r.bytes for r in rows) < 2 * S.BATCH_BYTES
    old = spark.conf.get(S.BATCH_CONF)
    try:
        for given, kept in ((1 << 20, 1 << 20), (1 << 30, S.BATCH_BYTES)):
            spark.conf.set(S.BATCH_CONF, str(given))
            S.ship_package(spark)
            assert int(spark.conf.get(S.BATCH_CONF).rstrip("bB")) == kept
    finally:
        spark.conf.set(S.BATCH_CONF, old)
