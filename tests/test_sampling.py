"""Sampling properties: prefix superset, population check, stable split, ranks."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trawl.operators import sampling as SM
from trawl.sources.tables import table


def test_prefix_sample_is_superset_and_multiple_of_four(spark):
    urls = table(spark, SF_SMALL, "pages").select("url")
    small = {r.url for r in SM.seeded_prefix_sample(urls, 10, key="url").collect()}
    large = {r.url for r in SM.seeded_prefix_sample(urls, 30, key="url").collect()}
    assert len(small) == 8 and len(large) == 28 and small <= large


def test_sample_n_larger_than_population_raises(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id")
    with pytest.raises(ValueError):
        SM.sample_n(docs, 10_000, "doc_id")
    assert SM.sample_n(docs, 10, "doc_id", seed=1).count() == 10


def test_split_stable_under_repartitioning(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id")
    a = {r.doc_id: r.split for r in SM.train_test_split(docs, "doc_id").collect()}
    b = {r.doc_id: r.split for r in SM.train_test_split(docs.repartition(7), "doc_id").collect()}
    assert a == b and 0.1 < sum(v == "test" for v in a.values()) / len(a) < 0.3


def test_global_rank_is_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"))
    ranks = sorted((r.k, r.rank) for r in SM.global_rank(df, [F.col("k")]).collect())
    assert [r for _, r in ranks] == list(range(1, 1001))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_ranks_and_offsets_of_many_wide_rows(spark, coalesce, tmp_path):
    """200,000 rows with columns beside the key, several sort partitions: nothing is lost, counted or written."""
    from trawl.operators.tokens import exclusive_offsets

    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        n = 200_000
        df = spark.range(0, n, 1, 9).select(F.md5(F.col("id").cast("string")).alias("k"), "id",
                                            F.repeat(F.lit("x"), 60).alias("wide"), (F.col("id") % 7).alias("v"))
        ranked = SM.global_rank(df, [F.col("k")])
        assert ranked.count() == n
        ranked.write.parquet(str(tmp_path / "ranked"))
        back = spark.read.parquet(str(tmp_path / "ranked"))
        assert tuple(back.agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()) == (n, n, 1, n)
        assert [r["id"] for r in back.orderBy("rank").limit(50).collect()] == [r["id"] for r in df.orderBy("k").limit(50).collect()]
        offs = exclusive_offsets(df, "id", "v")
        assert offs.count() == n
        bad = offs.where(F.col("offset") != F.floor(F.col("id") / 7) * 21 + (F.col("id") % 7) * (F.col("id") % 7 - 1) / 2)
        assert bad.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
