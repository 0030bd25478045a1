"""The URL list: order, counts, skip of an unchanged shard set, atomic replacement."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from trawl.sources import url_list as UL


def rows_of(spark, shards, n=50):
    return spark.range(n).crossJoin(spark.createDataFrame([(s,) for s in shards], "shard string")).select(
        "shard", F.col("id").alias("line_no"), F.lit(0).alias("url_pos"), F.concat(F.lit("http://"), "shard", F.lit("/"), "id").alias("url"))


def test_rebuilt_only_when_the_shards_change(spark, tmp_path):
    path = str(tmp_path / "list")
    calls = []

    def refresh(shards):
        names = spark.createDataFrame([(s, 10) for s in shards], "shard string, size long")
        return UL.refresh_url_list(spark, names, lambda: calls.append(1) or rows_of(spark, shards), path)
    assert refresh(["b", "a"]) == (100, True)
    builds = [d for d in os.listdir(path) if d.startswith("build-")]
    files = sorted(f for f in os.listdir(os.path.join(path, builds[0])) if f.startswith("part-"))
    text = "".join(gzip.open(os.path.join(path, builds[0], f), "rt").read() for f in files)
    assert text.split("\n")[:-1] == [f"http://{s}/{i}" for s in "ab" for i in range(50)]
    before = {f: os.stat(os.path.join(path, f)).st_mtime_ns for f in os.listdir(path)}
    assert refresh(["a", "b"]) == (100, False) and len(calls) == 1
    assert {f: os.stat(os.path.join(path, f)).st_mtime_ns for f in os.listdir(path)} == before
    assert refresh(["a", "b", "c"]) == (150, True) and UL.read_url_list(spark, path).count() == 150
    assert len([d for d in os.listdir(path) if d.startswith("build-")]) == 1
    assert refresh([]) == (0, True) and UL.read_url_list(spark, path).count() == 0


def test_a_failed_rebuild_leaves_the_old_list(spark, tmp_path):
    path = str(tmp_path / "list")
    one = spark.createDataFrame([("a",)], "shard string")
    assert UL.refresh_url_list(spark, one, lambda: rows_of(spark, ["a"]), path) == (50, True)
    broken = rows_of(spark, ["a", "z"]).withColumn("url", F.when(F.col("shard") == "z", F.raise_error(F.lit("gone"))).otherwise(F.col("url")))
    with pytest.raises(Exception, match="gone"):
        UL.refresh_url_list(spark, spark.createDataFrame([("a",), ("z",)], "shard string"), lambda: broken, path)
    assert UL.read_url_list(spark, path).count() == 50
    assert not [d for d in os.listdir(path) if d.startswith("_staging")]


def test_digest_ignores_order_and_sees_content(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "s string, n long")
    assert UL.shard_set_digest(a) == UL.shard_set_digest(a.orderBy(F.desc("s")).repartition(5))
    assert UL.shard_set_digest(a) != UL.shard_set_digest(spark.createDataFrame([("x", 1), ("y", 3)], "s string, n long"))
