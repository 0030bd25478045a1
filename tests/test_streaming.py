"""Incremental filter: a rerun processes only newly arrived files."""

import gzip
import os
import tempfile

from pyspark.sql import functions as F

from trawl.streaming.incremental import (incremental_file_shares, incremental_kept_ratio, incremental_language_filter, latest_totals,
                                         running_kept_ratio)


def _wet(path, items):
    with open(path, "wb") as f:
        for uri, text in items:
            b = text.encode()
            rec = (b"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: " + uri.encode()
                   + b"\r\nContent-Length: " + str(len(b)).encode() + b"\r\n\r\n" + b + b"\r\n\r\n")
            f.write(gzip.compress(rec))


def test_rerun_processes_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="trawl-r1-")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    os.makedirs(src)
    keep = F.col("text").startswith("EN ")
    _wet(os.path.join(src, "a.warc.wet.gz"), [("http://a/1", "EN one"), ("http://a/2", "FR un")])
    incremental_language_filter(spark, src, out, ck, keep)
    assert spark.read.parquet(out).count() == 1
    incremental_language_filter(spark, src, out, ck, keep)       # nothing new
    assert spark.read.parquet(out).count() == 1
    _wet(os.path.join(src, "b.warc.wet.gz"), [("http://b/1", "EN two"), ("http://b/2", "EN three")])
    incremental_language_filter(spark, src, out, ck, keep)
    assert sorted(r.uri for r in spark.read.parquet(out).collect()) == ["http://a/1", "http://b/1", "http://b/2"]
    body = "EN x\r\nWARC/1.0\r\ny"
    _wet(os.path.join(src, "c.warc.wet.gz"), [("http://c/1", body)])
    with open(os.path.join(src, "d.warc.wet.gz"), "wb") as f:
        f.write(gzip.compress(b"WARC/1.0\r\nWARC-Type: conversion\r\nContent-Length: 99\r\n\r\nEN cut"))
    incremental_language_filter(spark, src, out, ck, keep)
    rows = {r.uri: r.text for r in spark.read.parquet(out).collect()}
    assert len(rows) == 4 and rows["http://c/1"] == body        # a payload with a separator is whole
    assert [r.reason for r in spark.read.parquet(out + "-rejected").collect()] == ["truncated"]
    assert incremental_language_filter(spark, src, out, ck, lambda t: True) == 0
    ratio_out, ratio_ck = os.path.join(base, "r2"), os.path.join(base, "r2ck")
    incremental_kept_ratio(spark, src, ratio_out, ratio_ck, keep)
    stats = spark.read.parquet(ratio_out)
    r = stats.agg(F.sum("total_chars"), F.sum("skipped_chars")).first()
    assert tuple(r) == (6 + 5 + 6 + 8 + len(body), 5)
    assert stats.select("chunk").distinct().count() == 3     # one chunk per file here


def test_a_chunk_in_three_batches_has_one_total_after_restarts(spark):
    base = tempfile.mkdtemp(prefix="trawl-r2-")
    src, shares, out, ck1, ck2 = (os.path.join(base, x) for x in ("src", "shares", "out", "ck1", "ck2"))
    keep = F.col("text").startswith("EN ")
    manifest = spark.createDataFrame([("a", 3), ("b", 1)], "chunk string, n_files int")
    want = {}
    for i, (chunk, texts) in enumerate([("a", ["EN one", "FR un"]), ("b", ["EN x"]), ("a", ["EN three"]), ("a", ["", "no"])]):
        os.makedirs(os.path.join(src, f"chunk={chunk}"), exist_ok=True)
        _wet(os.path.join(src, f"chunk={chunk}", f"{i}.warc.wet.gz"), [(f"http://{i}/{k}", t) for k, t in enumerate(texts)])
        incremental_file_shares(spark, src + "/*", shares, ck1, keep)
        assert running_kept_ratio(spark, shares, manifest, out, ck2) == 1      # each call is a stream started anew
        n, skip, files = want.get(chunk, (0, 0, 0))
        want[chunk] = (n + sum(map(len, texts)), skip + sum(len(t) for t in texts if not t.startswith("EN ")), files + 1)
        got = {r.chunk: (r.total_chars, r.skipped_chars, r.files) for r in latest_totals(spark, out).collect()}
        assert got == want
    last = {r.chunk: r for r in latest_totals(spark, out).collect()}
    assert last["a"].complete and last["b"].complete and last["a"].kept_pct == round(100 * 14 / 21, 2)
    assert not spark.read.parquet(out).where("chunk = 'a' AND files = 2").first().complete
    # the stage before replays a batch under another name: files counted already stay counted once
    spark.read.parquet(shares).where("batch_id = 0").drop("batch_id").write.parquet(os.path.join(shares, "batch_id=77"))
    running_kept_ratio(spark, shares, manifest, out, ck2)
    assert {r.chunk: (r.total_chars, r.skipped_chars, r.files) for r in latest_totals(spark, out).collect()} == want
