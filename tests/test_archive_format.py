"""The archive data source: bytes in = bytes out at any range size, damage, nested archives, commits."""

import os
import random
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trawl.sources import archive_format as A


def record(kind, uri, block, extra=b""):
    head = b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\n" + extra
    head += (b"WARC-Target-URI: " + uri + b"\r\n") if uri else b""
    return head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def sample_records():
    rng = random.Random(4)
    recs = [(b"warcinfo", None, b"software: x\r\n")]
    for i in range(60):
        body = rng.randbytes(rng.choice([0, 1, 50, 3000])) if i % 3 else ("é 你 text %d\n" % i).encode() * rng.randrange(80)
        recs.append((b"conversion" if i % 4 else b"response", b"http://h%d/%d" % (i % 7, i), body))
    inner = b"".join(record(b"conversion", b"http://inner/%d" % i, b"carried " * 30) for i in range(5))
    zipped = b"".join(gz(record(b"conversion", b"http://zipped/%d" % i, rng.randbytes(40))) for i in range(5))
    return recs + [(b"response", b"http://carrier/1", inner), (b"response", b"http://carrier/2", zipped),
                   (b"metadata", b"http://h/last", b"WARC/1.0 is not a head")]


def gz(data, level=6):
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def stored_forms():
    """The same records as plain text, a member a record (packed or stored), one member, and members of several records."""
    raw = [record(k, u, b, b"X-Own: kept as it is\r\n") for k, u, b in sample_records()]
    return {"plain.warc": b"".join(raw), "members.warc.gz": b"".join(map(gz, raw)),
            "stored.warc.gz": b"".join(gz(r, 0) for r in raw), "one.warc.gz": gz(b"".join(raw)),
            "some.warc.gz": b"".join(gz(b"".join(raw[i:i + 7])) for i in range(0, len(raw), 7)) + gz(b"")}, raw


def walked(path, range_bytes, wanted=None):
    reader = A.ArchiveReader(path, tuple(A._TYPES), range_bytes)
    if wanted:
        reader.wanted = wanted
    return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


@pytest.mark.parametrize("range_bytes", [0, 331, 4096, 1 << 20])
@pytest.mark.parametrize("name", sorted(stored_forms()[0]))
def test_every_range_size_gives_every_record_once(tmp_path, name, range_bytes):
    forms, raw = stored_forms()
    (tmp_path / name).write_bytes(forms[name])
    rows = walked(str(tmp_path), range_bytes)
    assert [(r["head"] + r["block"] + b"\r\n\r\n") for r in rows] == raw
    assert all(r["reason"] is None for r in rows)
    assert sum(r["stored"] for r in rows) == len(forms[name]) - (len(gz(b"")) if name.startswith("some") else 0)


@pytest.mark.parametrize("range_bytes", [0, 100, 3000])
@pytest.mark.parametrize("packed", [False, True])
def test_damage_is_rejected_and_costs_only_itself(tmp_path, range_bytes, packed):
    good = [record(b"conversion", b"http://a/%d" % i, b"x" * 300 + b"%d" % i) for i in range(20)]
    bad = good[7][:200]  # cut off inside the payload
    data = [*good[:7], bad, *good[8:15], b"no record at all\r\n", *good[15:]]
    if packed:
        data = [gz(x) for x in data]
        data[7] = data[7][:-6]
    (tmp_path / ("a.warc" + ".gz" * packed)).write_bytes(b"".join(data))
    rows = walked(str(tmp_path), range_bytes)
    got = [r["head"] + r["block"] + b"\r\n\r\n" for r in rows if r["reason"] is None]
    assert got == [x for i, x in enumerate(good) if i != 7]
    assert sum(r["stored"] for r in rows) == len(b"".join(data))
    assert {r["reason"] for r in rows if r["reason"]} <= {"truncated", "no header"} and sum(bool(r["reason"]) for r in rows) >= 2
    if not packed:
        assert any(r["reason"] and r["block"].startswith(bad) for r in rows)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    forms, _ = stored_forms()
    (tmp_path / "a.warc.gz").write_bytes(forms["members.warc.gz"])
    df = A.read_archive(spark, str(tmp_path), range_bytes=2000)
    chosen = df.where((F.col("warc_type") == "conversion") & F.col("uri").startswith("http://h1/"))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "") or "StartsWith" not in plan.split("BatchScan")[0]
    want = [(k.decode(), u.decode()) for k, u, _ in sample_records() if k == b"conversion" and u.startswith(b"http://h1/")]
    assert [(r["warc_type"], r["uri"]) for r in chosen.collect()] == want
    assert df.where(F.col("warc_type").isin("response", "metadata")).count() == sum(
        k in (b"response", b"metadata") for k, _, _ in sample_records())
    heads = A.read_archive(spark, str(tmp_path), heads_only=True)
    assert "block" not in heads.columns and heads.count() == len(sample_records())
    kept = A.walk(open(tmp_path / "a.warc.gz", "rb"), len(forms["members.warc.gz"]), True, 0, 1 << 30,
                  A.Wanted(("block",), equal=(("warc_type", ("response",)),)))
    assert {r[3] for r in kept} == {"response"}


def test_written_bytes_come_back(spark, tmp_path):
    forms, raw = stored_forms()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(forms["plain.warc"])
    src = A.read_archive(spark, str(tmp_path / "in"), range_bytes=5000)
    chunked = src.withColumn("chunk", F.when(F.col("uri").isNull(), None).otherwise(F.length("uri") % 3).cast("string"))
    A.write_records(chunked, str(tmp_path / "out"))
    A.write_records(chunked, str(tmp_path / "out"))  # overwrites
    back = A.read_archive(spark, f"file:{tmp_path}/out", range_bytes=3000)
    assert sorted(r["head"] + r["block"] + b"\r\n\r\n" for r in back.collect()) == sorted(raw)
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "out") for f in fs if not f.startswith((".", "_"))]
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {"chunk=" + x for x in ("0", "1", "2", "__HIVE_DEFAULT_PARTITION__")}
    assert sum(open(f, "rb").read().count(b"\x1f\x8b\x08") >= 1 for f in files) == len(files)
    made = spark.createDataFrame([("conversion", "http://x", bytearray(b"abc")), ("warcinfo", None, None)],
                                 "warc_type string, uri string, block binary")
    A.write_records(made, str(tmp_path / "made"))
    assert [(r["warc_type"], r["uri"], bytes(r["block"])) for r in A.read_archive(spark, str(tmp_path / "made")).orderBy("warc_type").collect()] == [
        ("conversion", "http://x", b"abc"), ("warcinfo", None, b"")]


def test_a_failed_job_leaves_no_part(spark, tmp_path):
    path = str(tmp_path / "out")
    good = spark.range(40, numPartitions=4).select(F.lit("conversion").alias("warc_type"), F.concat(F.lit("http://a/"), "id").alias("uri"),
                                                   F.lit(b"first").alias("block"))
    A.write_records(good, path)
    before = {f: open(os.path.join(path, f), "rb").read() for f in os.listdir(path)}
    broken = good.withColumn("uri", F.when(F.col("uri") == "http://a/39", F.raise_error(F.lit("lost"))).otherwise(F.col("uri")))
    with pytest.raises((PySparkException, Exception), match="lost"):
        A.write_records(broken, path)
    assert {f: open(os.path.join(path, f), "rb").read() for f in os.listdir(path)} == before


def test_point_reads_return_what_the_scan_returns(spark, tmp_path):
    forms, _ = stored_forms()
    for name, data in forms.items():
        (tmp_path / name).write_bytes(data)
    index = A.index_records(spark, str(tmp_path), range_bytes=3000)
    assert "block" not in index.columns and index.count() == len(forms) * len(sample_records())
    chosen = index.where(F.crc32(F.coalesce("uri", F.lit(""))) % 5 == 0)
    got = A.read_at(chosen, 3)
    scan = A.read_archive(spark, str(tmp_path)).where(F.crc32(F.coalesce("uri", F.lit(""))) % 5 == 0)
    cols = ["file", "offset", "inner", "warc_type", "uri", "content_length", "head", "block"]
    key = lambda r: (r["file"], r["offset"], r["inner"])
    assert sorted(got.select(cols).collect(), key=key) == sorted(scan.select(cols).collect(), key=key)
    assert got.count() > 20


def test_empty_folder_and_unknown_column(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.warc").write_bytes(b"")
    assert A.read_archive(spark, str(tmp_path / "in")).count() == 0
    with pytest.raises(Exception, match="no columns"):
        spark.read.format("warc").schema("other string").load(str(tmp_path / "in")).count()
