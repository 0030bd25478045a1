"""Archive scans on generated archives: edge records, damage in the middle, byte accounting."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from trawl.sources import warc as W


def _rec(wtype, uri, block: bytes, extra=b"", version=b"0", length=None):
    h = b"WARC/1." + version + b"\r\nWARC-Type: " + wtype.encode() + b"\r\n"
    if uri:
        h += b"WARC-Target-URI: " + uri.encode() + b"\r\n"
    h += extra + b"Content-Length: " + str(len(block) if length is None else length).encode() + b"\r\n\r\n"
    return h + block + b"\r\n\r\n"


def _http(ctype, body: bytes):
    return b"HTTP/1.1 200 OK\r\nContent-Type: " + ctype.encode() + b"\r\n\r\n" + body


def _write_multi_member(path, records):
    with open(path, "wb") as f:
        for r in records:
            f.write(gzip.compress(r))


def _fixture_dir():
    return tempfile.mkdtemp(prefix="trawl-warc-")


def _archive(records, plain=False):
    d = _fixture_dir()
    if plain:
        with open(os.path.join(d, "x.warc"), "wb") as f:
            f.write(b"".join(records))
    else:
        _write_multi_member(os.path.join(d, "x.warc.gz"), records)
    return d


def _read(spark, d):
    good, bad = W.read_records(spark, d)
    pos = ("split", "seq")
    return ([(r.uri, bytes(r.block)) for r in good.orderBy(*pos).collect()],
            [(r.uri, bytes(r.block), r.reason) for r in bad.orderBy(*pos).collect()])


def test_scan_warc_edge_records(spark):
    recs = [
        _rec("warcinfo", None, b"software: test\r\n"),
        _rec("request", "http://a.example/", b"GET / HTTP/1.1\r\n\r\n"),
        _rec("response", "http://a.example/", _http("text/html; charset=utf-8", b"<p>first</p>")),
        _rec("response", None, _http("text/html", b"<p>no uri</p>")),
        _rec("response", "http://img.example/x.png", _http("image/png", b"\x89PNG\r\n")),
        _rec("response", "http://latin.example/", _http("text/html; charset=windows-1252", b"<p>caf\xe9</p>")),
        _rec("response", "http://a.example/", _http("text/html", b"<p>second</p>")),
        _rec("response", "http://warc.example/", _http("text/html", b"<pre>\nWARC/1.0\r\nnot a header\n</pre>")),
    ]
    d = _archive(recs)
    html, rejected = W.scan_warc(spark, d, require_html=True)
    rows = {(r.uri, r.html) for r in html.collect()}
    assert ("http://latin.example/", "<p>café</p>") in rows
    assert ("http://warc.example/", "<pre>\nWARC/1.0\r\nnot a header\n</pre>") in rows
    assert all(u is not None for u, _ in rows)
    assert not any("png" in u for u, _ in rows)
    last = {r.uri: r.html for r in W.last_per_uri(html, ["html"]).collect()}
    assert last["http://a.example/"] == "<p>second</p>"
    every, _ = W.scan_warc(spark, d, require_html=False)
    assert every.count() == 6
    assert bytes(every.where(F.col("uri") == "http://latin.example/").first().payload) == b"<p>caf\xe9</p>"
    assert rejected.count() == 0


def test_scan_wet_invalid_utf8(spark):
    recs = [_rec("warcinfo", None, b"x: y\r\n"),
            _rec("conversion", "http://u.example/", "héllo wörld".encode()),
            _rec("conversion", "http://bad.example/", b"ab\xffcd"),
            _rec("conversion", None, b"no uri")]
    texts, rejected = W.scan_wet(spark, _archive(recs))
    assert {r.uri: r.text for r in texts.collect()} == {"http://u.example/": "héllo wörld", "http://bad.example/": "ab\ufffdcd"}
    assert rejected.count() == 0


OK = [_rec("response", f"http://ok{i}/", _http("text/html", b"body %d" % i)) for i in range(4)]
OK_ROWS = [(f"http://ok{i}/", _http("text/html", b"body %d" % i)) for i in range(4)]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("missing", [3, 40, 250, 10**6])
def test_truncated_record_takes_nobody_with_it(spark, plain, missing):
    cut = _rec("response", "http://cut/", b"HTTP/1.1 200 OK\r\n\r\nhal", length=24 + missing)[:-4]
    good, bad = _read(spark, _archive([OK[0], cut, *OK[1:]], plain))
    assert good == OK_ROWS
    assert [(u, r) for u, _, r in bad] == [("http://cut/", "truncated")]


@pytest.mark.parametrize("plain", [False, True])
def test_payloads_with_separators_and_whole_records_inside(spark, plain):
    lines = b"a\r\nWARC/1.0\r\nb\r\nWARC/1.1\r\nWARC/1.0\r\nc"
    nested = b"archive in archive:\r\n" + OK[2] + OK[3]
    good, bad = _read(spark, _archive([OK[0], _rec("response", "http://lines/", lines), OK[1],
                                       _rec("resource", "http://nested/", nested), OK[2]], plain))
    assert good == [OK_ROWS[0], ("http://lines/", lines), OK_ROWS[1], ("http://nested/", nested), OK_ROWS[2]]
    assert bad == []


def test_both_versions_in_one_archive(spark):
    recs = [_rec("response", f"http://v{v}/{i}", b"x" * i, version=v.encode()) for i in range(1, 4) for v in "10"]
    good, bad = _read(spark, _archive(recs))
    assert good == [(f"http://v{v}/{i}", b"x" * i) for i in range(1, 4) for v in "10"] and bad == []


def test_every_byte_is_accounted_for(spark):
    junk = b"WARC/1.0\r\nno header here\r\n\r\n"
    short = _rec("response", "http://cut/", b"abc", length=99)
    d = _archive([OK[0], junk, short, OK[1], junk, OK[2]])
    good, bad = _read(spark, d)
    assert good == OK_ROWS[:3]
    assert [r for _, _, r in bad] == ["no header", "truncated", "no header"]
    rejected = sum(len(b"WARC/1.") + len(raw) for _, raw, _ in bad)
    assert rejected == 2 * len(junk) + len(short)


def test_uncompressed_archive_cut_into_splits(spark):
    """Records across split borders are joined again, none is lost or doubled."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    recs, want = [], []
    for i in range(120):
        body = (b"line WARC/1.0\r\n" if i % 3 == 0 else b"line\r\n") * (5 + i % 11) + b"%d" % i
        recs.append(_rec("response", f"http://r/{i}", body))
        want.append((f"http://r/{i}", body))
    d = _archive(recs, plain=True)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        good, bad = _read(spark, d)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert sorted(good) == sorted(want) and bad == []


def test_manifest_keeps_file_order(spark, tmp_path):
    from trawl.sources.files import first_path, scan_path_manifest

    paths = [f"crawl/{i * 7919 % 1000:04d}.wet.gz" for i in range(1000)]
    (tmp_path / "m.gz").write_bytes(gzip.compress("".join(p + "\n" for p in paths).encode()))
    got = scan_path_manifest(spark, str(tmp_path / "m.gz"))
    assert [r.wet_path for r in got.orderBy("line_no").collect()] == paths
    assert first_path(got).first().wet_path == paths[0]


def test_dump_lines_keep_genuine_replacement_characters(spark, tmp_path):
    from trawl.sources.files import scan_dump_lines

    (tmp_path / "d.txt").write_bytes("real \ufffd kept".encode() + b" \xff dropped\n" + "only \ufffd\n".encode())
    assert [r.line for r in scan_dump_lines(spark, str(tmp_path)).collect()] == ["real \ufffd kept  dropped", "only \ufffd"]
