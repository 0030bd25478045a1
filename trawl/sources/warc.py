"""WARC / WET archives as DataFrames (S1, S2, S6) with the built-in text source.

``parse_archive`` reads an archive once with ``lineSep = "WARC/1."`` and splits
it losslessly into records (``sources/records.py``); rows that are no whole
record carry a reason and are returned by every scan as its second frame. A
.gz file (also multi-member) is one task; uncompressed files are split, and
only the pieces at split edges are shuffled, by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import declared_charset, decode_bytes
from ..operators.extraction import filter_by
from ..session import materialize
from .archive_format import write_records
from .records import SCHEMA, join_edges, split_records
from .tables import spread

VERSION_LINE = "WARC/1.0\r\n"
CRLF2 = "\r\n\r\n"
_UNSPLITTABLE = (".gz", ".zst", ".deflate", ".snappy")


def _hdr(block_text: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(block_text, r"(?im)^" + name + r":[ \t]*([^\r\n]*)", 1), F.lit(""))


def parse_archive(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, seq, warc_type, uri, content_length, block, reason): records in file
    order by (split, seq); ``reason`` is null for whole records, else why a row is none."""
    raw = spark.read.option("lineSep", "WARC/1.").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"))
    if all(f.endswith(_UNSPLITTABLE) for f in raw.inputFiles()):
        return raw.mapInArrow(split_records(edges=False), SCHEMA)
    rows = raw.mapInArrow(split_records(edges=True), SCHEMA)
    edge = F.coalesce(F.col("reason") == "edge", F.lit(False))
    joined = rows.where(edge).groupBy("file").applyInArrow(join_edges, SCHEMA)
    return rows.where(~edge).unionByName(joined)


def read_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): whole records, and every other byte of the archive with a reason."""
    rows = parse_archive(spark, path)
    return rows.where(F.col("reason").isNull()).drop("reason"), rows.where(F.col("reason").isNotNull())


def scan_warc(spark: SparkSession, path: str | list[str], require_html: bool = True,
              record_type: str = "response") -> tuple[DataFrame, DataFrame]:
    """((file, split, seq, uri, content_type, payload binary, html), rejected) of ``response`` records.

    ``require_html`` (variant B): URI present and Content-Type containing
    'text/html'; otherwise every response is kept (variant A). The header
    filter runs before any decoding; text is decoded only for kept rows.
    """
    recs, rejected = read_records(spark, path)
    recs = spread(recs.where(F.col("warc_type") == record_type))
    hhead = F.substring_index(F.col("block").cast("string"), CRLF2, 1)
    ctype = F.coalesce(_hdr(hhead, "Content-Type"), F.lit(""))
    payload = F.substring("block", F.octet_length(hhead) + 5, 2_147_483_647)
    out = recs.select("file", "split", "seq", "uri", ctype.alias("content_type"), payload.alias("payload"))
    if require_html:
        out = out.where(F.col("uri").isNotNull() & F.col("content_type").contains("text/html"))
    cs = declared_charset(F.col("content_type"), F.col("payload"))
    return out.withColumn("html", decode_bytes(F.col("payload"), cs)), rejected


def conversions(records: DataFrame) -> DataFrame:
    """(file, split, seq, uri, text) of ``conversion`` records, URI required, UTF-8 with U+FFFD replacement."""
    recs = records.where((F.col("warc_type") == "conversion") & F.col("uri").isNotNull())
    return recs.select("file", "split", "seq", "uri", F.make_valid_utf8(F.col("block").cast("string")).alias("text"))


def scan_wet(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(texts of ``conversion`` records, rejected)."""
    recs, rejected = read_records(spark, path)
    return conversions(recs), rejected


def last_per_uri(df: DataFrame, cols: list[str]) -> DataFrame:
    """W1 on archives: the last record of a repeated URI wins (by file, split, seq)."""
    rec = F.struct(*[F.col(c) for c in cols])
    pos = F.struct("file", "split", "seq")
    return (df.groupBy("uri").agg(F.max_by(rec, pos).alias("_r"))
            .select("uri", *[F.col(f"_r.{c}").alias(c) for c in cols]))


# ---------------------------------------------------------------- writers
def _record(warc_type: Column, uri: Column, block: Column) -> Column:
    """One WARC record: headers, blank line, block (text or bytes, unchanged)."""
    block = block.cast("binary")
    head = F.concat(F.lit(VERSION_LINE + "WARC-Type: "), warc_type, F.lit("\r\n"),
                    F.when(uri.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), uri, F.lit("\r\n")))
                    .otherwise(F.lit("")),
                    F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), block)


def write_archive(df: DataFrame, path: str, warc_type: Column, uri: Column, block: Column,
                  partition_by: str | None = None) -> None:
    """Write records as gzip text (records end with the blank-line separator)."""
    rec = _record(warc_type, uri, F.coalesce(block.cast("binary"), F.lit(b""))).cast("string")
    out = df.select(*([partition_by] if partition_by else []), rec.alias("value"))
    w = out.write.mode("overwrite").option("lineSep", CRLF2).option("compression", "gzip")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)


def text_to_wet(docs: DataFrame, path: str, uri_col: str = "url", text_col: str = "text",
                partition_by: str | None = None) -> None:
    """Derived WET archive: one ``conversion`` record per text."""
    cols = [F.lit("conversion").alias("t"), F.col(uri_col).alias("u"), F.col(text_col).alias("b")]
    if partition_by:
        cols.append(F.col(partition_by))
    write_archive(docs.select(*cols), path, F.col("t"), F.col("u"), F.col("b"), partition_by)


def write_filtered_wet(recs: DataFrame, keep, path: str) -> DataFrame:
    """Archives of the ``conversion`` records that ``keep`` accepts (see ``filter_by``; judged on ``text``) and of all
    records of other types, heads and payloads unchanged, a folder per chunk. Returns the
    per-chunk kept ratio (A4) of the conversion text.

    ``recs``: chunk, warc_type, uri, head, block, as ``archive_format.read_archive`` gives them. Records are read, parsed
    and judged once, into a table; archives and ratio come from it, the ratio from three narrow columns.
    """
    is_conv = F.col("warc_type") == "conversion"
    text = F.when(is_conv, F.make_valid_utf8(F.col("block").cast("string")))
    few = recs.select(F.col("chunk").cast("string").alias("chunk"), "warc_type", "uri", "head", "block", text.alias("text"))
    judged = filter_by(few, keep, flag="kept").withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    judged = materialize(judged.withColumn("kept", ~is_conv | F.col("kept")).drop("text"), "judged")
    write_records(judged.where("kept"), path)
    return kept_share(judged, "chunk", F.col("n"), F.col("kept"))


def _with_percent(share: DataFrame) -> DataFrame:
    return share.withColumn("kept_pct", F.when(F.col("total_chars") > 0, F.round(
        100.0 * (F.col("total_chars") - F.col("skipped_chars")) / F.col("total_chars"), 2)).otherwise(F.lit(0.0)))


def kept_share(df: DataFrame, chunk_col: str, n: Column, keep: Column) -> DataFrame:
    """(chunk, total_chars, skipped_chars, kept_pct)."""
    return _with_percent(df.groupBy(chunk_col).agg(
        F.sum(n).cast("bigint").alias("total_chars"),
        F.sum(F.when(~keep, n).otherwise(0)).cast("bigint").alias("skipped_chars")))
