"""Plain-file sources and sinks: text corpus (S3), path manifest (S4),
bz2 dump lines (S5), document output (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize


def scan_text_corpus(spark: SparkSession, paths: str | list[str], whole: bool = True, strict: bool = False) -> DataFrame:
    """S3: (path, name, text) one row per file (``wholetext``), or (path, line)
    line-wise. Undecodable bytes become U+FFFD, or with ``strict`` fail the job and name the file."""
    df = spark.read.text(paths, wholetext=whole)
    path = F.col("_metadata.file_path")
    text = F.make_valid_utf8("value")
    if strict:
        text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("not UTF-8: "), path)))
    out = df.select(path.alias("path"), text.alias("text"))
    return out.withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))


def scan_path_manifest(spark: SparkSession, path: str, col: str = "wet_path") -> DataFrame:
    """Headerless gzip list of paths -> (path, file, line_no), line_no from 1 in file order.

    A gzip file is read by one task in order, so numbers are counted there;
    with several files the order is (file, line_no).
    """
    def number(batches):
        import pyarrow as pa

        file, n = None, 0
        for b in batches:
            numbers = []
            for f in b.column(0).to_pylist():
                n = n + 1 if f == file else 1
                file = f
                numbers.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(numbers, type=pa.int64())],
                                             ["file", col, "line_no"])
    df = spark.read.text(path)
    if not all(f.endswith(".gz") for f in df.inputFiles()):
        raise ValueError("a path manifest is a gzip file")
    rows = df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias(col))
    return rows.mapInArrow(number, f"file string, {col} string, line_no long")


def manifest_lines(spark: SparkSession, path: str, col: str = "wet_path") -> DataFrame:
    """S4 over a manifest in several gzip parts: (path, line_no), numbered through the parts in the order of their names.

    Every part is numbered by the task that reads it; the lines before a part are a prefix over one row per part.
    """
    rows = materialize(scan_path_manifest(spark, path, col), "manifest")
    per = rows.groupBy("file").agg(F.max("line_no").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per.select("file", before.alias("before"))
    return rows.join(F.broadcast(offsets), "file").select(col, (F.col("before") + F.col("line_no")).alias("line_no"))


def first_path(manifest: DataFrame, col: str = "wet_path") -> DataFrame:
    """The first path of a manifest (smallest file position)."""
    return manifest.orderBy("file", "line_no").limit(1).select(col)


def scan_dump_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of (bz2, splittable) text dumps; invalid UTF-8 bytes dropped."""
    df = spark.read.text(path)
    raw, genuine = F.col("value"), F.lit("\u0001FFFD\u0002")  # a U+FFFD of the text itself stays
    marked = F.make_valid_utf8(F.replace(raw, F.lit("\ufffd"), genuine))
    fixed = F.when(F.is_valid_utf8(raw), raw).otherwise(
        F.replace(F.replace(marked, F.lit("\ufffd"), F.lit("")), genuine, F.lit("\ufffd")))
    return df.select(F.input_file_name().alias("file"), fixed.alias("line"))


def write_documents(docs: DataFrame, path: str, id_col: str = "doc_id",
                    text_col: str = "text", every: DataFrame | None = None) -> None:
    """One parquet row per surviving document; with ``every`` (the input
    document list) emptied documents are written as ''."""
    out = docs.select(id_col, text_col)
    if every is not None:
        out = every.select(id_col).join(out, id_col, "left").select(
            id_col, F.coalesce(text_col, F.lit("")).alias(text_col))
    out.write.mode("overwrite").parquet(path)


#: Bytes of text that a bucket of the document store holds, about.
BUCKET_BYTES = 256 << 20


def write_document_store(docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text",
                         buckets: int | None = None) -> DataFrame:
    """S7 as a table bucketed and sorted by id: jobs that meet documents by id (line dedup, shingle sets, survivors)
    read the texts where they lie and exchange only the other side.

    The number of buckets follows the bytes of text (one pass over their lengths) unless given; it is not below the
    session's shuffle partitions, for Spark would rather exchange the texts than join with fewer tasks. Returns the table.
    """
    if buckets is None:
        total = docs.agg(F.sum(F.octet_length(text_col)).cast("long")).first()[0] or 0
        buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    (docs.repartition(buckets, id_col).write.mode("overwrite").bucketBy(buckets, id_col).sortBy(id_col)
     .option("compression", "zstd").saveAsTable(name))
    return docs.sparkSession.table(name)
