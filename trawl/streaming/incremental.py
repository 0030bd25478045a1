"""Incremental processing of newly arrived archive files.

A file stream that lists the archive folder (names only, no contents)
remembers in its checkpoint which files it has handed out, so a rerun with
``trigger(availableNow=True)`` processes only new files and extends the
output -- the Spark form of "completed chunks are reused". Every micro-batch
reads its files with the batch archive reader: the same repair, the same
rejects. Each batch writes partitions named by its id and replaces them when
it is replayed. Output and checkpoint live in folders given by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.extraction import filter_by
from ..sources.warc import conversions, kept_share, read_records

#: Files of a micro-batch: their names go through the driver.
MAX_FILES = 1000
Keep = Column | Callable
#: Keyed state with several columns needs the RocksDB state store.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_archives(spark: SparkSession, src: str, checkpoint: str,
                 process: Callable[[list[str], int], None], max_files: int = MAX_FILES) -> int:
    """Hand the names of files not seen before to ``process(files, batch_id)``; number of batches run."""
    names = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files)
             .schema("path string, modificationTime timestamp, length long, content binary")
             .load(src).select("path"))
    ran = []

    def batch(df: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in df.collect())  # max_files names at most
        if files:
            process(files, batch_id)
            ran.append(batch_id)
    q = (names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(ran)


def _write(df: DataFrame, out: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))


def incremental_language_filter(spark: SparkSession, src: str, out: str, checkpoint: str, keep: Keep,
                                rejected: str | None = None, max_files: int = MAX_FILES) -> int:
    """Conversion records passing ``keep`` (see ``filter_by``) appended to parquet at ``out``
    as (file, uri, text, batch_id); rows that are no whole record go to ``rejected``
    (default: ``out`` + "-rejected"). Returns the number of micro-batches run."""
    def process(files: list[str], batch_id: int) -> None:
        recs, bad = read_records(spark, files)
        _write(filter_by(conversions(recs), keep).select("file", "uri", "text"), out, batch_id)
        _write(bad, rejected or out.rstrip("/") + "-rejected", batch_id)
    return new_archives(spark, src, checkpoint, process, max_files)


def chunk_of_file(file: Column) -> Column:
    """The chunk a file belongs to: its ``chunk=`` partition folder, else the file."""
    part = F.regexp_extract(file, r"chunk=([^/]+)", 1)
    return F.when(part != "", part).otherwise(file)


def incremental_kept_ratio(spark: SparkSession, src: str, out: str, checkpoint: str, keep: Keep,
                           max_files: int = MAX_FILES,
                           chunk: Callable[[Column], Column] = chunk_of_file) -> int:
    """R2: per micro-batch and chunk, characters seen, characters skipped and kept percent."""
    def process(files: list[str], batch_id: int) -> None:
        recs, _ = read_records(spark, files)
        judged = filter_by(conversions(recs).withColumn("chunk", chunk(F.col("file"))), keep, flag="_k")
        _write(kept_share(judged, "chunk", F.length("text"), F.col("_k")), out, batch_id)
    return new_archives(spark, src, checkpoint, process, max_files)


# ---------------------------------------------------------------- running totals
class ChunkTotals(StatefulProcessor):
    """Per chunk: characters seen and skipped, files seen, over all micro-batches so far.

    A report with a (chunk, file) that the state has counted already changes nothing, so a file that is reported again
    (a replayed batch of the stage before) is counted once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "total long, skipped long, files long, expected long")
        self.seen = handle.getMapState("seen", "file string", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, skipped, files, expected = self.totals.get() if self.totals.exists() else (0, 0, 0, 0)
        for part in rows:
            for file, n, skip, want in zip(part["file"], part["total_chars"], part["skipped_chars"], part["expected"], strict=True):
                expected = max(expected, int(want))
                if self.seen.containsKey((file,)):
                    continue
                self.seen.updateValue((file,), (int(n),))
                total, skipped, files = total + int(n), skipped + int(skip), files + 1
        self.totals.update((total, skipped, files, expected))
        yield pd.DataFrame({"chunk": [key[0]], "total_chars": [total], "skipped_chars": [skipped], "files": [files],
                            "expected": [expected]})

    def close(self) -> None:
        pass


_TOTALS = "chunk string, total_chars long, skipped_chars long, files long, expected long"


def incremental_file_shares(spark: SparkSession, src: str, out: str, checkpoint: str, keep: Keep, max_files: int = MAX_FILES,
                            chunk: Callable[[Column], Column] = chunk_of_file) -> int:
    """R2, first stage: (chunk, file, total_chars, skipped_chars) of every new file, a row per file and batch."""
    def process(files: list[str], batch_id: int) -> None:
        recs, _ = read_records(spark, files)
        judged = filter_by(conversions(recs), keep, flag="_k")
        n = F.length("text")
        per = judged.groupBy("file").agg(F.sum(n).cast("long").alias("total_chars"),
                                         F.sum(F.when(F.col("_k"), 0).otherwise(n)).cast("long").alias("skipped_chars"))
        _write(per.withColumn("chunk", chunk(F.col("file"))), out, batch_id)
    return new_archives(spark, src, checkpoint, process, max_files)


def running_kept_ratio(spark: SparkSession, shares: str, manifest: DataFrame, out: str, checkpoint: str,
                       max_files: int = MAX_FILES) -> int:
    """R2, second stage: totals per chunk over all batches, as keyed state of a stream over the file shares.

    ``manifest``: (chunk, n_files), the files that a chunk will have. Every batch appends the chunks that it changed to
    ``out`` as (chunk, total_chars, skipped_chars, kept_pct, files, expected, complete, batch_id); the state is in the
    checkpoint, so a restarted stream goes on from it. Returns the number of batches run.
    """
    old = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        new = (spark.readStream.schema("file string, total_chars long, skipped_chars long, chunk string, batch_id int")
               .option("maxFilesPerTrigger", max_files).parquet(shares))
        known = new.join(manifest.select("chunk", F.col("n_files").cast("long").alias("expected")), "chunk", "left")
        totals = (known.withColumn("expected", F.coalesce("expected", F.lit(0)))
                  .select("chunk", "file", "total_chars", "skipped_chars", "expected").groupBy("chunk")
                  .transformWithStateInPandas(ChunkTotals(), _TOTALS, "Update", "None"))
        ran = []

        def batch(df: DataFrame, batch_id: int) -> None:
            share = df.withColumn("kept_pct", F.when(F.col("total_chars") > 0, F.round(
                100.0 * (F.col("total_chars") - F.col("skipped_chars")) / F.col("total_chars"), 2)).otherwise(F.lit(0.0)))
            _write(share.withColumn("complete", F.col("files") == F.col("expected")), out, batch_id)
            ran.append(batch_id)
        q = (totals.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, old) if old else spark.conf.unset(STATE_STORE)
    return len(ran)


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    """The last row of every chunk that ``running_kept_ratio`` wrote."""
    cols = ["total_chars", "skipped_chars", "kept_pct", "files", "expected", "complete"]
    last = F.max_by(F.struct(*cols), F.struct("batch_id", "files")).alias("l")
    return spark.read.parquet(out).groupBy("chunk").agg(last).select("chunk", *[f"l.{c}" for c in cols])
