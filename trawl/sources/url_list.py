"""One gzip URL list over shards, rebuilt only when the set of shards changes.

A build is a folder ``build-<id>`` of gzip parts whose names are in global order (shards sorted, URLs in file order). The
file ``_current`` names the build that counts, with the digest of the shard set it was made from and its number
of URLs; it is replaced in one move when all parts are in place, so a reader sees the old list or the new one. The digest
does not depend on the order of shards or partitions. URLs are counted by the tasks that write them: their commit messages
carry the numbers, and nothing is read a second time.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from .archive_format import Parts, StagedWriter, filesystem

CURRENT = "_current"


class UrlListWriter(StagedWriter):
    def __init__(self, path: str, digest: str):
        super().__init__(path, overwrite=False)
        self.digest, self.build = digest, f"build-{uuid.uuid4().hex[:12]}"

    def records(self, batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
        """A gzip member per batch: members after one another are one gzip file."""
        lines = batch.column(0).to_pylist()
        self.urls += len(lines)
        if lines:
            yield f"{self.build}/", gzip.compress("".join(f"{u}\n" for u in lines).encode(), mtime=0)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Parts:
        self.urls = 0
        parts = super().write(batches)
        return Parts([(staged, final, self.urls, size) for staged, final, _, size in parts.files])

    def commit(self, messages: list[Parts | None]) -> None:
        fs, base = filesystem(self.path)
        before = read_marker(self.path)
        super().commit(messages)
        fs.create_dir(f"{base}/{self.build}", recursive=True)
        n = sum(f[2] for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{base}/_next-{self.build}", compression=None) as f:
            f.write(json.dumps({"build": self.build, "digest": self.digest, "urls": n}).encode())
        fs.move(f"{base}/_next-{self.build}", f"{base}/{CURRENT}")
        if before:
            fs.delete_dir(f"{base}/{before['build']}")


class UrlListSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "url_list"

    def schema(self) -> str:
        return "url string"

    def writer(self, schema: StructType, overwrite: bool) -> UrlListWriter:
        return UrlListWriter(self.options["path"], self.options["digest"])


def read_marker(path: str) -> dict | None:
    """{build, digest, urls} of the list at ``path``; None if there is none."""
    fs, base = filesystem(path.rstrip("/"))
    if fs.get_file_info(f"{base}/{CURRENT}").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{base}/{CURRENT}", compression=None) as f:
        return json.loads(f.read())


def shard_set_digest(shards: DataFrame) -> str:
    """Digest of a set of shards (name, and whatever else tells a shard's content: size, time): one aggregate, any order."""
    h = F.xxhash64(F.struct(*shards.columns))
    r = shards.distinct().agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(7), h))).first()
    return ":".join(str(x) for x in r)


def refresh_url_list(spark: SparkSession, shards: DataFrame, urls: Callable[[], DataFrame], path: str, shard_col: str = "shard",
                     order_cols: tuple[str, ...] = ("line_no", "url_pos")) -> tuple[int, bool]:
    """(URLs in the list, whether it was rebuilt). ``urls`` makes the (shard, order, url) rows; it is not called when
    the list at ``path`` was made from the same set of shards."""
    digest, have = shard_set_digest(shards), read_marker(path)
    if have and have["digest"] == digest:
        return have["urls"], False
    spark.dataSource.register(UrlListSource)
    rows = urls().orderBy(shard_col, *order_cols).select(F.col("url").cast("string").alias("url"))
    rows.write.format("url_list").option("digest", digest).mode("append").save(path)
    return read_marker(path)["urls"], True


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url) of the current build."""
    return spark.read.text(f"{path.rstrip('/')}/{read_marker(path)['build']}").withColumnRenamed("value", "url")
