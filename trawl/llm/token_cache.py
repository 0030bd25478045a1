"""Token counts with a digest cache.

Counts are stored by (tokenizer version digest, content digest). A run digests every
whole text, joins the digests to the stored counts, encodes each distinct missing text
once, appends the new counts to the cache (a Parquet folder) and reads every document's
count from it. Copies cost one encoding, a second run over the same texts none, and another
tokenizer file or library version never meets old counts.

Content is normalised only as far as no count can change: null is the empty text. The
tokenizer's file goes to the executors as a broadcast (its size is checked), so workers
need the library but not the file. Texts cross the network once, those to be encoded only,
and spread by document, not by digest: thousands of copies of a text are one row by then.

Defined results: null text is empty (0 bytes, the empty text's count); rows repeating an
id are counted row by row; null ids are kept; an empty table gives an empty result and
leaves the cache as it is; very long texts are encoded whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import text_of

TOKEN_LIMIT = 4096
MAX_TOKENIZER_BYTES = 64 << 20
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


def tokenizer_library(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def tokenizer_digest(path: str, data: bytes) -> str:
    """Digest of the file and of the library that reads it."""
    library = tokenizer_library(path)
    return hashlib.sha256(f"{library} {version(library)}\n".encode() + data).hexdigest()


def token_counter(library: str, data: bytes) -> Callable[[list[str]], list[int]]:
    """Counts of whole texts as the library gives them: no added special tokens, truncation or padding."""
    if library == "sentencepiece":
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(sp.encode(t, add_bos=False, add_eos=False)) for t in texts]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(data.decode())
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


def digested(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, text): text not null, its SHA-256 beside it."""
    text = text_of(F.col("text"))
    return docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))


def stored_counts(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer; empty before the first append."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two runs may have appended alike


def encode_misses(texts: DataFrame, library: str, data: bytes) -> DataFrame:
    """(digest, n_tokens) of every row of ``texts(digest, text)``."""
    model = texts.sparkSession.sparkContext.broadcast(data)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(library, model.value)
        for b in batches:
            counts = count(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, type=pa.int64())], ["digest", "n_tokens"])
    return texts.mapInArrow(work, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``; the cache holds all counts afterwards."""
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        data = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_path} has over {MAX_TOKENIZER_BYTES} bytes")
    library, tokenizer = tokenizer_library(tokenizer_path), tokenizer_digest(tokenizer_path, data)
    texts = digested(docs)
    keys = materialize(texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-keys")
    known = stored_counts(spark, cache_path, tokenizer)
    misses = (keys.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
              .join(known, "digest", "left_anti").select(F.col("digest").alias("_d"), F.col("doc_id").alias("_id")))
    one_each = texts.join(misses, (texts["digest"] == misses["_d"]) & texts["doc_id"].eqNullSafe(misses["_id"]), "left_semi")
    new = encode_misses(one_each.select("digest", "text"), library, data)
    (new.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
     .select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path))
    return keys.join(stored_counts(spark, cache_path, tokenizer), "digest").select("doc_id", "n_bytes", "n_tokens")


def fresh_cache(spark: SparkSession) -> str:
    """A new cache folder in the cluster's shared folder."""
    return scratch_path(spark, "token-cache")
