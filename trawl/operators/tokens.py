"""Tokenising and packing training windows.

K1: byte-level BPE ids (50,257 entries, end-of-text 50256 after every
document) from an Arrow UDF, or word ids by corpus frequency over the same
id range (``word_token_ids``), which SQL can check. Packing takes either; the
token table is written once and read by every later step.
K2: documents' token counts -> global offsets by a two-level prefix sum
(per-partition totals, a prefix over those few rows, a running sum inside
each partition) -> each document emits one *segment* per window it touches
(never one row per token) -> segments regrouped by window (a group holds at
most context_length + 1 tokens) -> (x, y) with y shifted by one.
K3: seeded uniform start offsets; offsets tell the documents each sample
touches, and only their tokens are fetched.
K4: token budget arithmetic over the corpus token count.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sampling import numbered, partition_offsets, seeded_key

# ---------------------------------------------------------------------------
# FIXED VALUES -- vocabulary size, end-of-text id, default context length.
# ---------------------------------------------------------------------------
VOCAB_SIZE = 50_257
END_OF_TEXT = 50_256
CONTEXT_LENGTH = 512
#: Word ids: the most frequent words, then one id for all other words, then end-of-text.
OTHER_WORD = END_OF_TEXT - 1


@functools.lru_cache(maxsize=1)
def _encoder():
    try:
        import public_tokenizers as pt
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe
    except ImportError as e:  # pragma: no cover - environment without the vocabulary
        raise RuntimeError("byte-level BPE vocabulary not available") from e
    ranks = load_tiktoken_bpe(pt.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding(name="byte_bpe_50k", pat_str=pt.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": END_OF_TEXT})


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _encode(texts: pa.Array) -> pa.Array:
    enc = _encoder()
    ids = [np.array([*enc.encode_ordinary(t.as_py() or ""), END_OF_TEXT], dtype=np.int32) for t in texts]
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, dtype=np.int32), *ids])))


def tokenize_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """K1: (doc_id, tokens array<int>, n_tokens). int, not short: ids reach 50,256."""
    t = docs.select(F.col(id_col).alias("doc_id"), _encode(F.col(text_col)).alias("tokens"))
    return t.withColumn("n_tokens", F.size("tokens").cast("bigint"))


def words(text: Column) -> Column:
    """Lower-cased words separated by ASCII white space."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[^\x20\x09-\x0D]+"), 0)


def word_vocabulary(docs: DataFrame, text_col: str = "text", size: int = OTHER_WORD) -> DataFrame:
    """(word, id): the ``size`` most frequent words, ids from 0 by falling count, then word."""
    counts = (docs.select(F.explode(words(F.col(text_col))).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.col("n").desc(), "word").limit(size)
    rank = F.row_number().over(Window.orderBy(F.col("n").desc(), "word"))  # over the top ``size`` only
    return top.select("word", (rank - 1).cast("int").alias("id"))


def word_token_ids(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, tokens, n_tokens): vocabulary ids of the words, end-of-text last.

    The vocabulary has at most ``OTHER_WORD`` rows, so it is sent to the
    workers; documents are not shuffled.
    """
    rows = vocabulary.limit(OTHER_WORD).toPandas()  # OTHER_WORD rows at most
    sent = docs.sparkSession.sparkContext.broadcast((pa.array(rows["word"].tolist(), type=pa.string()),
                                                     rows["id"].to_numpy(dtype=np.int32)))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = sent.value
        for b in batches:
            lists = b.column(1)
            at = pc.index_in(lists.flatten(), value_set=known)
            found = at.fill_null(-1).to_numpy(zero_copy_only=False)
            one = np.append(number, np.int32(OTHER_WORD))[found]  # -1: the last, any other word
            ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
            tokens = np.insert(one, ends, END_OF_TEXT)
            starts = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(starts), pa.array(tokens.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), out, pa.array(np.diff(starts).astype(np.int64))],
                                             ["doc_id", "tokens", "n_tokens"])
    few = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    id_type = few.schema["doc_id"].dataType.simpleString()
    return few.mapInArrow(ids, f"doc_id {id_type}, tokens array<int>, n_tokens long")


def exclusive_offsets(df: DataFrame, order_col: str, value_col: str, out: str = "offset") -> DataFrame:
    """(order_col, value, offset) with offset = sum of values of earlier rows.

    Range-partitioned sort, written once; per-partition totals (one row per
    partition) prefixed over those few rows and broadcast; a running sum
    inside each sorted partition. No single-partition step over the data.
    """
    s = numbered(df.select(order_col, value_col), [F.col(order_col)], "offsets")
    offs = partition_offsets(s, F.sum(value_col))
    w_in = Window.partitionBy("_pid").orderBy("_idx").rowsBetween(Window.unboundedPreceding, -1)
    local = s.withColumn("_lo", F.coalesce(F.sum(value_col).over(w_in), F.lit(0)))
    return (local.join(F.broadcast(offs), "_pid")
            .select(order_col, value_col, (F.col("_off") + F.col("_lo")).cast("bigint").alias(out)))


def window_segments(tok: DataFrame, ctx: int = CONTEXT_LENGTH) -> DataFrame:
    """(window, start, seg): the part of each document inside window w's
    span [w*ctx, (w+1)*ctx] (ctx+1 positions: x plus the shifted last y)."""
    offs = exclusive_offsets(tok.select("doc_id", "n_tokens"), "doc_id", "n_tokens")
    t = tok.select("doc_id", "tokens").join(offs.select("doc_id", "n_tokens", "offset"), "doc_id")
    o, n = F.col("offset"), F.col("n_tokens")
    w_lo = F.greatest(F.lit(0), F.floor((o - 1) / ctx)).cast("bigint")
    w_hi = F.floor((o + n - 1) / ctx).cast("bigint")
    t = t.where(n > 0).select("tokens", "offset", "n_tokens",
                              F.explode(F.sequence(w_lo, w_hi)).alias("window"))
    start = F.greatest(o, F.col("window") * ctx)
    end = F.least(o + n - 1, (F.col("window") + 1) * ctx)
    seg = F.slice("tokens", (start - o + 1).cast("int"), (end - start + 1).cast("int"))
    return t.select("window", start.alias("start"), seg.alias("seg")).where(F.size("seg") > 0)


def _joined(segments: Column) -> Column:
    """Segments (start, seg) of one span in order, as one array."""
    return F.flatten(F.transform(F.array_sort(segments), lambda s: s["seg"]))


def pack_windows(tok: DataFrame, ctx: int = CONTEXT_LENGTH) -> DataFrame:
    """K2: (window, x, y) for every complete window of the concatenated stream."""
    segs = window_segments(tok, ctx)
    xy = segs.groupBy("window").agg(_joined(F.collect_list(F.struct("start", "seg"))).alias("xy"))
    xy = xy.where(F.size("xy") == ctx + 1)
    return xy.select("window", F.slice("xy", 1, ctx).alias("x"), F.slice("xy", 2, ctx).alias("y"))


def write_token_windows(tok: DataFrame, path: str, ctx: int = CONTEXT_LENGTH) -> None:
    """Parquet of (window, tokens) for the trainer, every complete window."""
    pack_windows(tok, ctx).select("window", F.col("x").alias("tokens")).write.mode("overwrite").parquet(path)


def sample_windows(tok: DataFrame, batch_size: int, ctx: int = CONTEXT_LENGTH,
                   seed: int = 0) -> DataFrame:
    """K3: (i, s, x, y): ``batch_size`` pairs at uniform start offsets s in [0, L - ctx),
    with replacement, seeded. Samples and documents meet on cells of ``ctx`` positions."""
    spark = tok.sparkSession
    total = tok.agg(F.sum("n_tokens")).first()[0] or 0
    if total <= ctx:
        raise ValueError("token stream shorter than the context length")
    u = F.conv(F.substring(seeded_key("id", seed), 1, 12), 16, 10).cast("double") / float(1 << 48)
    starts = spark.range(batch_size).select(F.col("id").alias("i"),
                                            F.floor(u * (total - ctx)).cast("bigint").alias("s"))
    cells = starts.select("i", "s", F.explode(F.sequence(F.floor(F.col("s") / ctx), F.floor((F.col("s") + ctx) / ctx))).alias("cell"))
    offs = exclusive_offsets(tok.select("doc_id", "n_tokens"), "doc_id", "n_tokens").where("n_tokens > 0")
    last = F.col("offset") + F.col("n_tokens") - 1
    spans = offs.select("doc_id", "n_tokens", "offset", F.explode(F.sequence(
        F.floor(F.col("offset") / ctx), F.floor(last / ctx))).alias("cell"))
    touched = (spans.join(cells, "cell").where((F.col("offset") <= F.col("s") + ctx) & (last >= F.col("s")))
               .select("i", "s", "doc_id", "offset", "n_tokens").distinct())
    start = F.greatest(F.col("s"), F.col("offset"))
    end = F.least(F.col("s") + ctx, F.col("offset") + F.col("n_tokens") - 1)
    seg = F.slice("tokens", (start - F.col("offset") + 1).cast("int"), (end - start + 1).cast("int"))
    got = (tok.select("doc_id", "tokens").join(touched, "doc_id")
           .select("i", "s", F.struct(start.alias("start"), seg.alias("seg")).alias("x"))
           .groupBy("i", "s").agg(_joined(F.collect_list("x")).alias("xy")))
    return got.select("i", "s", F.slice("xy", 1, ctx).alias("x"), F.slice("xy", 2, ctx).alias("y"))


def token_budget(tok: DataFrame, steps: int = 16_384, batch_size: int = 128,
                 context_length: int = CONTEXT_LENGTH, grad_accum: int = 1,
                 world_size: int = 8) -> DataFrame:
    """K4: tokens per step, tokens needed, tokens available, epochs needed."""
    per_step = grad_accum * world_size * batch_size * context_length
    return tok.agg(F.sum("n_tokens").cast("bigint").alias("available_tokens")).select(
        F.lit(per_step).cast("bigint").alias("tokens_per_step"),
        F.lit(per_step * steps).cast("bigint").alias("tokens_needed"),
        "available_tokens",
        (F.lit(float(per_step * steps)) / F.col("available_tokens")).alias("epochs_needed"))
