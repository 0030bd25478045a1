"""Aggregations: kept-text ratio, PII totals, URL counts, corpus summary,
classification report, document frequency (A4-A9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def text_kept_ratio(df: DataFrame, keep: Column | str, by: list[str] | None = None,
                    text_col: str = "text") -> DataFrame:
    """Characters seen, characters skipped and the kept percentage (A4).

    ``100 * (total - skipped) / total``, 0 when nothing was seen; one
    partial+final aggregate, no join.
    """
    keep_c = F.col(keep) if isinstance(keep, str) else keep
    n = F.length(F.coalesce(F.col(text_col), F.lit("")))
    g = df.groupBy(*(by or []))
    out = g.agg(F.count(F.lit(1)).alias("n_docs"),
                F.sum(keep_c.cast("int")).cast("bigint").alias("n_kept"),
                F.sum(n).cast("bigint").alias("total_chars"),
                F.sum(F.when(~keep_c, n).otherwise(0)).cast("bigint").alias("skipped_chars"))
    pct = F.when(F.col("total_chars") > 0,
                 F.round(F.lit(100.0) * (F.col("total_chars") - F.col("skipped_chars"))
                         / F.col("total_chars"), 4)).otherwise(F.lit(0.0))
    return out.withColumn("kept_pct", pct)


def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support, plus accuracy, macro and weighted avg.

    One aggregate of the confusion counts, written (a row per label pair);
    everything after it is arithmetic over that table, and the input runs once.
    """
    conf = materialize(pred.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p"))
                       .agg(F.count(F.lit(1)).alias("c")), "confusion")
    hit = F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(0)
    sides = (conf.select(F.col("y").alias("class"), hit.alias("tp"), F.col("c").alias("support"), F.lit(0).alias("n_pred"))
             .unionByName(conf.select(F.col("p").alias("class"), F.lit(0).alias("tp"), F.lit(0).alias("support"),
                                      F.col("c").alias("n_pred"))))
    per = sides.groupBy("class").agg(*[F.sum(x).cast("bigint").alias(x) for x in ("tp", "support", "n_pred")])

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)
    per = (per.withColumn("precision", ratio(F.col("tp"), F.col("n_pred")))
           .withColumn("recall", ratio(F.col("tp"), F.col("support"))))
    per = per.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    per = per.select("class", "precision", "recall", "f1", "support")
    measures = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
                    F.sum("support").cast("bigint").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
                       F.sum("support").cast("bigint").alias("support"))
    nothing = F.lit(None).cast("double")
    accuracy = conf.agg(F.lit("accuracy").alias("class"), F.first(nothing).alias("precision"), F.first(nothing).alias("recall"),
                        (F.sum(hit) / F.sum("c")).alias("f1"), F.sum("c").cast("bigint").alias("support"))
    out = per.unionByName(accuracy).unionByName(macro).unionByName(weighted)
    return out.select("class", *[F.round(c, 6).alias(c) for c in measures], "support")


WORD_RE = r"[\p{L}\p{N}_]{2,}"


#: Bytes of joined words whose terms are counted together.
COUNT_BYTES = 1 << 23


def _word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: prefix sums of a polynomial with an odd base."""
    base, n = 0x9E3779B97F4A7C15, len(buf) + 1
    power, back = np.full(n, base, dtype=np.uint64), np.full(n, pow(base, -1, 1 << 64), dtype=np.uint64)
    power[0] = back[0] = 1
    power, back = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    h = (total[ends] - total[starts]) * back[starts] ^ ((ends - starts).astype(np.uint64) << np.uint64(50))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def count_terms(texts: list[bytes]) -> pa.RecordBatch:
    """(term, tf, df) of the 1- and 2-grams of texts, which are words joined by single spaces."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    edge = np.diff((buf != 32).astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(at, starts, side="right")
    words = _word_hashes(buf, starts, ends)
    pair = np.flatnonzero(doc[:-1] == doc[1:])  # bigrams do not cross texts
    both = (words[pair] * np.uint64(0xC2B2AE3D27D4EB4F) + (words[pair + 1] | np.uint64(1))) * np.uint64(0xD6E8FEB86659FD93)
    key = np.concatenate([words, both ^ (both >> np.uint64(32))])
    doc = np.concatenate([doc, doc[pair]])
    first, last = np.concatenate([starts, starts[pair]]), np.concatenate([ends, ends[pair + 1]])
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    tf = np.diff(np.append(at, len(key)))
    df = np.add.reduceat(other.astype(np.int64), at) if len(at) else at
    first, last = first[order[at]], last[order[at]]
    offsets = np.zeros(len(at) + 1, dtype=np.int32)
    np.cumsum(last - first, out=offsets[1:])
    spelled = buf[np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], last - first)]
    term = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(spelled.tobytes()))
    return pa.RecordBatch.from_arrays([term, pa.array(tf.astype(np.int64)), pa.array(df.astype(np.int64))], ["term", "tf", "df"])


def document_frequency(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       top_k: int | None = 50_000, stop_words: list[str] | None = None) -> DataFrame:
    """Corpus term frequency and document frequency of 1- and 2-grams.

    Tokens are maximal runs of >= 2 word characters of the lower-cased text;
    stop words (optional) are removed before bigrams are formed. A task counts the terms of
    ``COUNT_BYTES`` of words at a time and sends a row per distinct term of them, not one per document and
    term; one aggregate adds them up; top_k by tf (term breaks ties). A row is a document, whatever its id.
    """
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD_RE), 0)
    if stop_words:
        sw = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda t: ~F.array_contains(sw, t))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for b in batches:
            for t in b.column(0).cast(pa.large_binary()).to_pylist():
                if t:
                    held.append(t)
                    size += len(t)
                if size >= COUNT_BYTES:
                    yield count_terms(held)
                    held, size = [], 0
        if held:
            yield count_terms(held)
    out = (df.select(F.array_join(toks, " ").alias("ts")).mapInArrow(count, "term string, tf long, df long")
           .groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))
    if top_k is not None:
        out = out.orderBy(F.col("tf").desc(), F.col("term")).limit(top_k)
    return out


def corpus_summary(df: DataFrame, by: str = "source", text_col: str = "text") -> DataFrame:
    """Number of files (documents) and their summed size in UTF-8 bytes."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_files"),
                              F.sum(F.octet_length(text_col)).cast("bigint").alias("total_bytes"))
