"""Substring dedup by difference-cover anchors.

A word goes when a window of ``window`` consecutive words covering it also starts in a
document with a smaller doc_id. Windows are judged on the input.

Anchors: words at positions i with (i mod m) in a difference cover D of m; any two
positions a, b have an offset below m at which both are cover positions. So two equal
windows share an aligned anchor of ``window - m + 1`` words, hashed only at cover
positions (m = 7, D = {0, 1, 3}: three of seven positions, anchors of 7 words).

1. Each batch sends its distinct anchor hashes once, packed per hash range (5 bytes an
   anchor; hot anchors collapse in the batch), and each range keeps the hashes seen in two
   documents. They set bits in a filter of fixed size, broadcast: its size is a
   parameter, and when it fills up it only passes more candidates, never fewer.
2. Extension: around every anchor that the filter passes, the windows that contain it are
   candidates. A batch settles its own copies (all but the smallest document of equal
   windows) and sends one row per distinct window on: 96-bit hash and smallest doc_id.
   The smallest doc_id per window over the corpus decides the rest exactly; a window
   has at most a row per batch, whatever its number of copies.
3. Window starts meet their text by document, and the covered words are cut.

Defined results: null texts have no words; rows with a null id neither lose words nor
cause losses; rows sharing an id never cut each other; texts shorter than a window are
kept whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import NOT_SPACE, Words, as_bytes, chunks, mix64, ngram_hashes

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
#: Filter bits (a power of two): 32 MB; give about eight bits or more per shared anchor.
FILTER_BITS_LOG2 = 28
PROBES = 3
RANGES_LOG2, RANGE_TEXT_BYTES = 10, 16 << 20
_U = np.uint64


def check_cover(window: int, period: int, cover: tuple[int, ...]) -> None:
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError(f"{cover} is no difference cover modulo {period}")
    if window < period:
        raise ValueError("the window must be at least as long as the period")


def _texts_with_ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


class _Anchors:
    """Anchor hashes of some texts, with the word position and the text of each."""

    def __init__(self, texts: list[bytes], window: int, period: int, cover: tuple[int, ...]):
        self.words = w = Words(texts, NOT_SPACE)
        self.word_hashes = w.hashes()
        length = window - period + 1
        grams = ngram_hashes(self.word_hashes, length)
        text = w.text_of_word()
        at = np.arange(len(w)) - w.first[text]
        left = w.first[text + 1] - np.arange(len(w))  # words from here to the end of the text
        self.text, self.left = text, left
        self.at = np.flatnonzero(np.isin(at % period, cover) & (left >= length))
        self.hashes = grams[self.at]


#: Of an anchor's hash the upper 47 bits are compared (it only filters); bit 16 is a flag.
_FLAG = _U(1 << 16)


def _key(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(16) << _U(16)) | _FLAG


def _packed(keys: np.ndarray) -> bytes:
    """Five bytes a key: the lowest two are zero and the range tells the highest."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:7]).tobytes()


def _unpacked(blob: bytes, part: int, ranges_log2: int) -> np.ndarray:
    raw = np.zeros((len(blob) // 5, 8), dtype=np.uint8)
    raw[:, 2:7] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 5)
    raw[:, 7] = part >> (ranges_log2 - 8)
    return raw.view("<u8").ravel()


def _probes(key: np.ndarray, range_bits_log2: int) -> Iterator[np.ndarray]:
    """Bit positions of the anchors inside their range's part of the filter."""
    g = mix64(key)
    for i in range(min(PROBES, 64 // range_bits_log2)):
        yield ((g >> _U(i * range_bits_log2)) & _U((1 << range_bits_log2) - 1)).astype(np.int64)


def _shared_filter(docs: DataFrame, window: int, period: int, cover: tuple[int, ...],
                   bits_log2: int, ranges_log2: int) -> np.ndarray:
    """Packed bits, set for the anchors that occur in two or more documents."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, of = [], []
            for first, texts in chunks(b.column(0)):
                a = _Anchors(texts, window, period, cover)
                found.append(_key(a.hashes))
                of.append(a.text[a.at] + first)
            if not found:
                continue
            h, doc = np.concatenate(found), np.concatenate(of)
            order = np.argsort(h, kind="stable")  # documents stay in order within a hash
            h, doc = h[order], doc[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            group = np.cumsum(new) - 1
            twice = np.zeros(int(new.sum()), dtype=bool)
            twice[group[1:][(h[1:] == h[:-1]) & (doc[1:] != doc[:-1])]] = True
            h = np.where(twice, h[new], h[new] ^ _FLAG)  # the flag says: in two documents of this batch
            part = (h >> _U(64 - ranges_log2)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            blobs = [_packed(x) for x in np.split(h, cuts[1:])] if len(h) else []
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts], type=pa.int64()), pa.array(blobs, type=pa.binary())],
                                             ["part", "hashes"])

    def keep_shared(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        h = np.sort(np.concatenate([_unpacked(x, part, ranges_log2) for x in pdf["hashes"]]))
        key = h | _FLAG
        shared = (h & _FLAG) > 0
        shared[1:] |= key[1:] == key[:-1]
        bits = np.zeros(1 << (bits_log2 - ranges_log2), dtype=bool)
        for at in _probes(key[shared], bits_log2 - ranges_log2):
            bits[at] = True
        return pd.DataFrame({"part": [part], "bits": [zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)]})

    sent = docs.select("text").mapInArrow(send, "part long, hashes binary")
    rows = sent.groupBy("part").applyInPandas(keep_shared, "part long, bits binary")
    each = 1 << (bits_log2 - ranges_log2 - 3)
    packed = np.zeros(1 << (bits_log2 - 3), dtype=np.uint8)
    for r in rows.toLocalIterator():  # the fixed-size filter, one range after the other
        packed[r["part"] * each:(r["part"] + 1) * each] = np.frombuffer(zlib.decompress(r["bits"]), dtype=np.uint8)
    return packed


def duplicate_windows(docs: DataFrame, window: int = WINDOW, period: int = PERIOD,
                      cover: tuple[int, ...] = COVER, bits_log2: int = FILTER_BITS_LOG2) -> DataFrame:
    """(doc_id, text_hash, starts): word positions where a window starts that a smaller doc_id has too."""
    check_cover(window, period, cover)
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges_log2 = max(RANGES_LOG2, (total // RANGE_TEXT_BYTES).bit_length())
    bits_log2 = max(bits_log2, ranges_log2 + 3)
    passing = spark.sparkContext.broadcast(_shared_filter(docs, window, period, cover, bits_log2, ranges_log2))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = passing.value
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            keys = b.column(1).to_numpy(zero_copy_only=False)
            h1, h2, doc, start = [], [], [], []
            for first, texts in chunks(b.column(2)):
                a = _Anchors(texts, window, period, cover)
                key = _key(a.hashes)
                base = (key >> _U(64 - ranges_log2)).astype(np.int64) << (bits_log2 - ranges_log2)
                ok = np.ones(len(key), dtype=bool)
                for p in _probes(key, bits_log2 - ranges_log2):
                    p += base
                    ok &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
                passed = a.at[ok]
                near = np.zeros(len(a.words) + 1, dtype=np.int32)  # windows that contain a passed anchor
                np.add.at(near, np.maximum(passed - (period - 1), a.words.first[a.text[passed]]), 1)
                np.add.at(near, passed + 1, -1)
                at = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (a.left >= window))
                if len(at):
                    h1.append(ngram_hashes(a.word_hashes, window, 0)[at])
                    h2.append(ngram_hashes(a.words.hashes(1), window, 1)[at] >> _U(32))
                    doc.append(a.text[at] + first)
                    start.append((at - a.words.first[a.text[at]]).astype(np.int32))
            if not h1:
                continue
            h1, h2, doc, start = map(np.concatenate, (h1, h2, doc, start))
            own = ids[doc]
            order = np.lexsort((own, h2, h1))
            h1, h2, doc, start, own = h1[order], h2[order], doc[order], start[order], own[order]
            new = np.ones(len(h1), dtype=bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            least = own[new][np.cumsum(new) - 1]
            settled, open_ = own > least, np.flatnonzero(own == least)
            open_ = open_[np.lexsort((start[open_], doc[open_]))]  # text order: rows of a document compress
            yield _rows(h1[open_], h2[open_], own[open_], keys[doc[open_]], start[open_], None)
            gone = np.flatnonzero(settled)
            if len(gone):
                gone = gone[np.argsort(doc[gone], kind="stable")]
                cuts = np.flatnonzero(np.diff(doc[gone], prepend=-1))
                d = doc[gone][cuts]
                blobs = [x.tobytes() for x in np.split(start[gone], cuts[1:])]
                yield _rows(keys[d].view(np.uint64), ids[d].view(np.uint64), ids[d], keys[d],
                            np.full(len(d), -1, dtype=np.int32), blobs)

    found = _texts_with_ids(docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())).mapInArrow(
        extend, "h1 long, h2 long, doc_id long, text_hash long, start int, settled binary")
    same = Window.partitionBy("h1", "h2", F.col("settled").isNull())
    gone = (found.withColumn("least", F.min("doc_id").over(same))
            .where(F.col("settled").isNotNull() | (F.col("doc_id") > F.col("least"))))
    return gone.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.when(F.col("settled").isNull(), F.col("start"))).alias("starts"),
        F.collect_list("settled").alias("settled"))


def _rows(h1, h2, doc, key, start, settled) -> pa.RecordBatch:
    blobs = pa.nulls(len(h1), pa.binary()) if settled is None else pa.array(settled, type=pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(doc, type=pa.int64()),
         pa.array(key, type=pa.int64()), pa.array(start, type=pa.int32()), blobs],
        ["h1", "h2", "doc_id", "text_hash", "start", "settled"])


def cut_words(text: bytes, starts: np.ndarray, window: int) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space)."""
    words = text.split()  # bytes.split() knows exactly the six ASCII blanks
    if not len(starts):
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    keep = np.cumsum(edge[:-1]) == 0
    kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    return len(words), len(words) - len(kept), b" ".join(kept)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, period: int = PERIOD,
                     cover: tuple[int, ...] = COVER, bits_log2: int = FILTER_BITS_LOG2) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of ``docs``."""
    gone = duplicate_windows(docs, window, period, cover, bits_log2)
    texts = _texts_with_ids(docs)
    joined = texts.join(gone, ["doc_id", "text_hash"], "left").select("doc_id", "text", "starts", "settled")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, settled = b.column(2), b.column(3)
            rows = []
            for i, t in enumerate(as_bytes(b.column(1))):
                at = lists[i].values
                own = [np.frombuffer(x, dtype=np.int32) for x in settled[i].as_py() or ()]
                if at is not None and len(at):
                    own.append(at.to_numpy(zero_copy_only=False))
                rows.append(cut_words(t, np.concatenate(own) if own else np.zeros(0, dtype=np.int32), window))
            n, removed, kept = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, type=pa.int64()), pa.array(removed, type=pa.int64()),
                 pa.array(kept, type=pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")
