"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits: bit b is 1 when over half of the text's shingle hashes
(XXH64, seed 42) have it. Fingerprints within ``max_bits`` = t differing bits are linked.

Anchors are the codewords of a covering code: the perfect Hamming(63, 57) code on 63 bits
(covering radius R = 1: every point is within one bit of exactly one codeword) times the
last bit as it is, 2^58 anchors. Two linked fingerprints have a middle point within
ceil(t/2) bits of both, and the anchor covering that point is within R + ceil(t/2) of
both. So each fingerprint is replicated to every anchor whose cell its ball of radius
ceil(t/2) touches -- together the pair's radii give covering radius plus threshold -- and
fingerprints are compared per anchor. For t = 2 that is 33 copies at most (replicating one
side to R + t takes 652). By geometry an anchor holds at most 4,096 distinct fingerprints for
t = 2, so no group grows with the data. Each anchor returns a spanning forest of its
links, never all pairs.

Distinct fingerprints are taken first (map-side combine): thousands of exact copies are
one point. Components are found on the links by label propagation over DataFrames.

Defined results: a text with fewer than n words is one shingle of all its words; null and
wordless texts have fingerprint zero and are linked like any other; rows repeating an id
are separate members; null ids are ignored by the minimum (component_id is null only if a
group has no id); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import materialize
from .bytewords import chunks
from .common import private

NGRAM, MAX_BITS, HASH_SEED = 3, 2, 42
_LOWER = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
_U = np.uint64


def shingle_hashes(text: bytes, n: int) -> list[int]:
    words = text.translate(_LOWER).split()  # bytes.split() knows exactly the six ASCII blanks
    joined = b" ".join(words)
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)] if words else []
    ends = list(accumulate(len(w) + 1 for w in words))
    h, seed = xxhash.xxh64_intdigest, HASH_SEED
    return [h(joined[a:b - 1], seed) for a, b in zip([0, *ends], ends[n - 1:], strict=False)]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint per run of ``counts`` hashes: bits set in over half of the run."""
    out = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        at = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        packed = np.packbits(2 * ones > counts[some][:, None], axis=1, bitorder="little")
        out[some] = np.ascontiguousarray(packed).view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document, fp the 64 bits as a long."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = []
            for _, texts in chunks(b.column(2)):
                each = [shingle_hashes(t, ngram) for t in texts]
                flat = np.fromiter((h for e in each for h in e), dtype=np.uint64)
                fps.append(majority_bits(flat, np.array([len(e) for e in each], dtype=np.int64)))
            fp = np.concatenate(fps) if fps else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(work, "doc_id long, text_hash long, fp long")


_MASKS = [_U(sum(1 << (j - 1) for j in range(1, 64) if j >> k & 1)) for k in range(6)]


def nearest_anchor(points: np.ndarray) -> np.ndarray:
    """The codeword within one bit: Hamming positions 1..63 are bits 0..62; bit 63 stays."""
    syndrome = np.zeros(points.shape, dtype=np.uint64)
    for k, mask in enumerate(_MASKS):
        syndrome |= (np.bitwise_count(points & mask).astype(np.uint64) & _U(1)) << _U(k)
    flip = np.where(syndrome > 0, _U(1) << ((syndrome - _U(1)) & _U(63)), _U(0))
    return points ^ flip


def anchors_of(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor): distinct anchors of the ball of radius ceil(t/2)."""
    errors = [0]
    for r in range(1, (max_bits + 1) // 2 + 1):
        errors += [sum(1 << i for i in c) for c in combinations(range(64), r)]
    near = np.sort(nearest_anchor(fps[:, None] ^ np.array(errors, dtype=np.uint64)[None, :]), axis=1)
    new = np.ones(near.shape, dtype=bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    return np.nonzero(new)[0], near[new]


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links within ``max_bits`` that connect what one anchor's fingerprints connect."""
    left, links = fps, []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                links += [(x, y) for y in left[near]]
                front += list(left[near])
                left = left[~near]
    return links


def fingerprint_links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(src, dst) links between distinct fingerprints ``points(fp)``, enough to connect all that are linked."""
    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), 4096):
                part = fps[i:i + 4096]
                who, anchor = anchors_of(part, max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(part[who].view(np.int64))],
                                                 ["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            links: list[tuple[int, int]] = []
            cell = b.column(0)
            flat, at = cell.values.to_numpy(zero_copy_only=False).view(np.uint64), cell.offsets.to_numpy()
            pairs = np.flatnonzero(np.diff(at) == 2)
            x, y = flat[at[pairs]], flat[at[pairs] + 1]
            near = np.bitwise_count(x ^ y) <= max_bits
            for i in np.flatnonzero(np.diff(at) > 2):
                links += spanning_links(flat[at[i]:at[i + 1]], max_bits)
            more = np.array(links, dtype=np.uint64).reshape(-1, 2)
            src, dst = np.concatenate([x[near], more[:, 0]]), np.concatenate([y[near], more[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))], ["src", "dst"])

    cells = (points.select("fp").mapInArrow(replicate, "anchor long, fp long")
             .groupBy("anchor").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))
    return (cells.select("fps").mapInArrow(compare, "src long, dst long")
            .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())


def near_duplicates(docs: DataFrame, ngram: int = NGRAM, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, cluster, component_id): cluster is the group's smallest
    fingerprint, component_id its smallest doc_id."""
    fps = materialize(fingerprints(docs, ngram), "simhash-fps")
    points = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-points")
    links = materialize(fingerprint_links(points, max_bits), "simhash-links")
    labels = connected_components(links).select(F.col("node").alias("fp"), F.col("component").alias("cluster"))
    groups = points.join(labels, "fp", "left").select("fp", "first", F.coalesce("cluster", "fp").alias("cluster"))
    ids = groups.groupBy("cluster").agg(F.min("first").alias("component_id"))
    by_fp = groups.select("fp", "cluster").join(ids, "cluster")
    return fps.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "cluster", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_of_each(docs: DataFrame, ngram: int = NGRAM, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near copies: of every group the row with the smallest doc_id stays."""
    first = (near_duplicates(docs, ngram, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("cluster").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
             .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash")))
    same = docs["doc_id"].eqNullSafe(first["_id"]) & (F.xxhash64(docs["text"]) == first["_hash"])
    copies = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(1))
    copy = private(docs.columns, "_copy")
    return (docs.join(first, same, "left_semi").withColumn(copy, F.row_number().over(copies))
            .where(F.col(copy) == 1).drop(copy))
