"""MinHash near-duplicate removal (D2) and its stages.

Stages
------
1. ``signature_table``: normalise -> distinct word n-grams -> exact-set key
   (md5 of the sorted set) -> shingle hashes (for Jaccard) -> signature.
   Two hash families:

   * ``md5``  -- parity with the reference: hash i of shingle s is the
     little-endian uint32 of the first 4 bytes of md5("{i}-{s}"); an empty set
     signs as zeros. The folded text goes to a Java UDF that drops and squeezes
     characters, makes the set key and size too and hashes the shingles of a tile in vector loops
     (``functions/Md5Minima.java``): shingles are byte ranges of the text, no
     strings, H times them never exist as rows, and no text goes to Python.
   * ``fast`` -- one xxhash64 per shingle in the JVM (8 bytes each to Python),
     then H multiply-add-shift hashes and their minima in numpy inside an
     Arrow UDF (vectorised per batch); row-local, no shuffle. Results depend on the family; only md5
     mode matches the oracle.

2. ``band_rows``: (band, key, doc) with key = the band's r signature values.
3. Buckets are taken at *exact-set* granularity: documents with identical
   shingle sets have identical signatures and Jaccard 1, so they collapse to
   their smallest id before any pairing (lossless for the clusters).
4. ``verified_edges``: per bucket components are grown from pivots instead of
   comparing all pairs; connectivity equals that of all verified candidate
   pairs (argument in its docstring).
5. ``connected_components`` over the verified edges, then every document gets
   its exact-set representative's component; one survivor per component.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import md5
from ..functions.text import fold_text, normalize_text, word_ngrams
from ..session import drop_table, java_function, materialize
from .components import connected_components

@dataclass(frozen=True)
class MinHashParams:
    num_hashes: int = 100
    num_bands: int = 10
    ngrams: int = 5
    threshold: float = 0.8
    mode: str = "md5"          # "md5" (reference parity) or "fast"
    seed: int = 1

    def __post_init__(self):
        if self.num_hashes % self.num_bands != 0:
            raise ValueError(f"{self.num_hashes} hashes do not fill {self.num_bands} bands of equal size")
        if self.mode not in ("md5", "fast"):
            raise ValueError(f"unknown mode {self.mode!r}")

    @property
    def rows(self) -> int:
        return self.num_hashes // self.num_bands


# ------------------------------------------------------------------ hashing
def md5_signature_udf(num_hashes: int, ngrams: int):
    """Arrow UDF: normalised text -> md5 signature, row-local. It stands in where the Java UDF cannot be
    compiled, with the same results in ten times the time.

    The shingles are byte ranges of the text (from a word's start to the end of the word n - 1
    further on); repeated ones change no minimum. Texts are taken a bounded number of bytes at a time.
    """
    run = 1 << 20

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def sig(norm: pa.Array) -> pa.Array:
        norm = norm.cast(pa.large_string())
        ends = np.frombuffer(norm.buffers()[1], dtype=np.int64)[norm.offset:norm.offset + len(norm) + 1]
        data = np.frombuffer(norm.buffers()[2] or b"", dtype=np.uint8)
        out = np.zeros((len(norm), num_hashes), dtype=np.int64)
        cuts = np.flatnonzero(np.diff((ends[1:] - ends[0]) // run, prepend=-1))
        for rows in np.split(np.arange(len(norm)), cuts[1:]):
            if len(rows) and ends[rows[-1] + 1] > ends[rows[0]]:
                low = ends[rows[0]]
                text, edge = data[low:ends[rows[-1] + 1]], ends[rows[0]:rows[-1] + 2] - low
                out[rows] = md5.minima(text, *_shingle_ranges(text, edge, ngrams), len(rows), num_hashes)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(norm) + 1, dtype=np.int32) * num_hashes),
                                        pa.array(out.ravel()))

    return sig


def md5_sets(spark: SparkSession, text: str, p: MinHashParams) -> Column | None:
    """struct(set_key, n_sh, sig) of a text, row-local; None where the Java UDF cannot be compiled."""
    name = java_function(spark, "trawl.functions", "Md5Minima", "struct<set_key: string, n_sh: int, sig: array<bigint>>")
    return name and F.call_function(name, fold_text(text).cast("binary"), F.lit(p.ngrams), F.lit(p.num_hashes))


def _shingle_ranges(text: np.ndarray, edge: np.ndarray, n: int):
    """(start, length, row) of the n-word shingles of texts text[edge[i]:edge[i + 1]], single-spaced;
    a text of fewer words is one shingle, an empty one none."""
    full = np.flatnonzero(np.diff(edge))
    space = np.flatnonzero(text == 32)
    start = np.union1d(edge[full], space + 1)
    stop = np.union1d(edge[full + 1], space)
    row = np.searchsorted(edge, start, side="right") - 1
    words = np.bincount(row, minlength=len(edge) - 1)
    first = np.cumsum(words) - words
    place = np.arange(len(start)) - first[row]
    keep = np.flatnonzero((place + n <= words[row]) | (place == 0))
    last = np.minimum(keep + n, first[row[keep]] + words[row[keep]]) - 1
    return start[keep], stop[last] - start[keep], row[keep]


def _fast_coefficients(num_hashes: int, seed: int):
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, num_hashes, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 63, num_hashes, dtype=np.uint64)
    return a, b


#: Shingles whose hashes are made together.
FAST_TILE = 2048


def fast_minima(x: np.ndarray, owner: np.ndarray, owners: int, num_hashes: int, seed: int) -> np.ndarray:
    """[owner, hash]: the least upper half of a * x + b over an owner's shingles (``owner`` ascending); zeros without any.

    The upper half of the least sum is the least upper half, so only minima are shifted.
    """
    a, b = _fast_coefficients(num_hashes, seed)
    out = np.full((num_hashes, owners), np.iinfo(np.uint64).max, dtype=np.uint64)
    room = np.empty((num_hashes, FAST_TILE), dtype=np.uint64)
    for at in range(0, len(x), FAST_TILE):
        part, who = x[at:at + FAST_TILE], owner[at:at + FAST_TILE]
        v = np.multiply(a[:, None], part, out=room[:, :len(part)])
        v += b[:, None]
        first = np.flatnonzero(np.diff(who, prepend=-1))
        rows = slice(who[0], who[-1] + 1)
        if len(first) == rows.stop - rows.start:
            out[:, rows] = np.minimum(out[:, rows], np.minimum.reduceat(v, first, axis=1))
        else:  # owners without shingles lie between
            out[:, who[first]] = np.minimum(out[:, who[first]], np.minimum.reduceat(v, first, axis=1))
    out >>= np.uint64(32)
    out[:, np.bincount(owner, minlength=owners) == 0] = 0
    return out.T


def fast_signature_udf(num_hashes: int, seed: int):
    """Arrow UDF: 64-bit shingle hashes (8 bytes each, made in the JVM) -> signature.

    H multiply-add-shift hashes and their minima, vectorised in numpy over
    tiles of a bounded number of shingles, whatever a document's length.
    """
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def sig(hashes: pa.Array) -> pa.Array:
        owner = np.repeat(np.arange(len(hashes)), hashes.value_lengths().to_numpy(zero_copy_only=False))
        x = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        out = fast_minima(x, owner, len(hashes), num_hashes, seed).astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * num_hashes), pa.array(out.ravel()))

    return sig


# ------------------------------------------------------------------ stage 1
def shingle_table(docs: DataFrame, p: MinHashParams, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, sh): distinct word n-grams of the normalised text."""
    d = docs.select(F.col(id_col).alias("doc_id"), normalize_text(text_col).alias("norm"))
    return d.select("doc_id", word_ngrams("norm", p.ngrams).alias("sh"))


def signature_table(docs: DataFrame, p: MinHashParams, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, set_key, n_sh, sig) -- one row per document, one pass over the text.

    Both families are made row by row; md5 then exchanges one row per
    document, so that repeated rows are one.
    """
    made = md5_sets(docs.sparkSession, text_col, p) if p.mode == "md5" else None
    if made is not None:
        sig = docs.select(F.col(id_col).alias("doc_id"), made.alias("made")).select("doc_id", "made.*")
        return sig.groupBy("doc_id", "set_key", "n_sh").agg(F.first("sig").alias("sig"))
    t = docs.select(F.col(id_col).alias("doc_id"), normalize_text(text_col).alias("norm"))
    t = t.select("doc_id", "norm", word_ngrams("norm", p.ngrams).alias("sh")).select(
        "doc_id", F.md5(F.array_join(F.array_sort("sh"), "\n")).alias("set_key"),
        F.size("sh").alias("n_sh"), "norm" if p.mode == "md5" else "sh")
    if p.mode == "fast":
        hashes = F.transform("sh", lambda s: F.xxhash64(s))
        return t.select("doc_id", "set_key", "n_sh", fast_signature_udf(p.num_hashes, p.seed)(hashes).alias("sig"))
    sig = t.select("doc_id", "set_key", "n_sh", md5_signature_udf(p.num_hashes, p.ngrams)("norm").alias("sig"))
    return sig.groupBy("doc_id", "set_key", "n_sh").agg(F.first("sig").alias("sig"))


def set_table(docs: DataFrame, p: MinHashParams, ids: DataFrame | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sh, hs): 64-bit hashes of the shingle set, for Jaccard checks.

    With ``ids`` only those documents are shingled again (a semi join on the
    id), so sets are held for bucket members only, not for the corpus. The
    id list is small next to the text: AQE broadcasts it when it fits the
    threshold; otherwise the join is keyed on doc_id, which costs no text
    shuffle when the document table is stored bucketed by doc_id.
    """
    if ids is not None:
        docs = docs.join(ids.select(F.col("doc_id").alias(id_col)), id_col, "left_semi")
    sh = shingle_table(docs, p, id_col, text_col)
    return sh.select("doc_id", F.size("sh").alias("n_sh"),
                     F.transform("sh", lambda s: F.xxhash64(s)).alias("hs"))


# ------------------------------------------------------------------ stage 2
def band_rows(sig_tbl: DataFrame, p: MinHashParams) -> DataFrame:
    """(band, key, doc_id, set_key): one row per document and band."""
    b = sig_tbl.select("doc_id", "set_key", "sig",
                       F.explode(F.sequence(F.lit(0), F.lit(p.num_bands - 1))).alias("band"))
    sl = F.slice("sig", F.col("band") * p.rows + 1, p.rows)
    if p.mode == "md5":
        key = F.array_join(sl.cast("array<string>"), ",")
    else:  # 96-bit hashed key: two independent hash functions of the band
        key = F.concat_ws(":", F.xxhash64(sl).cast("string"), F.hash(sl).cast("string"))
    return b.select("band", key.alias("key"), "doc_id", "set_key")


def lsh_buckets(sig_tbl: DataFrame, p: MinHashParams, min_size: int = 2) -> DataFrame:
    """(band, key, n_docs) for buckets holding at least ``min_size`` documents."""
    return (band_rows(sig_tbl, p).groupBy("band", "key")
            .agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_size))


# ------------------------------------------------------------------ stage 3-4
def _jaccard(hx: str, nx: str, hy: str, ny: str):
    hx, nx, hy, ny = (F.col(c) for c in (hx, nx, hy, ny))
    inter = F.size(F.array_intersect(hx, hy))
    union = nx + ny - inter
    return F.when(union == 0, F.lit(1.0)).otherwise(inter / union)


def bucket_members(sig_tbl: DataFrame, p: MinHashParams) -> DataFrame:
    """(band, key, x): exact-set representatives of buckets with >= 2 distinct sets."""
    br = (band_rows(sig_tbl, p).groupBy("band", "key", "set_key")
          .agg(F.min("doc_id").alias("x")))
    live = (br.groupBy("band", "key").agg(F.count(F.lit(1)).alias("k"))
            .where(F.col("k") >= 2).select("band", "key"))
    return br.join(live, ["band", "key"], "left_semi").select("band", "key", "x")


#: Connected members that a bucket compares its open members with in one round.
PIVOTS = 16
#: Members up to which a bucket is compared whole in the first round; the limit doubles every round.
WHOLE = 64
#: Longs of a set's mark: one bit per cell of token hashes.
MARK = 16


@F.arrow_udf(T.ArrayType(T.LongType()))
def _mark(hashes: pa.Array) -> pa.Array:
    """The cells (of 64 * MARK) that a set of 64-bit hashes has tokens in."""
    cells = np.zeros((len(hashes), 64 * MARK), dtype=np.uint8)
    row = np.repeat(np.arange(len(hashes)), hashes.value_lengths().to_numpy(zero_copy_only=False))
    token = hashes.flatten().to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    cells[row, (token >> np.uint64(65 - (64 * MARK).bit_length())).astype(np.int64)] = 1
    longs = np.packbits(cells, axis=1, bitorder="little").view("<i8")
    return pa.ListArray.from_arrays(pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * MARK), pa.array(longs.ravel()))


def most_common(x: tuple[str, str], p: tuple[str, str]) -> Column:
    """A bound on the intersection of two sets, by their sizes and marks (columns n, m): a cell that only one
    set has tokens in holds at least one token that the other lacks."""
    (nx, mx), (np_, mp) = x, p

    def own(a: str, b: str):
        return sum((F.bit_count(F.col(a)[i].bitwiseAND(F.bitwise_not(F.col(b)[i]))) for i in range(MARK)), F.lit(0))
    return F.least(F.col(nx) - own(mx, mp), F.col(np_) - own(mp, mx))


def _may_be_similar(x: tuple[str, str], p: tuple[str, str], threshold: float):
    """False where sizes and marks rule out Jaccard >= threshold."""
    most = most_common(x, p)
    union = F.col(x[0]) + F.col(p[0]) - most
    return F.when(union == 0, True).otherwise(most / union >= threshold)


def verified_edges(members: DataFrame, sets: DataFrame, p: MinHashParams) -> DataFrame:
    """(src, dst) edges between exact-set representatives with J >= threshold, enough to
    connect what all verified pairs of all buckets connect.

    A bucket grows one component at a time. Its smallest open member starts; in a round up
    to PIVOTS members of the component that were not pivots yet are compared with the open
    members; those found similar get one edge and join the component. When no pivot is left,
    the component is complete in this bucket and the next one starts. So two similar members
    are compared or already connected. A family of near copies is taken in by its first
    pivots: no round holds more than PIVOTS rows per open member. A bucket of up to WHOLE
    members is done in one round, in which every open member is compared with all others; as
    WHOLE doubles every round, a bucket of many unrelated families takes a round per
    doubling, not one per family.

    Members carry the size and the mark of their set, so that most unrelated pairs end inside the
    bucket's join (the test is a bound: no similar pair fails it). Only ids of the others are
    exchanged; a pair that several buckets (or earlier rounds) ask for is verified once.
    """
    sets_x = sets.select(F.col("doc_id").alias("x"), F.col("hs").alias("hx"), F.col("n_sh").alias("nx"))
    sets_p = sets.select(F.col("doc_id").alias("p"), F.col("hs").alias("hp"), F.col("n_sh").alias("np"))
    bucket = ["band", "key"]
    look = sets.select(F.col("doc_id").alias("x"), F.col("n_sh").alias("n"), _mark("hs").alias("m"))
    state = members.join(look, "x").select(*bucket, "x", "n", "m", F.lit(True).alias("open"))
    edges, before, whole = [], None, WHOLE
    while True:
        # a pivot is a connected member, or the smallest open one when there is none; or everyone
        order = Window.partitionBy(*bucket).orderBy("open", "x")
        all_of = Window.partitionBy(*bucket)
        ranked = state.select("*", F.row_number().over(order).alias("place"), F.min("open").over(all_of).alias("fresh"),
                              (F.count(F.lit(1)).over(all_of) <= whole).alias("all"))
        pivot = (F.col("place") <= PIVOTS) & (~F.col("open") | (F.col("fresh") & (F.col("place") == 1)))
        ranked = materialize(ranked.select(*bucket, "x", "n", "m", "open", "all", pivot.alias("pivot")), "ranked")
        rest = ranked.where(~F.col("pivot") & ~F.col("all"))
        pivots = ranked.where(F.col("pivot") | F.col("all")).select(
            *bucket, F.col("x").alias("p"), F.col("n").alias("np"), F.col("m").alias("mp"), F.col("open").alias("po"))
        # where all are pivots, two open members meet from one side only
        once = ~F.col("all") | ~F.col("po") | (F.col("x") < F.col("p"))
        asked = (ranked.where(F.col("open") & (F.col("all") | ~F.col("pivot"))).join(pivots, bucket)
                 .where(once & _may_be_similar(("n", "m"), ("np", "mp"), p.threshold)).select(*bucket, "x", "p", "all"))
        asked = materialize(asked, "asked")
        similar = (asked.select(F.least("x", "p").alias("x"), F.greatest("x", "p").alias("p")).distinct()
                   .join(sets_x, "x").join(sets_p, "p")
                   .where(_jaccard("hx", "nx", "hp", "np") >= p.threshold).select("x", "p"))
        similar = materialize(similar, "similar")
        edges.append(similar.select(F.col("x").alias("src"), F.col("p").alias("dst")))
        either = similar.unionByName(similar.select(F.col("p").alias("x"), F.col("x").alias("p")))
        joined = (asked.where(~F.col("all")).join(either, ["x", "p"]).select(*bucket, "x").distinct()
                  .withColumn("hit", F.lit(True)))
        after = (rest.join(joined, [*bucket, "x"], "left")
                 .select(*bucket, "x", "n", "m", (F.col("open") & F.col("hit").isNull()).alias("open")))
        # a bucket is done when nobody is open, or one member is open and nobody is left to ask
        alive = (after.groupBy(*bucket).agg(F.max("open").alias("o"), F.count(F.lit(1)).alias("n"))
                 .where(F.col("o") & (F.col("n") > 1)).select(*bucket))
        state = materialize(after.join(alive, bucket, "left_semi"), "members")
        drop_table(ranked)
        drop_table(asked)
        if before is not None:
            drop_table(before)
        before, whole = state, 2 * whole
        if state.isEmpty():  # reads the written table
            break
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out.distinct()


# ------------------------------------------------------------------ stage 5
def duplicate_clusters(docs: DataFrame, p: MinHashParams, id_col: str = "doc_id",
                       text_col: str = "text", sig_tbl: DataFrame | None = None) -> DataFrame:
    """(doc_id, component) for every document; component = smallest doc id."""
    if sig_tbl is None:
        sig_tbl = materialize(signature_table(docs, p, id_col, text_col), "sig_tbl")
    members = materialize(bucket_members(sig_tbl, p), "members")
    sets = set_table(docs, p, members.select(F.col("x").alias("doc_id")).distinct(),
                     id_col, text_col)
    sets = materialize(sets, "sets")
    edges = verified_edges(members, sets, p)
    labels = connected_components(edges, "src", "dst", node_col="rep")
    reps = sig_tbl.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    doc_rep = sig_tbl.select("doc_id", "set_key").join(reps, "set_key")
    return (doc_rep.join(labels, "rep", "left")
            .select("doc_id", F.coalesce("component", "rep").alias("component")))


def pick_per_component(clusters: DataFrame, keep: str = "min", seed: int = 0) -> DataFrame:
    """One document per component (W2): smallest id, or smallest seeded md5
    (``min_by`` in a partial + final aggregate: a huge cluster is reduced map-side)."""
    if keep == "min":
        return clusters.where(F.col("doc_id") == F.col("component")).select("doc_id", "component")
    if keep == "random":
        h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
        return (clusters.groupBy("component")
                .agg(F.min_by("doc_id", h).alias("doc_id")).select("doc_id", "component"))
    raise ValueError(f"unknown keep rule {keep!r}")


def dedup_minhash(docs: DataFrame, p: MinHashParams, id_col: str = "doc_id",
                  text_col: str = "text", keep: str = "min", seed: int = 0) -> DataFrame:
    """Surviving documents (all input columns), one per near-duplicate cluster."""
    clusters = duplicate_clusters(docs, p, id_col, text_col)
    keepers = pick_per_component(clusters, keep, seed).select(F.col("doc_id").alias(id_col))
    return docs.join(keepers, id_col, "left_semi")
