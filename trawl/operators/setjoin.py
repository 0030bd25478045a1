"""Exact set-similarity join: all pairs of distinct shingle sets with Jaccard >= threshold.

The reference verifies only pairs that share a hash band (U2, U3); this join finds every pair, and so also tells
what share of them the bands find (``lsh_recall``).

1. ``set_rows``: one pass over the text gives every document its set of word n-grams as sorted 64-bit hashes and a
   128-bit key of the set, written once. Documents with one set are one *representative* (the smallest id); ``members`` keeps
   who belongs to it, and copies collapse by their prefixes, so whole sets are first exchanged when pairs are verified.
2. Order: tokens are ranked rarest first. A fixed-size count sketch (``CELLS`` counters, summed over all sets) orders
   them: by the count of a token's cell, then by hash. Any order gives exact results, so what the sketch confuses costs candidates, never pairs.
3. Prefix filter: two sets of n and m tokens with Jaccard >= t share at least o = t / (1 + t) * (n + m) tokens, so each set's
   first n - ceil(t * n) + 1 tokens in that order share one. Only those are exchanged, with size, place, and the token before.
4. Candidates meet by token, under a length filter (t * max <= min) and a position filter (tokens left must suffice for o). A
   pair whose sets hold the same token right before is met there already and passed over. A token with more than
   ``BLOCK`` sets is dealt in blocks of them, a pair of blocks a group, so a boilerplate shingle is no task of its own.
   A mark of the set (1,024 bits) bounds the intersection and ends most pairs that are not similar before sets move.
5. Verification: sets are numbered by the component that candidate pairs tie them to, inside it in the order of their rarest
   shared token; 256 of them are a block. A task holds the sets of two blocks and intersects the candidate pairs between
   them. A component that is no larger than a block lies in one, so its sets move once, however many pairs it has; in a
   larger one a set moves once per pair of blocks.

The empty set equals itself and no other; its documents are one representative without links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..session import drop_table, materialize
from .components import connected_components
from .minhash import MARK, most_common
from .sampling import global_rank

NGRAMS, THRESHOLD = 5, 0.8
CELLS_LOG2 = 18
BLOCK = 512  # sets that meet by one token in a group, from either side
SETS = 256  # sets of a block of the verification
_U = np.uint64


# ---------------------------------------------------------------- sets
#: Bases of the polynomial word and n-gram hashes (odd, so that they have an inverse modulo 2^64).
_WORD, _GRAM = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Bytes of normalised text whose words are hashed together; texts stay whole.
RUN_BYTES = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public domain constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span: one prefix sum of a polynomial."""
    power = np.full(len(values) + 1, base, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    back = np.full(len(values) + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    return _mixed((total[ends] - total[starts]) * back[starts] ^ ((ends - starts).astype(np.uint64) << _U(48)))


def shingle_sets(texts: list[bytes], ngrams: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of normalised (single-spaced) texts; of fewer words, of all of them."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    edge = np.diff((buf != 32).astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, at)
    words = _spans(buf.astype(np.uint64) + _U(1), starts, ends, _WORD)
    out = []
    n_words = np.diff(first)
    grams = _spans(words, g := np.arange(max(len(words) - ngrams + 1, 0)), g + ngrams, _GRAM)
    whole = np.flatnonzero((n_words > 0) & (n_words < ngrams))
    short = dict(zip(whole.tolist(), _spans(words, first[whole], first[whole + 1], _GRAM), strict=True))
    for i, n in enumerate(n_words.tolist()):
        if n >= ngrams:
            out.append(np.unique(grams[first[i]:first[i] + n - ngrams + 1].view(np.int64)))
        else:
            out.append(np.array([short[i]] if n else [], dtype=np.uint64).view(np.int64))
    return out


def set_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS) -> DataFrame:
    """(doc_id, key1, key2, n, tokens binary): distinct n-gram hashes of every text, sorted, 8 bytes each."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.cumsum(pc.binary_length(b.column(1).cast(pa.large_binary())).to_numpy(zero_copy_only=False) + 1)
            first = 0
            while first < b.num_rows:
                before = size[first - 1] if first else 0
                n = int(np.searchsorted(size, before + RUN_BYTES)) + 1 - first
                texts = b.column(1).slice(first, n).cast(pa.large_binary()).to_pylist()
                sets = shingle_sets(texts, ngrams)
                raw = [s.astype("<i8").tobytes() for s in sets]
                keys = [np.frombuffer(hashlib.blake2b(x, digest_size=16).digest(), dtype="<i8") for x in raw]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, n), pa.array([int(k[0]) for k in keys], type=pa.int64()),
                     pa.array([int(k[1]) for k in keys], type=pa.int64()),
                     pa.array([len(s) for s in sets], type=pa.int32()), pa.array(raw, type=pa.binary())],
                    ["doc_id", "key1", "key2", "n", "tokens"])
                first += n
    few = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalize_text(text_col).alias("t"))
    return few.mapInArrow(pack, "doc_id long, key1 long, key2 long, n int, tokens binary")


def members(sets: DataFrame) -> DataFrame:
    """(doc_id, rep): every document and the smallest id with the same set."""
    reps = sets.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"))
    return sets.select("doc_id", "key1", "key2").join(reps, ["key1", "key2"]).select("doc_id", "rep")


# ---------------------------------------------------------------- order and prefixes
def _cell(tokens: np.ndarray, cells_log2: int) -> np.ndarray:
    return ((tokens.view(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(64 - cells_log2)).astype(np.int64)


def count_sketch(sets: DataFrame, cells_log2: int = CELLS_LOG2) -> np.ndarray:
    """Tokens per cell over all sets: a fixed number of counters, whatever the size of the data."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << cells_log2, dtype=np.int64)
        for b in batches:
            tokens = np.frombuffer(b"".join(b.column(0).to_pylist()), dtype="<i8")
            cells += np.bincount(_cell(tokens, cells_log2), minlength=len(cells))
        some = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some])], ["cell", "n"])
    rows = sets.select("tokens").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << cells_log2, dtype=np.int64)
    out[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def needed(n: int, m: int, threshold: float) -> int:
    """Fewest common tokens of sets of n and m tokens with Jaccard >= threshold."""
    return math.ceil(round(threshold / (1 + threshold) * (n + m), 9))


def prefix_sets(sets: DataFrame, cells: np.ndarray, threshold: float) -> DataFrame:
    """(rep, key1, key2, n, first, mark): the prefix of every distinct set that is not empty, rarest first, and a bit per
    cell that the set has tokens in. Copies have one prefix and collapse by it; whole sets are not exchanged."""
    sent = sets.sparkSession.sparkContext.broadcast(cells)
    cells_log2 = int(len(cells)).bit_length() - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sent.value
        for b in batches:
            first = [np.empty(0, dtype="<i8")]
            cells_of = np.zeros((b.num_rows, 64 * MARK), dtype=np.uint8)
            for i, raw in enumerate(b.column(4).to_pylist()):
                t = np.frombuffer(raw, dtype="<i8")
                size = len(t) - math.ceil(round(threshold * len(t), 9)) + 1
                first.append(t[np.lexsort((t, count[_cell(t, cells_log2)]))[:size]])
                cells_of[i, _cell(t, (64 * MARK).bit_length() - 1)] = 1
            ends = np.cumsum([len(f) for f in first]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first)))
            longs = np.packbits(cells_of, axis=1, bitorder="little").view("<i8").ravel()
            marks = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * MARK), pa.array(longs))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], lists, marks], ["doc_id", "key1", "key2", "n", "first", "mark"])
    rows = sets.where("n > 0").select("doc_id", "key1", "key2", "n", "tokens").mapInArrow(
        cut, "doc_id long, key1 long, key2 long, n int, first array<long>, mark array<long>")
    return rows.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n", "first", "mark")))


def prefix_rows(prefixes: DataFrame) -> DataFrame:
    """(rep, n, token, place, before): a row per prefix token; ``before`` is the token one place earlier."""
    rows = prefixes.select("rep", "n", "first", F.posexplode("first").alias("place", "token"))
    before = F.coalesce(F.get("first", F.col("place") - 1), F.lit(0).cast("long"))
    return rows.select("rep", "n", "token", "place", before.alias("before"))


# ---------------------------------------------------------------- candidates
def shared_prefixes(prefixes: DataFrame) -> DataFrame:
    """Prefix rows of tokens that two or more sets have in their prefixes, with their number (``sets``)."""
    per = prefixes.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    return prefixes.join(per, "token")


def candidate_pairs(shared: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(x, y): pairs of representatives, x < y, that share a prefix token and pass length and position filters."""
    n_blocks = F.ceil(F.col("sets") / block).cast("int")
    some = shared.withColumn("b", F.pmod(F.xxhash64("rep"), n_blocks).cast("int"))
    # a row goes to every pair of blocks (i <= j) that its own block is part of
    other = F.explode(F.sequence(F.lit(0), n_blocks - 1))
    dealt = some.withColumn("o", other).withColumn("i", F.least("b", "o")).withColumn("j", F.greatest("b", "o"))
    group = ["token", "i", "j"]
    left = dealt.select(*group, F.col("b").alias("bx"), F.col("rep").alias("x"), F.col("n").alias("nx"),
                        F.col("place").alias("px"), F.col("before").alias("wx"))
    right = dealt.select(*group, F.col("b").alias("by"), F.col("rep").alias("y"), F.col("n").alias("ny"),
                         F.col("place").alias("py"), F.col("before").alias("wy"))
    t = F.lit(threshold)
    need = F.ceil(F.round(t / (1 + t) * (F.col("nx") + F.col("ny")), 9))
    left_over = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    met_before = (F.col("px") > 0) & (F.col("py") > 0) & (F.col("wx") == F.col("wy"))
    fits = ((F.col("x") < F.col("y")) & ((F.col("i") == F.col("j")) | (F.col("bx") != F.col("by")))
            & (F.round(t * F.greatest("nx", "ny"), 9) <= F.least("nx", "ny"))
            & (left_over + F.least("px", "py") >= need) & ~met_before)
    return left.join(right, group).where(fits).select("x", "y").distinct()


def near_pairs(pairs: DataFrame, prefixes: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sizes and marks leave room for Jaccard >= threshold (a bound: no similar pair fails it)."""
    x = prefixes.select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("mark").alias("mx"))
    y = prefixes.select(F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("mark").alias("my"))
    most = most_common(("nx", "mx"), ("ny", "my"))
    fits = most >= F.round(F.lit(threshold) * (F.col("nx") + F.col("ny") - most), 9)
    return pairs.join(x, "x").join(y, "y").where(fits).select("x", "y")


# ---------------------------------------------------------------- verification
def _intersections(pairs: pd.DataFrame, sets: pd.DataFrame, threshold: float) -> pd.DataFrame:
    tokens = {r: np.frombuffer(t, dtype="<i8") for r, t in zip(sets["rep"], sets["tokens"], strict=True)}
    out = []
    for x, y in zip(pairs["x"], pairs["y"], strict=True):
        a, b = tokens[x], tokens[y]
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        common = int((b[at] == a).sum())
        union = len(a) + len(b) - common
        if common >= round(threshold * union, 9):
            out.append((x, y, common, union))
    return pd.DataFrame(out, columns=["x", "y", "common", "total"])


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD, ngrams: int = NGRAMS, id_col: str = "doc_id",
                  text_col: str = "text", block: int = BLOCK, sets_per_block: int = SETS,
                  cells_log2: int = CELLS_LOG2) -> tuple[DataFrame, DataFrame]:
    """(pairs, membership): (x, y, common, total, jaccard) for all pairs of distinct sets, x < y, by their
    representatives; and (doc_id, rep) for every document."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and not above 1")
    rows = materialize(set_rows(docs, id_col, text_col, ngrams), "shingle-sets")
    who = materialize(members(rows), "set-members")
    prefixes = materialize(prefix_sets(rows, count_sketch(rows, cells_log2), threshold), "prefixes")
    shared = materialize(shared_prefixes(prefix_rows(prefixes)), "shared-prefixes")
    pairs = materialize(near_pairs(candidate_pairs(shared, threshold, block), prefixes, threshold), "candidates")
    # sets that are in a pair, numbered by what pairs connect, then by the first token they share with another
    parts = connected_components(pairs, "x", "y", node_col="rep")
    first = shared.groupBy("rep").agg(F.min_by("token", "place").alias("token")).join(parts, "rep")
    ranked = global_rank(first, [F.col("component"), F.col("token"), F.col("rep")], "rank").withColumn("rank", F.col("rank") - 1)
    ranked = materialize(ranked.select("rep", "component", "rank"), "set-ranks")
    starts = ranked.groupBy("component").agg(F.min("rank").alias("start"), F.count(F.lit(1)).alias("size"))
    at = F.when(F.col("size") <= sets_per_block, F.col("start")).otherwise(F.col("rank"))
    place = materialize(ranked.join(starts, "component").select("rep", F.floor(at / sets_per_block).alias("block")), "set-places")
    at_x = place.select(F.col("rep").alias("x"), F.col("block").alias("bx"))
    at_y = place.select(F.col("rep").alias("y"), F.col("block").alias("by"))
    placed = materialize(pairs.join(at_x, "x").join(at_y, "y").select(
        F.least("bx", "by").alias("bi"), F.greatest("bx", "by").alias("bj"), "x", "y"), "placed-pairs")
    again = docs.sparkSession.read.parquet(placed.table_path)  # columns of its own for the co-group
    use = again.select("bi", "bj", F.explode(F.array("x", "y")).alias("rep")).distinct()
    # written for its size to be known: as long as it is small, sets are exchanged once
    keyed = materialize(use.join(prefixes.select("rep", "key1"), "rep"), "asked-sets")
    moved = rows.withColumnRenamed("doc_id", "rep").join(keyed, ["rep", "key1"]).select("bi", "bj", "rep", "tokens")

    def verify(pair_rows: pd.DataFrame, set_rows: pd.DataFrame) -> pd.DataFrame:
        return _intersections(pair_rows, set_rows, threshold)
    found = (placed.groupBy("bi", "bj").cogroup(moved.groupBy("bi", "bj"))
             .applyInPandas(verify, "x long, y long, common long, total long"))
    found = materialize(found.withColumn("jaccard", F.col("common") / F.col("total")), "similar-pairs")
    for t in (rows, prefixes, shared, pairs, ranked, place, placed, keyed):
        drop_table(t)
    return found, who


def linked_documents(found: DataFrame, who: DataFrame) -> DataFrame:
    """(doc_id, rep, n_links, component): for every document its set, how many other sets are similar to it, and the
    smallest id that similar sets lead to."""
    both = found.select(F.col("x").alias("rep")).unionByName(found.select(F.col("y").alias("rep")))
    links = both.groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    parts = connected_components(found.select(F.col("x").alias("src"), F.col("y").alias("dst")), node_col="rep")
    per_rep = links.join(parts, "rep")
    return who.join(per_rep, "rep", "left").select("doc_id", "rep", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                                                   F.coalesce("component", "rep").alias("component"))


def lsh_recall(found: DataFrame, who: DataFrame, bands: DataFrame) -> DataFrame:
    """(n_pairs, n_found): similar pairs of distinct sets, and those of them that share the key of a band.

    ``bands``: (band, key, doc_id) of the documents, as ``minhash.band_rows`` gives them.
    """
    ends = found.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
    one_key = F.concat(F.col("band").cast("string"), F.lit(" "), "key")
    keys = bands.join(ends, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set(one_key).alias("keys"))
    met = (found.select("x", "y").join(keys.select(F.col("doc_id").alias("x"), F.col("keys").alias("kx")), "x", "left")
           .join(keys.select(F.col("doc_id").alias("y"), F.col("keys").alias("ky")), "y", "left"))
    return met.agg(F.count(F.lit(1)).alias("n_pairs"), F.count(F.when(F.arrays_overlap("kx", "ky"), 1)).alias("n_found"))
