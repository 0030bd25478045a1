"""Line dedup and MinHash dedup on generated corpora, against brute force."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.operators import dedup_lines as DL
from trawl.operators import minhash as MH
from trawl.operators.components import connected_components


def lines_of(rng, n):
    return [" ".join(f"t{rng.randrange(900)}" for _ in range(6)) for _ in range(n)]


def line_corpus():
    """Five documents, the first two alike, the others sharing some lines; all end in a newline."""
    rng = random.Random(11)
    common, twin = lines_of(rng, 3), lines_of(rng, 5)
    own = [lines_of(rng, 6) for _ in range(3)]
    texts = [twin, twin, own[0][:3] + common[:2] + own[0][3:], common + own[1], own[2] + common[1:3]]
    return [("\n".join(t) + "\n") for t in texts], [("".join(x + "\n" for x in t)) for t in ([], [], *own)]


def test_line_dedup_of_generated_corpus(spark):
    texts, expected = line_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in DL.dedup_lines(docs).orderBy("doc_id").collect()] == expected


def test_line_key_includes_newline_and_crlf(spark):
    df = spark.createDataFrame([(1, "same\nx1\n"), (2, "y2\nsame"), (3, "z3\r\nsame\r\n")],
                               "doc_id long, text string")
    out = {r.doc_id: r.text for r in DL.dedup_lines(df).collect()}
    # "same\n" occurs in docs 1 and 3 (after newline normalisation); "same" alone in doc 2
    assert out == {1: "x1\n", 2: "y2\nsame", 3: "z3\n"}


def kept_ids(spark, texts, p):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(r.doc_id for r in MH.dedup_minhash(docs, p).select("doc_id").collect())


@pytest.mark.parametrize("mode", ["md5", "fast"])
def test_minhash_exact_duplicates(spark, mode):
    p = MH.MinHashParams(num_hashes=100, num_bands=10, ngrams=5, threshold=0.8, mode=mode)
    assert kept_ids(spark, line_corpus()[0], p) == [0, 2, 3, 4]


@pytest.mark.parametrize("mode", ["md5", "fast"])
def test_minhash_near_duplicates(spark, mode):
    """A notice with another name and year in it is a copy; another notice is not."""
    rng = random.Random(3)
    notice = [f"n{rng.randrange(10**6)}" for _ in range(170)]
    copy = ["Other", "Holder", "2031", *notice[3:]]
    texts = [" ".join(notice), " ".join(copy), " ".join(f"m{rng.randrange(10**6)}" for _ in range(150))]
    p = MH.MinHashParams(num_hashes=500, num_bands=50, ngrams=5, threshold=0.8, mode=mode)
    assert kept_ids(spark, texts, p) == [0, 2]


def test_num_hashes_not_divisible():
    with pytest.raises(ValueError):
        MH.MinHashParams(num_hashes=100, num_bands=7)


def test_empty_and_short_documents(spark):
    df = spark.createDataFrame([(1, ""), (2, "   "), (3, "two words"), (4, "Two  words!")],
                               "doc_id long, text string")
    p = MH.MinHashParams(num_hashes=20, num_bands=4, ngrams=5, threshold=0.8)
    cl = {r.doc_id: r.component for r in MH.duplicate_clusters(df, p).collect()}
    # empty sets are one cluster; "two words" shingles to one set for both 3 and 4
    assert cl == {1: 1, 2: 1, 3: 3, 4: 3}


def test_components_chain(spark):
    n = 1000
    edges = spark.range(1, n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    cc = connected_components(edges, "src", "dst")
    r = cc.agg(F.countDistinct("component").alias("k"), F.min("component").alias("m"),
               F.count(F.lit(1)).alias("n")).first()
    assert (r.k, r.m, r.n) == (1, 1, n)


def test_chain_only_neighbours_similar(spark):
    # A-B and B-C pass the threshold, A-C does not: one cluster of three
    base = [f"w{i}" for i in range(40)]
    a = " ".join(base)
    b = " ".join(base[:36] + ["x1", "x2", "x3", "x4"])
    c = " ".join(base[:32] + ["x1", "x2", "x3", "x4", "y1", "y2", "y3", "y4"])
    df = spark.createDataFrame([(1, a), (2, b), (3, c)], "doc_id long, text string")
    p = MH.MinHashParams(num_hashes=200, num_bands=50, ngrams=1, threshold=0.8)
    cl = {r.doc_id: r.component for r in MH.duplicate_clusters(df, p).collect()}
    assert cl == {1: 1, 2: 1, 3: 1}


@pytest.mark.parametrize("mode", ["md5", "fast"])
def test_lsh_recall_against_exact_jaccard(spark, mode):
    """Clusters never join documents below the threshold (every edge is
    verified) and keep >= 90 % of the exact near-duplicate pairs."""
    from itertools import combinations

    from conftest import SF_SMALL
    from trawl.sources.tables import table

    p = MH.MinHashParams(num_hashes=100, num_bands=10, ngrams=5, threshold=0.8, mode=mode)
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    sets = {r.doc_id: set(r.sh) for r in MH.shingle_table(docs, p).collect()}
    exact = []
    for a, b in combinations(sorted(sets), 2):
        u = len(sets[a] | sets[b])
        if (len(sets[a] & sets[b]) / u if u else 1.0) >= p.threshold:
            exact.append((a, b))
    comp = {r.doc_id: r.component for r in MH.duplicate_clusters(docs, p).collect()}
    # union-find over exact edges: LSH components must refine exact components
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in exact:
        parent[find(a)] = find(b)
    for a in sets:
        for b in sets:
            if comp[a] == comp[b]:
                assert find(a) == find(b)
    kept = sum(1 for a, b in exact if comp[a] == comp[b])
    assert exact and kept / len(exact) >= 0.9


def jaccard_components(sets, members_of, threshold):
    """Components of all verified pairs that share a bucket."""
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for bucket in members_of:
        for i, a in enumerate(bucket):
            for b in bucket[i + 1:]:
                if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {d: find(d) for d in sets}


def test_pivots_connect_what_all_pairs_connect(spark):
    """One bucket with chains, stars and strangers around the threshold."""
    rng = random.Random(8)
    sets = {}
    for family in range(4):
        base = set(range(family * 1000, family * 1000 + 60))
        for k in range(30):
            sets[family * 100 + k] = set(rng.sample(sorted(base), 60 - rng.randrange(9))) | {10**6 + rng.randrange(500) for _ in range(rng.randrange(4))}
    members = spark.createDataFrame([(0, "k", x) for x in sets], "band int, key string, x long")
    table = spark.createDataFrame([(x, len(s), sorted(s)) for x, s in sets.items()], "doc_id long, n_sh int, hs array<long>")
    p = MH.MinHashParams(threshold=0.8)
    edges = [tuple(r) for r in MH.verified_edges(members, table, p).collect()]
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in edges)
    assert (jaccard_components(sets, [sorted(sets)], 0.8) == jaccard_components(sets, [list(e) for e in edges], 0.8))


def test_large_template_family_is_not_quadratic(spark):
    """2,000 fills of one template around J = 0.8 in one bucket: pairs asked for stay a few per member."""
    rng = random.Random(4)
    base = list(range(100))
    sets = [(i, 100, sorted(rng.sample(base, 89) + [1000 + 50 * i + j for j in range(11)])) for i in range(2000)]
    table = spark.createDataFrame(sets, "doc_id long, n_sh int, hs array<long>").cache()
    members = table.select(F.lit(0).alias("band"), F.lit("k").alias("key"), F.col("doc_id").alias("x"))
    began = time.time()
    edges = MH.verified_edges(members, table, MH.MinHashParams(threshold=0.65))
    assert edges.count() < 2000 * MH.PIVOTS and time.time() - began < 120


def test_bucket_of_many_strangers_takes_few_rounds_and_moves_no_sets(spark, monkeypatch):
    """500 unrelated sets and three similar pairs in one bucket: rounds by doublings, and only pairs that may be similar are verified."""
    rng = random.Random(6)
    sets = {i: [rng.getrandbits(62) for _ in range(rng.randrange(80, 300))] for i in range(500)}
    for i in (7, 140, 420):
        sets[1000 + i] = sets[i][:-3] + [rng.getrandbits(62) for _ in range(3)]
    table = spark.createDataFrame([(i, len(s), s) for i, s in sets.items()], "doc_id long, n_sh int, hs array<long>").cache()
    asked, plain = [], MH.materialize

    def counted(df, name):
        out = plain(df, name)
        if name == "asked":
            asked.append(out.count())
        return out
    monkeypatch.setattr(MH, "materialize", counted)
    members = table.select(F.lit(0).alias("band"), F.lit("k").alias("key"), F.col("doc_id").alias("x"))
    edges = MH.verified_edges(members, table, MH.MinHashParams(threshold=0.8))
    assert sorted(tuple(r) for r in edges.collect()) == [(7, 1007), (140, 1140), (420, 1420)]
    assert len(asked) <= 5 and sum(asked) < 100


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_marks_rule_out_no_similar_pair(spark, threshold):
    """Sets of sizes from none to many tokens a cell, with overlaps around the threshold."""
    rng = random.Random(9)
    pairs = [([], []), ([], [1])]
    for size in (1, 4, 9, 60, 700, 4000):
        for share in (threshold - 0.02, threshold, threshold + 0.02):
            a = [rng.getrandbits(63) for _ in range(size)]
            common = round(2 * size * share / (1 + share))
            pairs.append((a, a[:common] + [-rng.getrandbits(63) for _ in range(size - common)]))
    df = spark.createDataFrame([(len(a), len(b), a, b) for a, b in pairs], "nx int, np int, a array<long>, b array<long>")
    judged = df.select("nx", "np", MH._jaccard("a", "nx", "b", "np").alias("j"), MH._mark("a").alias("mx"), MH._mark("b").alias("mp"))
    rows = judged.withColumn("may", MH._may_be_similar(("nx", "mx"), ("np", "mp"), threshold)).collect()
    assert all(r.may for r in rows if r.j >= threshold) and any(not r.may for r in rows)


def test_fast_clusters_are_sound(spark):
    """Fast mode over a whole table: every cluster is connected by exact Jaccard alone."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    p = MH.MinHashParams(mode="fast")
    sets = {r.doc_id: set(r.sh) for r in MH.shingle_table(docs, p).collect()}
    exact = jaccard_components(sets, [sorted(sets)], p.threshold)
    for r in MH.duplicate_clusters(docs, p).collect():
        assert exact[r.doc_id] == exact[r.component]


def test_fast_minima_of_texts_longer_than_a_tile_and_of_none():
    size = np.array([0, 3, MH.FAST_TILE + 5, 0, 0, 1, 3 * MH.FAST_TILE, 7, 0])
    x = np.random.default_rng(2).integers(0, 1 << 63, size.sum(), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    got = MH.fast_minima(x, np.repeat(np.arange(len(size)), size), len(size), 14, 1)
    a, b = MH._fast_coefficients(14, 1)
    for i, part in enumerate(np.split(x, np.cumsum(size)[:-1])):
        want = [int(((k * part + c) >> np.uint64(32)).min()) if len(part) else 0 for k, c in zip(a, b, strict=True)]
        assert got[i].tolist() == want
    assert MH.fast_minima(x[:0], np.arange(0), 2, 14, 1).tolist() == [[0] * 14] * 2
