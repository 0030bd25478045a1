"""Exact set-similarity join against all pairs; components on paths, hubs and random graphs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl.operators import components as CC
from trawl.operators import minhash as MH
from trawl.operators import setjoin as SJ


def shingles(text, n):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1))))


def family_texts():
    """Copies, near copies in a chain, a family around one text, boilerplate that many texts are made of, odd texts."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", "one", "ONE", "one two", " ".join(words[:5])]
    for _ in range(12):
        body = rng.choices(words, k=rng.randrange(10, 120))
        texts += [" ".join(body)] * rng.randrange(1, 4)
        for _ in range(rng.randrange(7)):
            body = list(body)
            for _ in range(rng.randrange(1, 4)):
                body[rng.randrange(len(body))] = rng.choice(words)
            texts.append(" ".join(body))
    stock = [" ".join(rng.choices(words, k=30)) for _ in range(4)]
    texts += [" ".join([*rng.sample(stock, 3), rng.choice(words)]) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def expected(rows, n, t):
    sets, reps = {}, {}
    for i, text in rows:
        sets.setdefault(shingles(text, n), i)
        reps[i] = sets[shingles(text, n)]
    of = {i: s for s, i in sets.items()}
    ids = sorted(of)
    pairs = {(x, y): (len(of[x] & of[y]), len(of[x] | of[y])) for x in ids for y in ids
             if x < y and of[x] & of[y] and len(of[x] & of[y]) >= round(t * len(of[x] | of[y]), 9)}
    return reps, pairs


@pytest.mark.parametrize("n,t,block,sets,cells", [(5, 0.8, 512, 256, 18), (2, 0.5, 3, 4, 2), (1, 0.9, 2, 1, 10), (3, 0.65, 7, 1000, 1)])
def test_all_similar_pairs_are_found(spark, n, t, block, sets, cells):
    rows = family_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("rep", F.lit("x"))
    found, who = SJ.similar_pairs(docs, t, n, block=block, sets_per_block=sets, cells_log2=cells)
    reps, pairs = expected(rows, n, t)
    got = [(r.x, r.y, r.common, r.total) for r in found.collect()]
    assert sorted(got) == sorted((x, y, *c) for (x, y), c in pairs.items()) and pairs
    assert {r.doc_id: r.rep for r in who.collect()} == reps
    linked = {r.doc_id: r for r in SJ.linked_documents(found, who).collect()}
    for i, r in reps.items():
        assert linked[i].n_links == sum(r in p for p in pairs)
    label = {r: r for r in reps.values()}
    for _ in label:
        for x, y in pairs:
            label[x] = label[y] = min(label[x], label[y])
    assert {i: linked[i].component for i in reps} == {i: label[r] for i, r in reps.items()}


def test_sets_are_written_once_and_a_small_component_moves_once(spark, monkeypatch):
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        body = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        texts += [" ".join([*body, *(f"x{rng.randrange(10**6)}" for _ in range(2))]) for _ in range(4)]
        half = [f"w{rng.randrange(10**6)}" for _ in range(40)]  # shares half: a candidate at most
        texts.append(" ".join(body[:40] + half))
    rng.shuffle(texts)
    rows, tables = list(enumerate(texts)), {}

    def write(df, name, real=SJ.materialize):
        tables[name] = (df.columns, (out := real(df, name)).count())
        return out
    monkeypatch.setattr(SJ, "materialize", write)
    found, _ = SJ.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"), sets_per_block=8)
    pairs = expected(rows, 5, 0.8)[1]
    assert {(r.x, r.y): (r.common, r.total) for r in found.collect()} == pairs and len(pairs) == 40 * 6
    assert [name for name, (cols, _) in tables.items() if "tokens" in cols] == ["shingle-sets"]
    assert tables["candidates"][1] == len(pairs)                       # the marks end the others
    assert tables["asked-sets"][1] == len({i for p in pairs for i in p})


def test_shingle_sets_match_word_tuples():
    texts = [t.lower() if t else "" for _, t in family_texts()] + ["é ü 你 x y z", "a a a a a a a"]
    for n in (1, 3, 5):
        sets = SJ.shingle_sets([t.encode() for t in texts], n)
        want = [shingles(t, n) for t in texts]
        assert [len(s) for s in sets] == [len(w) for w in want]
        assert all((sorted(a) == sorted(b)) == (x == y) for a, x in zip(sets, want) for b, y in zip(sets[:40], want[:40]))
        assert all(np.all(np.diff(s) > 0) for s in sets)


def test_empty_table_and_bad_threshold(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    found, who = SJ.similar_pairs(empty)
    assert found.count() == who.count() == SJ.linked_documents(found, who).count() == 0
    with pytest.raises(ValueError, match="threshold"):
        SJ.similar_pairs(empty, 0)


@pytest.mark.parametrize("n_bands,least", [(10, 0.7), (20, 0.97)])
def test_recall_counts_pairs_that_share_a_band(spark, n_bands, least):
    """LSH recall, read from the exact join, equals a count by hand; 20 bands of 5 rows find nearly all."""
    rows = family_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    p = MH.MinHashParams(100, n_bands, 5, 0.8, "fast")
    bands = MH.band_rows(MH.signature_table(docs, p), p)
    r = SJ.lsh_recall(*SJ.similar_pairs(docs), bands).first()
    of: dict = {}
    for b in bands.collect():
        of.setdefault(b.doc_id, set()).add((b.band, b.key))
    pairs = expected(rows, 5, 0.8)[1]
    assert r.n_pairs == len(pairs) and r.n_found == sum(bool(of[x] & of[y]) for x, y in pairs)
    assert r.n_found >= least * r.n_pairs > 0


# ---------------------------------------------------------------- components

def labels_of(edges):
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = root(a), root(b)
            label[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in list(label)}


def graphs():
    rng = random.Random(7)
    yield []
    yield [(1, 1), (2, None), (None, 3)]
    yield [(5, 3), (3, 5), (5, 3), (3, 3)]
    yield [(i, i + 1) for i in range(300)] + [(1000 - i, 999 - i) for i in range(0, 200, 2)]
    yield [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    yield [(0 if i % 2 else 500, i) for i in range(1, 500)] + [(-7, 499)]


@pytest.mark.parametrize("at", range(6))
def test_components_match_union_find(spark, at):
    edges = list(graphs())[at]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in CC.connected_components(df).collect()}
    want = {x: c for x, c in labels_of([e for e in edges if e[0] != e[1]]).items()}
    assert got == want
    nodes = spark.createDataFrame([(9999,), (1,)], "node long")
    more = {r.node: r.component for r in CC.connected_components(df, nodes=nodes).collect()}
    assert more == {9999: 9999, 1: want.get(1, 1), **want}


def test_a_path_of_100_000_nodes_and_a_hub_shrink(spark):
    n = 100_000
    path = spark.range(n - 1).select((F.col("id") * 7919 % n).alias("src"), ((F.col("id") + 1) * 7919 % n).alias("dst"))
    hub = spark.range(50_000).select(F.lit(-5).cast("long").alias("src"), (F.col("id") + 10**9).alias("dst"))
    written: list[int] = []
    out = CC.connected_components(path.unionByName(hub), written=written)
    sizes = {r.component: r["count"] for r in out.groupBy("component").count().collect()}
    assert sizes == {0: n, -5: 50_001}
    assert written[0] <= n and all(b < a for a, b in zip(written, written[1:])) and written[-1] == 0 and len(written) < 25
