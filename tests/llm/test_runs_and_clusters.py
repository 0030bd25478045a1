"""Exact dedup, centroid clustering and periodic runs against brute force."""

import hashlib
import os
import random
import re
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from edge_tables import edge_dir, edge_rows, edge_vectors  # noqa: E402, F401  (fixture)
from trawl.llm import centroid_walk, exact_tree, periodic_runs
from trawl.llm.catalog import QUERIES

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


# ---------------------------------------------------------------- exact dedup

def groups_of(rows):
    """(id, keep_id, size, sha, kept) by comparing normalised texts; ``kept`` left out for repeated rows."""
    of = {}
    for i, t in rows:
        of.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in of.items():
        least = min((i for i in ids if i is not None), default=None)
        out += [(i, least, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("run_rows,hot", [(1 << 17, 1 << 16), (1, 1), (3, 4)])
def test_tree_merge_matches_grouping(spark, run_rows, hot):
    rng = random.Random(2)
    texts = [None, "", " ", "  ", "\t\n", "a b", "a  b", " a b", "a\x0b\x0cb", "a\xa0b", "a\x85b", "a b ", "é\r\nx", "é x", "x" * 300_000]
    rows = [(rng.randrange(200), rng.choice(texts)) for _ in range(300)] + [(5, "same row")] * 9 + [(None, "only null")] * 3
    rows += [(None, "a b"), (10**12, "hot"), *[(i, "hot") for i in range(1000, 1200)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_tree.exact_groups(docs, run_rows=run_rows, hot_groups=hot).collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], bytes(r["sha"]).hex()) for r in got), key=repr) == groups_of(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({bytes(r["sha"]) for r in got}) and all(r["id"] == r["keep_id"] for r in kept)


def test_a_level_keeps_groups_and_smallest_ids(spark):
    rows = [(i, f"t{i % 40}" if i % 3 else "hot") for i in range(900, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    d = exact_tree.digest_rows(docs)
    for rounds in (0, 1, 3):
        runs = exact_tree.merge_runs(d, rounds)
        agg = runs.groupBy("digest").agg(F.sum("n").alias("n"), F.min("first.id").alias("i"))
        assert sorted((r["n"], r["i"]) for r in agg.collect()) == sorted(
            (sum(t == u for _, u in rows), min(i for i, u in rows if u == t)) for t in {t for _, t in rows})
        if rounds:  # the digest's upper digits are the place, and no place holds an entry twice
            assert runs.count() == 41
            at = F.shiftrightunsigned("digest", 64 - 3 * rounds)
            assert runs.where(F.col("place") != at).count() == 0
    plan = exact_tree.merge_runs(d, 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("SortAggregate") >= 3


def test_keep_first_keeps_columns_of_any_name(spark):
    rows = [(3, "a  b", "x"), (1, "a b", "y"), (1, "a\tb", "y"), (2, None, None), (4, "", "z"), (None, "c", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sha string")
    for name in ("id", "row", "digest", "n", "kept", "place", "first", "keep_id", "n_bytes", "kept_sha"):
        docs = docs.withColumn(name, F.lit(1))
    out = exact_tree.keep_first(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], re.sub(r"\s", " ", r["text"] or ""), r["sha"]) for r in out.collect()), key=repr)
    assert got == sorted([(1, "a b", "y"), (2, "", None), (None, "c", "q")], key=repr)


# ---------------------------------------------------------------- centroid clustering

def nearest(v, centroids):
    d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
    return d.index(min(d)), min(d)


@given(st.data())
@settings(max_examples=200, deadline=None)
def test_walk_finds_the_nearest_with_the_smallest_number(data):
    dims, k = data.draw(st.integers(1, 5)), data.draw(st.integers(1, 9))
    value = st.integers(-4, 4) | st.sampled_from([-(1 << 27), (1 << 27) - 1])
    row = st.lists(value, min_size=dims, max_size=dims)
    centroids, x = data.draw(st.lists(row, min_size=k, max_size=k)), data.draw(st.lists(row, min_size=1, max_size=12))
    label, d, _ = centroid_walk.SortedLists(np.array(centroids, dtype=np.int64)).nearest(np.array(x, dtype=np.int64))
    assert list(zip(label.tolist(), d.tolist(), strict=True)) == [nearest(v, centroids) for v in x]


def test_walk_stops_before_it_has_seen_all():
    rng = np.random.default_rng(4)
    centroids = rng.integers(-10_000, 10_000, (400, 3))
    x = centroids[rng.integers(0, 400, 500)] + rng.integers(-5, 6, (500, 3))
    label, d, taken = centroid_walk.SortedLists(centroids).nearest(x)
    assert list(zip(label.tolist(), d.tolist(), strict=True)) == [nearest(v, centroids.tolist()) for v in x.tolist()]
    assert taken < 500 * 400 / 4


def clusters_of(rows, k, rounds):
    good = []
    for i, v, _ in rows:
        v = [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None
        if v is not None and len(v) == 64 and all(x is not None and abs(x) < 1 << 17 for x in v):
            good.append((i, [int(np.floor(1024 * x)) for x in v]))
    seed = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in good)[:k]
    c = [v for _, v in seed]
    for _ in range(rounds):
        at = [nearest(v, c)[0] for _, v in good]
        for j in range(len(c)):
            own = [v for (_, v), a in zip(good, at, strict=True) if a == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted(((i, *nearest(v, c)) for i, v in good), key=repr), c


@pytest.mark.parametrize("k,rounds", [(8, 10), (1, 2), (300, 1)])
def test_clusters_match_brute_force(spark, k, rounds):
    rows = edge_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    for name in ("id", "v", "cluster", "n", "sums", "key"):
        df = df.withColumn(name, F.lit("x"))
    want, c = clusters_of(rows, k, rounds)
    got = centroid_walk.cluster_vectors(df, k=k, rounds=rounds).collect()
    assert sorted(((r["id"], r["cluster"], r["distance"]) for r in got), key=repr) == want
    assert all(r["centroid"] == c[r["cluster"]] for r in got)
    assert {r["inertia"] for r in got} == {sum(d for _, _, d in want)}
    assert all(r["cluster_inertia"] == sum(d for _, j, d in want if j == r["cluster"]) for r in got)


# ---------------------------------------------------------------- periodic runs

def runs_of(words, min_length=6, exponent=4):
    """Every maximal stretch of every period, compared word by word; the smallest period of a stretch."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and (length := j + q - i) >= max(min_length, exponent * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


word = st.sampled_from("ab") | st.sampled_from("abc")
repeated = st.tuples(st.lists(word, min_size=1, max_size=6), st.integers(1, 12)).map(lambda t: t[0] * t[1])


@given(st.lists(st.lists(repeated | st.lists(word, max_size=5), max_size=6).map(lambda x: sum(x, [])), max_size=5))
@settings(max_examples=400, deadline=None)
def test_runs_match_brute_force(texts):
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    hashes = np.array([ord(w) for t in texts for w in t], dtype=np.uint64)
    first = np.cumsum([0] + [len(t) for t in texts])
    start, length, period = periodic_runs.find_runs(hashes, text, max(map(len, texts), default=0))
    got = [[] for _ in texts]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        got[text[s]].append((s - first[text[s]], n, q))
    assert got == [runs_of(t) for t in texts]


def planted(doc_id, words):
    """The query's input: some texts made periodic."""
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, words_of(text or ""))
    runs = runs_of(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest,
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_brute_force(spark, tmp_path):
    rows, _ = edge_rows()
    rng = random.Random(3)
    rows = [(i, t) for i, t, *_ in rows if not t or len(t) < 50_000]
    rows += [(1000 + i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(120)))) for i in range(150)]
    rows += [(1000 + i, ("x " * i) + "y " + "p q\tr\n" * (i // 2)) for i in range(30)] + [(None, "a " * 40), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("best", F.lit(1)).withColumn("runs", F.lit("x")).repartition(
        3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == COLUMNS
    want = [expected(i, t) for i, t in rows]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 60 and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i) > 15


def test_a_long_periodic_text(spark):
    rng = random.Random(6)
    block = [f"w{rng.randrange(500)}" for _ in range(30_000)]
    words = ["lead"] * 3 + block * 5 + ["tail"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    r = periodic_runs.collapse_runs(docs).first()
    assert (3, 150_000, 30_000) in [tuple(x) for x in r["runs"]] and r["n_words"] == len(words)
    assert len(r["collapsed"].split()) == 3 + 30_000 + 1
