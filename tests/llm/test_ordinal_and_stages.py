"""The ordinal classifier against a plain likelihood; pipeline stages with every helper name as a column."""

import math
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import corpus_pipeline  # noqa: E402
from edge_tables import edge_dir, empty_dir  # noqa: E402, F401  (fixtures)
from trawl.llm import quality_ordinal as Q  # noqa: E402


def sample(rng, n=30, width=7, top=3):
    doc = np.sort(rng.integers(0, n, 80))
    return width, rng.integers(0, width, 80), doc, rng.random((n, 4)), rng.integers(0, top + 1, n)


def plain_loss(p, width, col, doc, shape, grades, ridge):
    """Row by row: -log(P(grade >= g) - P(grade >= g + 1))."""
    k = shape.shape[1]
    theta = [p[width + k]]
    for x in p[width + k + 1:]:
        theta.append(theta[-1] + math.exp(x))
    total = 0.0
    for i, g in enumerate(grades):
        score = sum(p[c] for c, d in zip(col, doc) if d == i) + sum(a * b for a, b in zip(shape[i], p[width:width + k]))
        tail = [1.0] + [1 / (1 + math.exp(t - score)) for t in theta] + [0.0]
        total -= math.log(tail[g] - tail[g + 1])
    return total / len(grades) + ridge / 2 * sum(x * x for x in p[:width + k])


@pytest.mark.parametrize("seed", range(4))
def test_loss_and_gradient_match_a_plain_likelihood(seed):
    rng = np.random.default_rng(seed)
    width, col, doc, shape, grades = sample(rng)
    p = rng.normal(0, 0.5, width + 4 + 3)
    loss, g = Q.loss_and_gradient(p, width, col, doc, shape, grades, 0.1)
    assert math.isclose(loss, plain_loss(p, width, col, doc, shape, grades, 0.1), rel_tol=1e-9)
    for i in range(len(p)):
        e = np.zeros_like(p)
        e[i] = 1e-6
        slope = (plain_loss(p + e, width, col, doc, shape, grades, 0.1) - plain_loss(p - e, width, col, doc, shape, grades, 0.1)) / 2e-6
        assert abs(slope - g[i]) < 1e-6


def test_query_scores_match_the_model_by_hand(spark):
    docs = spark.createDataFrame([(i, f"word{i % 5} word{i % 7} {'BAD' if i % 3 else 'good'} #{'!' * (i % 2)}") for i in range(60)]
                                 + [(99, None), (99, ""), (None, "good good")], "doc_id long, text string")
    grades = spark.createDataFrame([(i, 0 if i % 3 else 2 - i % 2) for i in range(60)], "doc_id long, grade int")
    model = Q.fit_ordinal(*Q.labelled_features(docs, grades), min_docs=3, n_grades=3)
    assert np.all(np.diff(model.thresholds) > 0) and len(model.thresholds) == 2
    for r in Q.score_quality(docs, model, 2).join(docs.select(F.col("doc_id").alias("i"), "text"), F.col("doc_id").eqNullSafe(F.col("i"))).collect():
        slots, _, shape = Q.features([(r.text or "").encode()])
        s = sum(float(model.words[x]) for x in set(slots.tolist())) + float(shape[0] @ model.shapes)
        tails = [1 / (1 + math.exp(t - s)) for t in model.thresholds]
        if r.i != 99:
            assert math.isclose(r.expected_grade, sum(tails), rel_tol=1e-4) and math.isclose(r.tail_probability, tails[1], rel_tol=1e-4)


@pytest.mark.parametrize("grades,want", [([], [0.5, 0.5]), ([2] * 9, [0.9999, 0.9999]), ([0] * 9, [0.0001, 0.0001]), ([1, 1], [0.9999, 0.0001])])
def test_without_contrast_all_texts_are_alike(spark, grades, want):
    docs = spark.createDataFrame([(i, "some text here") for i in range(9)] + [(20, None)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(grades)), "doc_id long, grade int")
    model = Q.fit_ordinal(*Q.labelled_features(docs, labels), n_grades=3)
    got = Q.score_quality(docs, model, 2).collect()
    assert len(got) == 10
    assert all(abs(r.tail_probability - want[1]) < 1e-6 and abs(r.expected_grade - sum(want)) < 1e-6 for r in got)


HELPERS = ["_removed", "_n_lines", "removed", "n_lines", "_id", "_hash", "_lines", "_row", "_new", "_new_cut", "_cut", "_copy", "_lang",
           "_source", "_rows", "id", "row", "line", "site", "pos", "first", "sites", "fp", "size", "takes", "sha", "text_hash",
           "cluster", "label", "node", "spans", "items", "longest", "kept", "n", "k", "words", "metric", "bin", "src", "seed_key", "new"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_pass_columns_of_any_name(spark, edge_dir, name):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in HELPERS])
    stage = dict(corpus_pipeline.STAGES)[name]
    plain, got = stage(spark, docs, edge_dir), stage(spark, wide, edge_dir)
    if name == corpus_pipeline.STAGES[-1][0]:
        assert sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr)
        return
    assert got.columns == wide.columns
    rows = got.collect()
    assert sorted((tuple(r[c] for c in docs.columns) for r in rows), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert all(r[c] == f"{c}{'' if r.doc_id is None else r.doc_id}" for r in rows for c in HELPERS)


def test_stages_on_an_empty_table(spark, empty_dir):
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.read.parquet(f"{empty_dir}/documents.parquet")
        assert stage(spark, docs, empty_dir).count() == 0
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


# ---------------------------------------------------------------- adaptive limits

def brute_limits(rows, spread, prior):
    """Quantiles of a group's own texts, its language's with weight prior / n_lang and the corpus' inside those, by fractions."""
    from fractions import Fraction

    def binned(x):
        return x - x % 2 ** max(x.bit_length() - 6, 0)

    def blend(own, parent):
        total = len(own) + prior
        return {b: (sum(x == b for x in own) + prior * parent[b]) / Fraction(total) for b in parent}
    out = {}
    every = [binned(x) for _, _, x in rows]
    corpus = {b: Fraction(every.count(b), len(every)) for b in set(every)}
    for lang, src in {(a, b) for a, b, _ in rows}:
        shares = blend([binned(x) for a, b, x in rows if (a, b) == (lang, src)],
                       blend([binned(x) for a, _, x in rows if a == lang], corpus))

        def quantile(p):
            total = 0
            for b in sorted(shares):
                total += shares[b]
                if total >= p:
                    return b
        q50, q90 = quantile(Fraction(1, 2)), quantile(Fraction(9, 10))
        out[lang, src] = q90 + spread * (q90 - q50) + 2 ** max(q90.bit_length() - 6, 0)
    return out


@pytest.mark.parametrize("prior", [0, 1, 200])
def test_limits_follow_the_groups_own_sketch(spark, prior):
    from trawl.llm import quality_rules as R

    rng = np.random.default_rng(prior)
    rows = [(f"+l{i % 3}", f"+s{i % 7}", int(abs(rng.normal(0, 3 + 40 * (i % 7))))) for i in range(900)] + [("", "", 900)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, lang_key string, source_key string, x int")
    each = df.select("lang_key", "source_key", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), R.sketch_bin(F.col("x").cast("long")).alias("bin"))
                                                                   for m in R.METRICS])).alias("e"))
    sketches = each.groupBy("lang_key", "source_key", "e.metric", "e.bin").agg(F.count(F.lit(1)).alias("n"))
    want = brute_limits(rows, 3, prior)
    for r in R.adaptive_limits(sketches, 3, prior).collect():
        assert {r[f"limit_{m}"] for m in R.METRICS} == {want[r.lang_key, r.source_key]}


def test_spread_decides_and_good_documents_stay(spark):
    from trawl.llm import quality_rules as R
    from trawl.sources.tables import table

    sf = "/root/testdata/sf0.1"
    out = R.judge_quality(table(spark, sf, "documents")).persist()
    limits = out.select("lang", "source", *[f"limit_{m}" for m in R.METRICS]).distinct().collect()
    by_spread = [sum(r[f"limit_{m}"] > 2 for m in R.METRICS) for r in limits]  # more than a unit above zero
    assert sum(n >= 2 for n in by_spread) > 0.9 * len(limits) and len({tuple(r)[2:] for r in limits}) > 40
    labels = table(spark, sf, "labels")
    share = {(r.quality, r.toxic): r.kept for r in out.where("not base_failed").join(labels, "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1, 0] > 0.97 and share[0, 0] < 0.05
    out.unpersist()
