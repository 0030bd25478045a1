"""Classifiers (held-out rows) and token windows (brute force)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trawl.operators import classify as C
from trawl.operators import language as L
from trawl.operators import tokens as K
from trawl.operators.extraction import filter_by
from trawl.sources.tables import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def language(spark):
    return L.train_language_id(table(spark, SF, "documents"))


def test_language_scores_lie_on_both_sides_of_the_limit(spark, language):
    docs = table(spark, SF, "documents").where("lang in ('en', 'fr')").orderBy("doc_id").limit(200)
    by_lang = {l: [r.text for r in docs.where(F.col("lang") == l).limit(10).collect()] for l in ("en", "fr")}
    mixed = [a[:300] + " " + b[:300] for a, b in zip(by_lang["en"], by_lang["fr"])]
    texts = [(i, t) for i, t in enumerate(by_lang["en"] + mixed)]
    got = L.identify_language(language, spark.createDataFrame(texts, "i long, text string"), keep=["i"]).orderBy("i").collect()
    pure, both = got[:len(by_lang["en"])], got[len(by_lang["en"]):]
    assert all(r.lang == "en" and r.score_raw >= 0.7 for r in pure)
    assert any(r.score_raw < 0.7 for r in both) and max(r.score_raw for r in both) < min(r.score_raw for r in pure)


def test_language_of_blank_and_null(spark, language):
    df = spark.createDataFrame([("",), (None,), ("  ",), ("ab",)], "text string")
    assert all(0 < r.score < 1 for r in L.identify_language(language, df).collect())


def test_trigrams_outside_the_head_count(spark, language):
    """A head far below the vocabulary: the same scores, by way of the join."""
    docs = table(spark, SF, "documents")
    small = L.train_language_id(docs, head_grams=200)
    assert language.rest is None and small.rest and 0 < len(small.codes) <= 200 < len(language.codes)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "zq"), (-4, "\u4f60\u597d \U0001f600 " * 9), (-5, "the end")], "doc_id long, text string")
    texts = docs.select("doc_id", "text").unionByName(odd).unionByName(odd).withColumn("key", F.lit("x")).withColumn("n", F.lit(1))
    want = {r.doc_id: (r.lang, r.score_raw) for r in L.identify_language(language, texts, keep=["doc_id"]).collect()}
    got = L.identify_language(small, texts, keep=["doc_id"]).collect()
    assert len(got) == texts.count()
    assert all(r.lang == want[r.doc_id][0] and abs(r.score_raw - want[r.doc_id][1]) < 1e-9 for r in got)
    flagged = filter_by(texts, L.English(small), flag="k")
    assert flagged.columns == [*texts.columns, "k"]
    assert flagged.where("k").count() == sum(l == "en" and s >= 0.7 for l, s in (want[r.doc_id] for r in got))


def test_a_model_needs_labelled_texts(spark):
    with pytest.raises(ValueError, match="language"):
        L.train_language_id(spark.createDataFrame([("a", None), (None, "en")], "text string, lang string"))


def test_filter_by_takes_columns_and_functions(spark, language):
    df = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, "gamma")], "i long, text string")
    ids = lambda d: [r.i for r in d.orderBy("i").collect()]
    assert ids(filter_by(df, F.col("text").contains("beta"))) == [1]
    assert ids(filter_by(df, lambda t: len(t) == 5)) == [3]
    assert [r.k for r in filter_by(df, str.islower, flag="k").orderBy("i").collect()] == [True, False, True]
    english = filter_by(table(spark, SF, "documents"), L.English(language))
    assert english.where("lang = 'en'").count() > 0.95 * english.count() > 0


def test_content_classifiers_find_every_class_on_held_out_rows(spark):
    from trawl.plans import catalog

    toxic = catalog.QUERIES["classify_toxic"](spark, SF)
    assert toxic.count() == table(spark, SF, "documents").count()
    quality = catalog.QUERIES["classify_quality"](spark, SF)
    for pred, y in ((toxic, "toxic"), (quality, "y")):
        held = pred.where(F.col("split") == "test").where(F.col(y).isNotNull())
        right = {r[y]: r.share for r in held.groupBy(y).agg(F.avg((F.col(y) == F.col("prediction")).cast("int")).alias("share")).collect()}
        assert len(right) == 2 and min(right.values()) > 0.25 and max(right.values()) > 0.9


def test_language_id_beats_majority_on_holdout(spark):
    from trawl.operators.sampling import train_test_split

    docs = train_test_split(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    model = L.train_language_id(docs.where("split = 'train'"))
    test = docs.where("split = 'test'")
    pred = L.identify_language(model, test.withColumnRenamed("lang", "gold"), keep=["gold"])
    acc = pred.agg(F.avg((F.col("gold") == F.col("lang")).cast("double"))).first()[0]
    majority = test.groupBy("lang").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > majority


def test_pack_and_sample_windows_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    tok = K.tokenize_corpus(docs).cache()
    stream = [x for r in tok.orderBy("doc_id").collect() for x in r.tokens]
    ctx = 64
    got = {r.window: (list(r.x), list(r.y)) for r in K.pack_windows(tok, ctx).collect()}
    assert len(got) == (len(stream) - 1) // ctx
    for w, (x, y) in got.items():
        assert x == stream[w * ctx:(w + 1) * ctx] and y == stream[w * ctx + 1:(w + 1) * ctx + 1]
    for r in K.sample_windows(tok, 8, ctx, seed=5).collect():
        assert list(r.x) == stream[r.s:r.s + ctx] and list(r.y) == stream[r.s + 1:r.s + ctx + 1]
    assert max(stream) < K.VOCAB_SIZE and stream.count(K.END_OF_TEXT) == tok.count()


def test_training_tasks_do_not_grow_with_the_rows(spark):
    """A task sends a gradient per iteration: no more tasks than cores, fewer for few rows."""
    cores = spark.sparkContext.defaultParallelism
    for rows, tasks in ((1, 1), (C.ROWS_PER_PARTITION + 1, min(2, cores)), (3 * cores * C.ROWS_PER_PARTITION, cores)):
        vectors = C._partitioned(spark.range(rows))
        assert vectors.rdd.getNumPartitions() == tasks and vectors.count() == rows
        vectors.unpersist()


def test_vocabulary_is_the_most_frequent_terms_ties_by_name(spark):
    rows = [(["b", "a", "c", "a"],), (["c", "b"],), ([],), (None,), (["d"],)]
    terms = spark.createDataFrame(rows, "terms array<string>")
    assert C._most_frequent(terms, 3) == ["a", "b", "c"]
    assert C._most_frequent(terms, 9) == ["a", "b", "c", "d"]


def test_training_vectors_carry_no_feature_model(spark):
    """The plan that the iterations read starts at a written table."""
    from pyspark.ml.feature import CountVectorizerModel
    words = spark.createDataFrame([(["a", "b"],)], "w array<string>")
    vectors = C._partitioned(CountVectorizerModel.from_vocabulary(["a", "b"], "w", "f").transform(words).select("f"))
    assert "ml_attr" not in vectors.schema["f"].metadata
    assert "parquet" in vectors._jdf.queryExecution().analyzed().toString() and vectors.first().f.toArray().tolist() == [1.0, 1.0]
    vectors.unpersist()


def test_places_of_codes_by_table_and_by_search(monkeypatch):
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 3000):
        codes = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        places = L.Places(codes, rng.permutation(len(codes)))
        asked = np.concatenate([codes, codes[::-1], rng.integers(0, 1 << 62, 500, dtype=np.uint64)])
        at, known = places.find(asked)
        assert known.tolist() == np.isin(asked, codes).tolist()
        assert (codes[at[known]] == asked[known]).all()
    # what holds its slot is not searched: the last code put there, so at least the last one of all
    model = L.LanguageModel(["a"], np.zeros(1), np.ones(1), codes, np.arange(len(codes), dtype=float)[:, None])
    monkeypatch.setattr(L.np, "searchsorted", None)
    assert model.places().find(codes[-1:])[0].tolist() == [len(codes) - 1]
