"""The url model: probabilities by hand, words held out of the fit, the rule part in SQL."""

import math

import duckdb
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from trawl.llm import url_filter as U

ODD = [None, "", "nothing", "http://", "HTTP://A.Net/x", "a://é.Ä.com/ß#://", "http://ab", "http://h/" + "x" * 5000,
       "https://my-poker24.example.com/en/3?q", "ftp://h/p?://q", "http://example.net/en/1", "http://a.org/fr/2", "http://www.net/", "x://b.example.com/de/"]


@pytest.fixture(scope="module")
def model(spark):
    return U.fit_url_model(U.labelled_urls(spark))


def test_probabilities_by_hand(spark, model):
    tf = HashingTF(numFeatures=U.BUCKETS, inputCol="g", outputCol="f")
    weights, bias = model.coefficients.toArray(), model.intercept
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD)], "page_id long, url string, _p string")
    for r in U.filter_urls(pages, model).collect():
        grams = {m + t[i:i + n] for t, m in (("^" + r.host + "$", "h:"), (r.path + "$", "p:")) for n in U.GRAMS for i in range(len(t) - n + 1)}
        p = 1 / (1 + math.exp(-(bias + sum(weights[x] for x in {tf.indexOf(g) for g in grams}))))
        assert math.isclose(r.block_probability, p, rel_tol=1e-9), r
        assert r.rule is not None or (r.verdict == "block") == (p >= U.BLOCK_AT)


def test_words_held_out_of_the_fit(spark):
    """Words that the fit has not seen: harmful ones score higher, and no harmless one is blocked."""
    harmful, harmless = ([w for g in words.values() for w in g] for words in (U.BLOCK_WORDS, U.ALLOW_WORDS))
    found = []
    for k in range(3):
        held = (*harmful[k::3], *harmless[k::3])
        model = U.fit_url_model(U.labelled_urls(spark, held))
        pages = spark.createDataFrame([(i, f"http://{w}.example.com/x/{i}", int(w in harmful)) for i, w in enumerate(held)],
                                      "page_id long, url string, y int")
        out = U.filter_urls(pages, model, rules=()).join(pages.select("page_id", "y"), "page_id")
        found += [(r.y, r.block_probability) for r in out.collect()]
    bad, good = sorted(p for y, p in found if y), sorted(p for y, p in found if not y)
    above = sum(a > b for a in bad for b in good) / (len(bad) * len(good))
    assert above > 0.55 and sum(p >= U.BLOCK_AT for p in good) <= 0.02 * len(good) < len(good)
    assert sum(p >= U.BLOCK_AT for p in bad) >= sum(p >= U.BLOCK_AT for p in good)


def test_known_words_are_found_in_any_place(spark, model):
    urls = [(f"http://{p}{w}.other.test/a/{i}", y) for y, words in ((1, U.BLOCK_WORDS), (0, U.ALLOW_WORDS))
            for i, w in enumerate(w for g in words.values() for w in g) for p in ("", "go-")]
    pages = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(urls)], "page_id long, url string, y int")
    out = U.filter_urls(pages, model).join(pages.select("page_id", "y"), "page_id")
    share = {r.y: r.b for r in out.groupBy("y").agg(F.avg((F.col("verdict") == "block").cast("int")).alias("b")).collect()}
    assert share[1] > 0.7 and share[0] < 0.01


def test_rules_match_sql(spark, model, tmp_path):
    pages = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string")
    pages.write.parquet(f"{tmp_path}/p")
    rules = ", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in U.RULES)
    want = duckdb.sql(f"""
        WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
                   FROM '{tmp_path}/p/*.parquet'),
        r(verdict, rule, h, p) AS (VALUES {rules}),
        f AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule) AS k
              FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT u.page_id, host, path, rule, verdict FROM u LEFT JOIN f ON f.page_id = u.page_id AND k = 1 ORDER BY 1""").fetchall()
    got = U.filter_urls(pages, model).orderBy("page_id").collect()
    assert [(r.page_id, r.host, r.path, r.rule) for r in got] == [w[:4] for w in want]
    assert all(r.verdict == w[4] for r, w in zip(got, want) if w[4])
