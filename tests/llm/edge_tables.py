import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
PAGES = "page_id long, url string, html string"
ITEMS = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
VECTORS = "vec_id long, embedding array<float>, label int"


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edge_rows():
    """Unique ids; nulls, blanks, unusual characters, copies, passages, one long text, hot source."""
    rng = random.Random(5)
    shared, item = prose(rng, 60), prose(rng, 30, 10_000)
    rows = [(None, "en", "a"), ("", "en", "a"), (" \t\n\x0b\x0c\r ", None, "b"), ("one", "en", None),
            ("Two words", None, None), ("a b c " * 40, "en", "a"), ("line\nline\nline\n\nline", "de", "b"),
            ("é ü\u00a0ß \u4f60\u597d \U0001f600 x", "de", "c"), ("### *** " * 60 + prose(rng, 60), "en", "a"),
            (prose(rng, 80).upper(), "en", "a"), (prose(rng, 20_000, 3000), "en", "b"),
            (item, "en", "c"), (prose(rng, 40) + " " + item + " " + prose(rng, 40), "en", "c"),
            (prose(rng, 12) + " " + " ".join(item.split()[5:15]) + ", end", "en", "a")]
    for i in range(60):
        body = prose(rng, 70)
        rows.append((body + "\n" + "Boilerplate of the site " + "x" * 3 + "\n" + prose(rng, 30), "en", f"s{i % 7}"))
        if i % 5 == 0:
            rows += [(body + " " + shared, "en", "a"), (body, "fr", "a")]
    rows += [("copy of a text " + shared, "en", "hot")] * 40
    return [(i, t, lang, src, len(t) if t else None) for i, (t, lang, src) in enumerate(rows)], item


def edge_vectors():
    """Groups, ties, repeated rows and ids, and vectors that do not count."""
    rng = random.Random(8)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, 0.1) for m in middles[i % 5]], 0) for i in range(150)]
    rows += [(500 + i, [0.5] * 64, 1) for i in range(60)] + [rows[3]] * 4 + [(None, rows[4][1], None), (7, [-0.25] * 64, 2)]
    odd = [0.0] * 63
    return rows + [(900, None, 0), (901, [], 0), (902, [0.5] * 63, 0), (903, [0.5] * 65, 0), (904, [None, *odd], 0),
                   (905, [float("nan"), *odd], 0), (906, [float("inf"), *odd], 0), (907, [-float("inf"), *odd], 0),
                   (908, [131071.99, *odd], 0), (909, [131072.0, *odd], 0), (910, [3e38, *odd], 0)]


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """documents, benchmark and pages with edge cases, as one Parquet folder each."""
    d = str(tmp_path_factory.mktemp("edge"))
    rows, item = edge_rows()
    spark.createDataFrame(rows, DOCS).coalesce(3).write.parquet(f"{d}/documents.parquet")
    items = [(1, item), (2, "Two WORDS"), (3, None), (4, ""), (5, "one"), (12, item), (6, prose(random.Random(9), 25))]
    spark.createDataFrame(items, ITEMS).coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    urls = [None, "", "nothing", "http://", "HTTP://A.Net/x", "https://www.Example.NET/en/1?q#f", "http://example.net/fr/",
            "x://sub.example.com/de/9", "http://example.org/fr/a?b", "http://b.org/frx/", "http://net/", "http://net",
            "http://casino.example.org/en/1", "ftp://h/p?://q", "a://é.Ä.com/ß#://"]
    spark.createDataFrame(list(zip(range(len(urls)), urls, ["h"] * len(urls), strict=True)), PAGES).coalesce(1).write.parquet(
        f"{d}/pages.parquet")
    spark.createDataFrame(edge_vectors(), VECTORS).repartition(3).write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(len(rows))], LABELS).coalesce(1).write.parquet(
        f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name, schema in (("documents", DOCS), ("benchmark", ITEMS), ("pages", PAGES), ("labels", LABELS),
                         ("embeddings", VECTORS)):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{name}.parquet")
    return d
