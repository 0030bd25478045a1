"""Null ids, repeated rows and extra columns with clashing names: defined results, no crash."""

import pytest
from pyspark.sql import functions as F

from trawl.llm import (attention_lm, decontaminate, line_spread, mixing, quality_ordinal, quality_rules,
                       simhash_cover, substring_cover, token_cache, url_filter)

TEXT = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
ROWS = [(1, TEXT, "en", "a", 1), (1, TEXT, "en", "a", 1), (1, "other text", "en", "a", 1), (None, TEXT, None, None, None),
        (None, None, None, None, None), (2, TEXT, "en", "b", 2), (3, TEXT + "\nline two", "en", "c", 3)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("size", "target", "taken", "takes", "line", "pos", "words", "kept", "hashes", "fp", "anchor", "_id", "_hash",
             "removed", "sites", "row", "h", "n", "score", "digest", "n_tokens", "starts", "settled", "cluster", "x",
             "component_id", "text_hash", "lang_key", "src", "bucket", "grade", "held_out", "spans", "items")
    return df.withColumns({c: F.lit(c) for c in clash}).repartition(2).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(7, " ".join(TEXT.split()[:12])), (None, "other TEXT"), (7, "mu nu")], "item_id long, text string")


def pairs(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_mixing(docs):
    out = mixing.mix_sources(docs)
    assert out.count() == len(ROWS)
    assert pairs(out, "doc_id", "size")[:1] == [(1, 16)]
    assert all(r["taken"] <= 2 * r["size"] for r in out.select("size", mixing.taken_words(F.col("takes")).alias("taken")).collect())


def test_line_spread(docs):
    out = line_spread.dedup_lines(docs, min_sites=3)
    assert out.count() == len(ROWS) and set(docs.columns) <= set(out.columns)
    # the line is on four sites (null is one); the null id's text comes first and keeps it
    assert pairs(out, "doc_id", "text") == sorted([(1, ""), (1, ""), (1, "other text"), (None, TEXT), (None, None),
                                                   (2, ""), (3, "line two")], key=repr)


def test_quality_rules(docs):
    out = quality_rules.judge_quality(docs)
    assert out.count() == len(ROWS) and out.where("kept").count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_simhash(docs):
    out = simhash_cover.near_duplicates(docs)
    by_text = {r["text_hash"]: r["component_id"] for r in out.collect()}
    assert out.count() == len(ROWS) and set(by_text.values()) == {1, 3, None}
    kept = simhash_cover.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert pairs(kept, "doc_id", "text") == sorted([(1, TEXT), (1, "other text"), (None, None), (3, TEXT + "\nline two")], key=repr)


def test_decontaminate(docs, items):
    out = decontaminate.match_items(docs, items)
    want = [(i, ["7"]) if t and TEXT in t else (i, [""]) if t else (i, []) for i, t, *_ in ROWS]
    assert pairs(out, "doc_id", "items") == sorted(want, key=repr)
    n_hit = decontaminate.covered_words(F.col("spans")).alias("n")
    blocks = decontaminate.match_items(docs, items, block_words=4)
    assert pairs(blocks, "doc_id", "items", n_hit) == pairs(out, "doc_id", "items", n_hit)
    cut = decontaminate.remove_spans(docs, items)
    assert cut.columns == docs.columns and pairs(cut, "doc_id", "text") == [(None, None)]
    cut = decontaminate.remove_spans(docs, items, max_coverage=1.0)
    assert (2, " omicron pi".strip()) in [(i, (t or "").split("xi ")[-1].strip()) for i, t in pairs(cut, "doc_id", "text")]


def test_substrings(docs):
    got = pairs(substring_cover.dedup_substrings(docs), "doc_id", "n_words", "n_removed")
    assert got == sorted([(1, 16, 0), (1, 16, 0), (1, 2, 0), (None, 16, 0), (None, 0, 0), (2, 16, 16), (3, 18, 16)], key=repr)


def test_difference_cover_is_checked(docs):
    with pytest.raises(ValueError, match="cover"):
        substring_cover.dedup_substrings(docs, period=7, cover=(0, 1, 2))


def test_token_cache_fills_once(spark, docs, tmp_path):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, cache = sentencepiece.SentencePieceProcessor(model_file=path), str(tmp_path / "cache")
    want = sorted([(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t, *_ in ROWS], key=repr)
    assert pairs(token_cache.count_tokens(docs, path, cache), "doc_id", "n_bytes", "n_tokens") == want
    assert spark.read.parquet(cache).count() == 4  # distinct texts
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(99).cast("long")).write.parquet(str(tmp_path / "other"))
    again = token_cache.count_tokens(docs, path, str(tmp_path / "other"))  # stored counts are used, nothing is encoded
    assert {r["n_tokens"] for r in again.collect()} == {99}
    json_path = public_tokenizers.path("byte_bpe_50k.json")  # another tokenizer, same cache
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(json_path)
    got = pairs(token_cache.count_tokens(docs, json_path, cache), "doc_id", "n_tokens")
    assert got == sorted([(i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ROWS], key=repr)


def test_ordinal_scores(spark, docs):
    labels = spark.createDataFrame([(1, 2), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, grade int")
    model = quality_ordinal.fit_ordinal(*quality_ordinal.labelled_features(docs, labels), min_docs=1, epochs=20)
    out = quality_ordinal.score_quality(docs, model, good_grade=2).collect()
    assert len(out) == len(ROWS) and all(0 <= r["tail_probability"] <= 1 for r in out)


def test_language_model(docs):
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        out = attention_lm.score_texts(docs, f.read())
    assert sorted(r["n_tokens"] for r in out.collect()) == sorted(len((t or "").split()) + 1 for _, t, *_ in ROWS)


def test_urls(spark):
    pages = spark.createDataFrame([(1, "http://A.net/x", "v"), (1, "http://A.net/x", "v"), (None, None, "v")],
                                  "page_id long, url string, verdict string")
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark))
    got = pairs(url_filter.filter_urls(pages, model), "page_id", "host", "path", "rule", "verdict")
    assert got[:2] == [(1, "a.net", "/x", "net/", "block")] * 2 and got[2][:4] == (None, "", "", None)
    with pytest.raises(ValueError, match="labelled"):
        url_filter.fit_url_model(url_filter.labelled_urls(spark), max_labelled=10)
