"""Each test fails where an operator does less than its whole job."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from trawl.llm import attention_lm, bytewords, decontaminate


# ---------------------------------------------------------------- language model

def training_texts(spark):
    rng = np.random.default_rng(3)
    texts = ["", "one", None, " ".join(f"w{x}" for x in rng.integers(0, 900, 3000))]
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 900, n)) for n in rng.integers(1, 400, 40)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def subwords_of(spark, docs):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        tokenizer = f.read()
    pieces = {r["piece"]: r["n"] for r in attention_lm.piece_counts(attention_lm.word_counts(docs), tokenizer).collect()}
    return tokenizer, attention_lm.vocabulary(pieces, docs.count(), tokenizer)[0]


def rows_of(win):
    """Windows as a sorted list; what a missing block or target holds does not count."""
    return sorted((x.tolist(), (x0 * h).tolist(), bool(h), (y * r).tolist(), r.tolist())
                  for x, x0, h, y, r in zip(*win, strict=True) for x in [x * np.append(True, r[:-1])])


def test_every_window_of_every_training_text_is_trained_on(spark):
    texts, docs = training_texts(spark)
    tokenizer, id_of = subwords_of(spark, docs)
    runs = attention_lm.training_runs(docs, spark.sparkContext.broadcast((tokenizer, id_of))).toPandas()
    got = attention_lm.run_windows(runs["ids"].tolist(), runs["initial"].to_numpy(dtype=bool))
    subs, each = attention_lm.Subwords(tokenizer, id_of), []
    for t in texts:
        w = bytewords.Words([(t or "").encode()], bytewords.NOT_SPACE, lower=True)
        _, which, known, s, e = subs.of_words(w, w.hashes())
        each.append(np.append(attention_lm._gathered(known, s[which], e[which])[0], attention_lm.END))
    want, _ = attention_lm.windows_of(np.concatenate(each), np.array([len(x) for x in each]))
    assert got.real.sum() == sum(map(len, each)) and runs["windows"].sum() == len(want.inputs)
    assert rows_of(got) == rows_of(want)


def test_shards_grow_in_number_and_not_in_size(spark):
    runs = spark.range(6000).select((F.xxhash64("id").bitwiseAND(F.lit((1 << 44) - 1))).alias("draw"), F.lit(20).cast("long").alias("windows"),
                                    F.lit(True).alias("initial"), F.lit(b"").alias("ids"))
    for n in (600, 6000):
        got = attention_lm.dealt(runs.limit(n), shard_windows=800, rounds=3).groupBy("round", "shard").count().collect()
        assert len(got) == n * 20 // 800 and max(r["count"] for r in got) < 2 * 800 / 20


def test_held_out_texts_score_above_counting_words(spark):
    """The smallest corpus on which the model could overfit or underfit: better than the unigram base on what it has not seen."""
    from trawl.llm.catalog import QUERIES

    r = QUERIES["op8_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.005


# ---------------------------------------------------------------- decontamination

def test_blocks_remove_what_one_block_removes(spark):
    rng = random.Random(4)
    items = [[f"i{k}x{j}" for j in range(20)] for k in range(12)]

    def prose(n):
        return [f"d{rng.randrange(10**6)}" for _ in range(n)]
    texts = [prose(40) + items[a] + prose(n) + items[b] for a in range(12) for b in range(12) for n in (10, 60)]
    texts += [items[a][:9] + items[b] + items[a][9:] + prose(50) for a in range(12) for b in range(12) if a != b]  # joined by a cut
    texts += [prose(30), [], items[0]]
    rows = [(i, " ".join(ws), "x") for i, ws in enumerate(texts)] + [(0, " ".join(texts[0]), "x"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(ws)) for k, ws in enumerate(items)], "item_id long, text string")
    want = decontaminate.remove_spans(docs, bench)
    got = decontaminate.remove_spans(docs, bench, block_words=40)
    assert got.columns == docs.columns
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert decontaminate.match_items(got, bench).where(F.size("spans") > 0).count() == 0


def test_whole_short_items_are_removed_and_nothing_says_otherwise(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "C"), (2, "e f g")], "item_id long, text string")
    assert decontaminate.remove_spans(docs, bench).first()["text"].split() == ["a", "b", "d", "e", "f"]
    assert not hasattr(decontaminate, "MIN_SPAN")
