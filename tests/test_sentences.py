"""Learned abbreviations: counts, scores, decisions, sentence and token counts by hand."""

import math
import random

from pyspark.sql import functions as F

from trawl.operators import sentences as SE


def corpus():
    rng = random.Random(2)
    names, verbs = ["Smith", "Jones", "Weber", "Moreau"], ["came", "left", "spoke", "wrote"]
    texts = []
    for i in range(200):
        s = [f"Dr. {rng.choice(names)} {rng.choice(verbs)} home.", f"The house was {rng.choice(['red', 'old', 'far'])}!",
             f"Prices, e.g. for bread, rose in the town.", f"(Who {rng.choice(verbs)}?)", "It was home.", "The home in town has one end near home."]
        rng.shuffle(s)
        texts.append(" ".join(s))
    return texts + ["Dr. Smith", "", None, "no end here", "Ends with Dr.", "...", "One. Two! Three?", "\"Quoted end.\" Next"]


def test_abbreviations_are_learned_and_keep_their_period(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string")
    counts = SE.type_counts(docs).cache()
    learned = {r["type"]: r for r in SE.learn_abbreviations(counts).collect()}
    assert learned["dr"].abbreviation and learned["e.g"].abbreviation
    assert not any(learned[w].abbreviation for w in ("home", "town", "one", "end"))
    n = counts.agg(F.sum(F.col("with_period") + F.col("without_period")), F.sum("with_period")).first()
    p, k, rest = n[1] / n[0], learned["home"].with_period, learned["home"].without_period
    ll = -2 * (k * math.log(p) + rest * math.log(1 - p) - k * math.log(0.99) - rest * math.log(0.01))
    assert math.isclose(learned["home"].score, ll * math.exp(-4) * 4.0 ** -rest, rel_tol=1e-9)
    out = {r.doc_id: (r.n_words, r.n_abbreviations, r.n_sentences, r.n_tokens)
           for r in SE.sentence_counts(docs, SE.learn_abbreviations(counts)).collect()}
    assert len(out) == len(corpus())
    assert out[200] == (2, 1, 1, 2) and out[201] == out[202] == (0, 0, 0, 0) and out[203] == (3, 0, 1, 3)
    assert out[204] == (3, 1, 1, 3) and out[206] == (3, 0, 3, 4) and out[207] == (3, 0, 2, 4)
    for i in range(200):  # six sentences; "Dr." and "e.g." end none of them; four of six end with a period
        assert out[i][1:3] == (2, 6) and out[i][3] == out[i][0] + 4


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "Dr. A came. Dr. B left."), (1, "Dr. A came. Dr. B left."), (None, "x."), (None, None)], "doc_id long, text string")
    learned = SE.learn_abbreviations(SE.type_counts(docs).cache())
    assert sorted(SE.sentence_counts(docs, learned).collect(), key=repr)[0].n_words == 6 and SE.sentence_counts(docs, learned).count() == 4
    empty = docs.limit(0)
    assert SE.sentence_counts(empty, SE.learn_abbreviations(SE.type_counts(empty))).count() == 0
