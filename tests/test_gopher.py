"""Gopher rules: texts generated from the limits, on both sides of each."""

import pytest

from trawl.operators.gopher import gopher_filter


def judged(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.keep, r.reason) for r in gopher_filter(df).orderBy("doc_id").collect()]


def words(n, length):
    return " ".join(["abcdefghijklmnopqrst"[:length]] * n)


@pytest.mark.parametrize("n,reason", [(49, "word_count"), (50, None), (100_000, None), (100_001, "word_count")])
def test_word_count_limits(spark, n, reason):
    assert judged(spark, [words(n, 5)]) == [(reason is None, reason)]


@pytest.mark.parametrize("length,reason", [(2, "mean_word_length"), (3, None), (10, None), (11, "mean_word_length")])
def test_mean_length_limits(spark, length, reason):
    assert judged(spark, [words(60, length)]) == [(reason is None, reason)]


def test_mean_length_just_over_ten(spark):
    assert judged(spark, [words(99, 10) + " " + words(1, 11)]) == [(False, "mean_word_length")]


@pytest.mark.parametrize("n_letters,reason", [(39, "alpha_ratio"), (40, None), (41, None)])
def test_alphabetic_share_of_fifty(spark, n_letters, reason):
    text = " ".join(["9876"] * (50 - n_letters) + ["kelp"] * n_letters)
    assert judged(spark, [text]) == [(reason is None, reason)]


@pytest.mark.parametrize("n_dots,n_lines,reason", [(3, 10, None), (4, 10, "ellipsis_lines"), (30, 100, None), (31, 100, "ellipsis_lines")])
def test_ellipsis_share(spark, n_dots, n_lines, reason):
    line = words(8, 4)
    text = "\n".join([line + "..."] * n_dots + [line] * (n_lines - n_dots))
    assert judged(spark, [text]) == [(reason is None, reason)]


def test_blank_texts(spark):
    assert judged(spark, ["", " \t\n ", None]) == [(False, "empty")] * 3
