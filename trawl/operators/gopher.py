"""Gopher quality rules (F1-F6) as one projection.

Token and line statistics are computed once per document into a struct; the
rules are integer comparisons on it (exact at the boundaries), and ``reason``
names the first failing rule in the reference's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (GOPHER_MAX_ELLIPSIS_SHARE, GOPHER_MAX_MEAN_LEN,
                                  GOPHER_MAX_WORDS, GOPHER_MIN_ALPHA_SHARE,
                                  GOPHER_MIN_MEAN_LEN, GOPHER_MIN_WORDS)
from ..functions.text import line_stats, py_strip, token_stats, word_token_string

STAT_COLS = ("n_tokens", "token_chars", "n_alpha_tokens", "n_lines", "n_ellipsis_lines")


def gopher_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add a ``gstats`` struct and an ``is_blank`` flag."""
    tok = word_token_string(F.col(text_col))
    df = df.withColumn("_tok", tok).withColumn(
        "_stripped", py_strip(F.coalesce(F.col(text_col), F.lit(""))))
    ts = token_stats(F.col("_tok"))
    ls = line_stats(F.col(text_col), F.col("_stripped"))
    stats = F.struct(*[ts[k].alias(k) for k in ts], *[ls[k].alias(k) for k in ls])
    # blank after strip <=> no lines after strip (saves a pass over the text)
    return (df.withColumn("gstats", stats)
              .withColumn("is_blank", F.col("gstats.n_lines") == 0)
              .drop("_tok", "_stripped"))


def rule_columns(s: str = "gstats") -> dict[str, Column]:
    """Pass/fail per rule (True = passes)."""
    n = F.col(f"{s}.n_tokens")
    chars = F.col(f"{s}.token_chars")
    en, ed = GOPHER_MAX_ELLIPSIS_SHARE
    an, ad = GOPHER_MIN_ALPHA_SHARE
    return {
        "word_count": n.between(GOPHER_MIN_WORDS, GOPHER_MAX_WORDS),
        "mean_word_length": (n > 0) & (chars >= GOPHER_MIN_MEAN_LEN * n)
                            & (chars <= GOPHER_MAX_MEAN_LEN * n),
        "ellipsis_lines": (F.col(f"{s}.n_lines") == 0)
                          | (ed * F.col(f"{s}.n_ellipsis_lines") <= en * F.col(f"{s}.n_lines")),
        "alpha_ratio": (n > 0) & (ad * F.col(f"{s}.n_alpha_tokens") >= an * n),
    }


def gopher_reason(s: str = "gstats", blank: str = "is_blank") -> Column:
    """First failing rule in order empty, word count, mean length, ellipsis, alpha; null = kept."""
    r = rule_columns(s)
    return (F.when(F.col(blank), F.lit("empty"))
            .when(~r["word_count"], F.lit("word_count"))
            .when(~r["mean_word_length"], F.lit("mean_word_length"))
            .when(~r["ellipsis_lines"], F.lit("ellipsis_lines"))
            .when(~r["alpha_ratio"], F.lit("alpha_ratio")))


def gopher_filter(df: DataFrame, text_col: str = "text", keep_stats: bool = False) -> DataFrame:
    """Annotate every row with ``keep`` and ``reason``."""
    out = gopher_stats(df, text_col).withColumn("reason", gopher_reason())
    out = out.withColumn("keep", F.col("reason").isNull())
    if not keep_stats:
        out = out.drop("gstats", "is_blank")
    return out


def gopher_passes(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Only the rows that pass all rules."""
    return gopher_filter(df, text_col).where("keep").drop("keep", "reason")


def gopher_rule(df: DataFrame, rule: str, text_col: str = "text") -> DataFrame:
    """One rule on its own (F1-F5): ``(…, <stat columns>, passes)``."""
    out = gopher_stats(df, text_col)
    if rule == "non_empty":
        passes = ~F.col("is_blank")
    else:
        passes = rule_columns()[rule]
    return out.withColumn("passes", passes)
