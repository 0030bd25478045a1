"""Page extraction jobs: text from pages (P2/P2b), joins of two extractions
(J1, F10, L3), last record per key (W1), key-set intersection (U1)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import html_to_text, strip_tags
from ..functions.text import preview, py_strip

HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
LANG_RE = r"<html[^>]*\blang=\"([A-Za-z-]+)\""
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title\s*>"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST_RE, 1))


def pages_to_text(pages: DataFrame, html_col: str = "html", out_col: str = "text",
                  builtin: bool = False) -> DataFrame:
    """P2 (Arrow helper) or P2b (built-in regex chain) over a page table."""
    fn = strip_tags if builtin else html_to_text
    return pages.withColumn(out_col, fn(F.col(html_col)))


def compare_extractions(a: DataFrame, b: DataFrame, key: str = "url",
                        a_text: str = "text_a", b_text: str = "text_b") -> DataFrame:
    """J1 + F10: inner equi-join on the key, pairs where either side is blank
    after strip dropped, both lengths and previews emitted."""
    j = a.select(key, py_strip(a_text).alias("ta")).join(
        b.select(key, py_strip(b_text).alias("tb")), key, "inner")
    j = j.where((F.col("ta") != "") & (F.col("tb") != ""))
    return j.select(key, F.length("ta").cast("bigint").alias("len_a"),
                    F.length("tb").cast("bigint").alias("len_b"),
                    preview("ta").alias("preview_a"), preview("tb").alias("preview_b"))


def limit_pairs(pairs: DataFrame, n: int = 3, key: str = "url") -> DataFrame:
    """L3: first n pairs in key order (TakeOrderedAndProject, no full sort)."""
    return pairs.orderBy(key).limit(n)


def last_record_per_key(df: DataFrame, key: str, pos: str, cols: list[str]) -> DataFrame:
    """The record with the largest position per key (dict overwrite order).

    ``max_by`` in a partial + final aggregate instead of a window: a hot key
    is reduced map-side and never lands whole in one task.
    """
    rec = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(key).agg(F.max(pos).alias(pos), F.max_by(rec, F.col(pos)).alias("_r"))
            .select(key, pos, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both inputs (INTERSECT)."""
    return a.select(key).intersect(b.select(key))


def filter_by(df: DataFrame, keep: Column | Callable[[str], bool], text_col: str = "text",
              flag: str | None = None) -> DataFrame:
    """Rows that ``keep`` accepts: a Column (built-in expression or Arrow UDF), a plain
    ``str -> bool`` function, which runs over Arrow batches, or a predicate that needs joins (an object
    with ``flag(df, text_col, name)``, such as ``language.English``). Null counts as not kept. With
    ``flag`` every row stays and the verdict is a column of that name."""
    if not isinstance(keep, Column) and hasattr(keep, "flag"):
        name = flag or "_" + "_".join(df.columns)  # no column of df
        judged = keep.flag(df, text_col, name).withColumn(name, F.coalesce(name, F.lit(False)))
        return judged if flag else judged.where(name).drop(name)
    if not isinstance(keep, Column):
        predicate = keep

        @F.pandas_udf("boolean")
        def judged(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: t is not None and bool(predicate(t))).astype(bool)
        keep = judged(F.col(text_col))
    verdict = F.coalesce(keep, F.lit(False))
    return df.where(verdict) if flag is None else df.withColumn(flag, verdict)
