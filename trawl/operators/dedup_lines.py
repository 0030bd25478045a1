"""Exact line deduplication (D1) and line frequencies (A1).

A line is kept only if it occurs exactly once in the whole corpus; its key
includes the trailing newline. Every document is emitted, possibly as ''.

Plan: explode lines -> hash aggregate by md5(line) of fixed-width values
only (count, min doc, min position: for a line seen once they are its single
occurrence; a hot line collapses in the map-side partial aggregate and no
line text is shuffled) -> kept positions collected per document -> one join
with the documents on doc_id -> each document picks its kept lines by index
from its own line array. The text crosses the network once (the join), the
aggregate stays hash-based.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_newlines


def split_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, line) with the newline kept on every line but a final one."""
    t = normalize_newlines(F.coalesce(F.col(text_col), F.lit("")))
    lines = F.regexp_extract_all(t, F.lit("[^\n]*\n|[^\n]+\\z"), 0)
    return df.select(F.col(id_col), F.posexplode(lines).alias("pos", "line"))


def line_key(col: str = "line"):
    """128-bit key of a line's UTF-8 bytes (md5 digest, as the reference)."""
    return F.unhex(F.md5(F.col(col)))


def line_frequencies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(line_md5 hex, n) over the whole corpus (partial + final count)."""
    lines = split_lines(df, id_col, text_col)
    return lines.groupBy(F.md5("line").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every line that occurs more than once removed everywhere."""
    lines = split_lines(df, id_col, text_col)
    agg = (lines.groupBy(line_key().alias("k"))
           .agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("d"), F.min("pos").alias("p")))
    kept = (agg.where(F.col("n") == 1)
            .groupBy(F.col("d").alias(id_col)).agg(F.collect_list("p").alias("keep")))
    t = normalize_newlines(F.coalesce(F.col(text_col), F.lit("")))
    docs = df.select(id_col, F.regexp_extract_all(t, F.lit("[^\n]*\n|[^\n]+\\z"), 0).alias("lines"))
    # the join is a plan boundary: `lines` is an attribute below, never re-split per element
    j = docs.join(kept, id_col, "left")
    pick = F.transform(F.array_sort(F.coalesce("keep", F.array().cast("array<int>"))),
                       lambda i: F.element_at(F.col("lines"), i + 1))
    return j.select(id_col, F.array_join(pick, "").alias(text_col))
