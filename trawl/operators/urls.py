"""Reference-URL extraction from dump lines (P11), distinct sorted names (U4),
per-shard counts (A6) and first shards (L4); the URL-list sink (S8) is in sources/url_list.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import REF_TAG_RE, URL_RE


def reference_span(line: Column) -> Column:
    """Greedy span from the first opening to the last closing escaped ref tag."""
    return F.regexp_extract(line, REF_TAG_RE, 0)


def extract_reference_urls(lines: DataFrame, line_col: str = "line",
                           keep: list[str] | None = None) -> DataFrame:
    """One row per URL found inside a line's reference span, duplicates kept,
    with its position in the line (posexplode keeps the per-line order)."""
    span = reference_span(F.col(line_col))
    urls = F.regexp_extract_all(span, F.lit("(?U)" + URL_RE), 0)
    return lines.select(*(keep or []), F.posexplode(urls).alias("url_pos", "url"))


def distinct_sorted_matches(df: DataFrame, col: str, pattern: str, group: int = 1,
                            out: str = "name") -> DataFrame:
    """U4: sorted distinct regex matches (explode, distinct, range-partitioned sort)."""
    m = F.explode(F.regexp_extract_all(F.col(col), F.lit(pattern), group)).alias(out)
    return df.select(m).distinct().orderBy(out)


def first_n(names: DataFrame, col: str, n: int | None) -> DataFrame:
    """L4: sorted names, first n (None = all, 0 = none)."""
    s = names.select(col).distinct()
    if n is None:
        return s.orderBy(col)
    return s.orderBy(col).limit(n)


def urls_per_shard(urls: DataFrame, shard_col: str = "shard") -> DataFrame:
    """URLs per shard plus the total (ROLLUP row with a null shard)."""
    return urls.rollup(shard_col).agg(F.count(F.lit(1)).alias("n_urls"))
