"""Line dedup by distinct-site spread: lines seen on many sites are boilerplate.

Per line hash (md5 of the line, 16 bytes) a HyperLogLog sketch of the sites (sources) is
built and merged by aggregation: a line seen a billion times sends one sketch per map
task. Lines whose estimate is clearly below or above ``min_sites`` are decided by it; the
band around the threshold (relative ``band``, several standard errors wide, and at least
one) gets exact distinct counts from the lines' own occurrences. Boilerplate lines stay
once, at their first place by (doc_id, line number), and go everywhere else.

The removals travel as (document, line numbers): line texts are never shuffled and each
document's text crosses the network once, to meet its line numbers.

Defined results: blank lines (white space only) are never counted nor removed; null text
stays null and has no lines; a null source is one site of its own; null ids sort first;
rows that repeat id and text are one document and get one result; an empty table gives an
empty result. Other columns pass through unchanged (``dedup_lines``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACES, null_safe_key, private

MIN_SITES, LG_K, BAND = 5, 12, 0.1


def line_occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, site, pos, line): one row per non-blank line, hashed."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), null_safe_key(F.col("source")).alias("site"),
        F.posexplode(F.split("text", "\n")).alias("pos", "x"))
    return (lines.where(F.length(F.translate("x", SPACES, "")) > 0)
            .select("doc_id", "text_hash", "site", "pos", F.unhex(F.md5("x")).alias("line")))


def boilerplate_lines(occurrences: DataFrame, min_sites: int = MIN_SITES,
                      lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """(line, first): hashes of boilerplate lines and the place where each stays."""
    spread = occurrences.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"),
        F.min(F.struct("doc_id", "text_hash", "pos")).alias("first"))
    lo, hi = min(min_sites * (1 - band), min_sites - 1), max(min_sites * (1 + band), min_sites + 1)
    seen = materialize(spread.where(F.col("sites") >= lo), "line-spread")
    near = seen.where(F.col("sites") <= hi)
    exact = (occurrences.select("line", "site").join(near.select("line"), "line", "left_semi")
             .groupBy("line", "site").agg(F.lit(1).alias("one"))
             .groupBy("line").agg(F.sum("one").alias("n")).where(F.col("n") >= min_sites))
    return (seen.where(F.col("sites") > hi).select("line", "first")
            .unionByName(near.join(exact.select("line"), "line", "left_semi").select("line", "first")))


def removed_lines(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K,
                  band: float = BAND) -> DataFrame:
    """(doc_id, text_hash, removed): sorted line numbers to remove, documents with any only."""
    occ = materialize(line_occurrences(docs), "line-occurrences")
    boiler = boilerplate_lines(occ, min_sites, lg_k, band)
    stays = (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))
             & (F.col("first.pos") == F.col("pos")))
    return (occ.join(boiler, "line").where(~stays)
            .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("removed")))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND,
                n_lines: str | None = None, removed: str | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten. Given their names, columns with the number of lines and with the removed
    lines' numbers (null: none) are added; columns of ``docs`` by these two names are replaced."""
    docs = docs.drop(*(c for c in (n_lines, removed) if c))
    id_, hash_, lines, gone_ = (private(docs.columns, c) for c in ("_id", "_hash", "_lines", "_removed"))
    gone = removed_lines(docs, min_sites, lg_k, band).select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("removed").alias(gone_))
    j = docs.join(gone, docs["doc_id"].eqNullSafe(gone[id_]) & (F.xxhash64(docs["text"]) == gone[hash_]), "left")
    if n_lines:
        j = j.withColumn(n_lines, F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"))
    j = j.withColumn(lines, F.when(F.col(gone_).isNotNull(), F.split("text", "\n")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone_))
    j = j.withColumn("text", F.when(F.col(gone_).isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")))
    if removed:
        j = j.withColumn(removed, F.col(gone_))
    return j.drop(id_, hash_, lines, gone_)
