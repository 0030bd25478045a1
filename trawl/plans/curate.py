"""Flagship plan: documents -> language -> quality rules -> PII masking ->
line dedup -> near-duplicate removal, with an outcome per document.

The reference never chains its operators; the order here is ours. Every
stage is a DataFrame job; the only driver round trips are the checkpoint
writes and the component loop's changed-label counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup_lines as DL
from ..operators import gopher as G
from ..operators import minhash as MH
from ..operators import pii as PII
from ..session import materialize
from ..sources.tables import spread, table

#: Sixteen bands of seven rows: the exact join (``lsh_recall_fast``) finds that ten bands of ten miss one similar pair in six.
FLAGSHIP_PARAMS = MH.MinHashParams(num_hashes=112, num_bands=16, ngrams=5,
                                   threshold=0.8, mode="fast")


def curate_corpus(docs: DataFrame, params: MH.MinHashParams = FLAGSHIP_PARAMS,
                  lang: str = "en", in_language: Column | None = None) -> DataFrame:
    """(doc_id, source, outcome, text) for every input document.

    outcome: 'non_<lang>', a Gopher rule name, 'emptied' (line dedup left
    nothing), 'near_duplicate' or 'kept'; text is the PII-masked,
    line-deduplicated text of surviving documents. ``in_language`` decides
    the language (default: the given ``lang`` column; a language model's
    verdict on the text is another choice).
    """
    if in_language is None:
        in_language = F.col("lang") == lang
    base = docs.select("doc_id", "source", "text", F.coalesce(in_language, F.lit(False)).alias("_in"))
    judged = G.gopher_filter(base)
    judged = judged.withColumn("outcome", F.when(~F.col("_in"), F.lit(f"non_{lang}")).otherwise(F.col("reason")))
    judged = materialize(judged, "judged")
    passing = judged.where(F.col("outcome").isNull()).select("doc_id", "text")
    masked = PII.mask_pii(passing).select("doc_id", F.col("masked").alias("text"))
    clean = materialize(DL.dedup_lines(masked), "clean")
    survivors = MH.dedup_minhash(clean.where(F.col("text") != ""), params).select("doc_id", "text")
    emptied = clean.where(F.col("text") == "").select("doc_id", F.lit(True).alias("emptied"))
    out = (judged.select("doc_id", "source", "outcome")
           .join(survivors, "doc_id", "left").join(emptied, "doc_id", "left")
           .withColumn("outcome", F.coalesce(
               "outcome", F.when(F.col("emptied"), F.lit("emptied"))
               .when(F.col("text").isNull(), F.lit("near_duplicate")).otherwise(F.lit("kept")))))
    return out.select("doc_id", "source", "outcome", "text")


def curate_summary(spark: SparkSession, sf_dir: str,
                   params: MH.MinHashParams = FLAGSHIP_PARAMS) -> DataFrame:
    """Documents and characters per outcome."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    cur = curate_corpus(docs, params)
    return (cur.groupBy("outcome")
            .agg(F.count(F.lit(1)).alias("n_docs"),
                 F.sum(F.length(F.coalesce("text", F.lit("")))).cast("bigint").alias("kept_chars"))
            .orderBy("outcome"))
