"""Corpus pipeline: documents through five stages of the llm operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. The first four return the columns of
``documents`` (``n_chars`` follows a rewritten ``text``); the last returns the mix, one row
per document left: doc_id, size, source_size, target and taken words.

Null, empty and very long texts, repeated rows, empty tables and extra columns are treated
as each operator's docstring says; extra columns pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import decontaminate, line_spread, mixing, quality_rules, simhash_cover
from trawl.session import materialize
from trawl.sources.tables import table


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the base rule or an adaptive limit rejects go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: cross-site boilerplate lines stay at their first place only."""
    return _with_length(line_spread.dedup_lines(docs)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (3-word shingles, 2 bits): the smallest doc_id of each group stays."""
    return simhash_cover.keep_one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: benchmark spans are cut; documents mostly made of them go."""
    return _with_length(decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target-weight mix of what is left: words taken of every document."""
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target",
                                           mixing.taken_words(F.col("takes")).alias("taken"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("simhash near-dedup", near_copies),
          ("benchmark decontamination", benchmark), ("source mixing", mix)]

#: XXH64 fingerprints and their components have no DuckDB form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
