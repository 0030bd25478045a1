"""PII masking job (P3-P6) and totals (A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pii as P


def mask_pii(df: DataFrame, text_col: str = "text", out_col: str = "masked") -> DataFrame:
    """E-mail, then phone, then IP masking, each on the previous output.

    Adds ``out_col`` and ``n_email``, ``n_phone``, ``n_ip``. Pure projection:
    no shuffle, whole-stage codegen around the regex calls.
    """
    t1, n1 = P.mask_emails(F.col(text_col))
    df = df.withColumn("_m1", t1).withColumn("n_email", n1)
    t2, n2 = P.mask_phone_numbers(F.col("_m1"))
    df = df.withColumn("_m2", t2).withColumn("n_phone", n2)
    t3, n3 = P.mask_ips(F.col("_m2"))
    return df.withColumn(out_col, t3).withColumn("n_ip", n3).drop("_m1", "_m2")


def mask_one(df: DataFrame, kind: str, text_col: str = "text", out_col: str = "masked") -> DataFrame:
    t, n = P.mask(F.col(text_col), kind)
    return df.withColumn(out_col, t).withColumn("n_masked", n)


def pii_totals(masked: DataFrame, by: list[str]) -> DataFrame:
    """Replacements per kind and documents touched, per group (partial + final agg)."""
    return masked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_email").cast("bigint").alias("n_email"),
        F.sum("n_phone").cast("bigint").alias("n_phone"),
        F.sum("n_ip").cast("bigint").alias("n_ip"),
        F.sum(F.when(F.col("n_email") + F.col("n_phone") + F.col("n_ip") > 0, 1).otherwise(0))
        .cast("bigint").alias("n_docs_with_pii"))
