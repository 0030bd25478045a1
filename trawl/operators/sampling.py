"""Deterministic sampling, ranking and splitting.

Every random choice of the reference becomes an order on a seeded md5 of the
key, so results are reproducible, independent of partitioning, and
expressible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import CHUNK_GROUP_SIZE, SHARD_SHUFFLE_SEED, SPLIT_SEED
from ..session import materialize


def seeded_key(col, seed: int) -> Column:
    """md5 hex of "<seed>:<value>" -- the shuffle order for a seed."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in a global order, written once with its row number inside (_pid, _idx).

    Row numbers of a plan that runs twice may differ (column pruning and
    adaptive coalescing change its partitions). So the sorted rows and their
    numbers are one written table, and everything later reads that table.
    """
    s = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    return materialize(s.withColumn("_pid", F.shiftright("_mid", 33))
                       .withColumn("_idx", F.col("_mid").bitwiseAND((1 << 33) - 1)).drop("_mid"), name)


def partition_offsets(rows: DataFrame, total: Column) -> DataFrame:
    """(_pid, _off): sum of ``total`` over earlier partitions (a row per partition)."""
    per = rows.groupBy("_pid").agg(total.alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """1-based consecutive rank in a global order without a single-partition window.

    Range-partitioned sort, written once -> per-partition counts -> prefix
    over one row per partition -> broadcast offsets (size bounded by the
    partition count).
    """
    s = numbered(df, order, "ranked")
    offs = partition_offsets(s, F.count(F.lit(1)))
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(rank_col, F.col("_off") + F.col("_idx") + 1)
            .drop("_pid", "_idx", "_off"))


#: Buckets of a seeded key (its first hex digits) that the histogram of a selection counts.
KEY_DIGITS = 4


def smallest_keys(df: DataFrame, n: int, key: str, seed: int = 0) -> tuple[DataFrame, int]:
    """(the n rows with the smallest seeded keys, the population), for n of any size.

    A histogram of key prefixes (65,536 rows at most) tells which bucket holds the n-th key: rows of smaller buckets are taken
    where they lie, and only the boundary bucket is ranked. Null keys come first.
    """
    k = F.coalesce(seeded_key(key, seed), F.lit(""))
    bucket = F.substring(k, 1, KEY_DIGITS)
    sizes = sorted((r["b"], r["n"]) for r in df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
    total, left = sum(x for _, x in sizes), n
    for b, size in sizes:
        if size >= left:
            break
        left -= size
    else:
        return df, total
    rank = "_" + "_".join(df.columns)  # no column of df
    edge = global_rank(df.where(bucket == b), [k, F.col(key)], rank).where(F.col(rank) <= left).select(*df.columns)
    return df.where(bucket < b).unionByName(edge), total


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0, check: bool = True) -> DataFrame:
    """L1: n rows without replacement (smallest seeded keys), selected in place whatever n is.

    ``check`` raises like ``random.sample`` when n exceeds the population.
    """
    chosen, total = smallest_keys(df, n, key, seed)
    if check and n > total:
        raise ValueError("Sample larger than population or is negative")
    return chosen


def seeded_prefix_sample(paths: DataFrame, n_files: int, key: str = "path",
                         seed: int = SHARD_SHUFFLE_SEED,
                         group_size: int = CHUNK_GROUP_SIZE) -> DataFrame:
    """L2: the first n paths (rounded down to a multiple of group_size) of a shuffled order with a fixed
    seed. A larger n always returns a superset of a smaller n. No sort: see ``smallest_keys``."""
    return smallest_keys(paths, n_files - n_files % group_size, key, seed)[0]


def assign_chunks(paths: DataFrame, n_files: int, key: str = "path",
                  seed: int = SHARD_SHUFFLE_SEED, group_size: int = CHUNK_GROUP_SIZE) -> DataFrame:
    """(path, rank, chunk) -- consecutive groups of ``group_size`` in shuffled order.
    One distributed sort ranks all paths; n only filters on the rank."""
    n = n_files - (n_files % group_size)
    ranked = global_rank(paths, [seeded_key(key, seed), F.col(key)]).where(F.col("rank") <= n)
    return ranked.withColumn("chunk", F.floor((F.col("rank") - 1) / group_size).cast("bigint"))


def train_test_split(df: DataFrame, key: str, test_share_denominator: int = 5,
                     seed: int = SPLIT_SEED) -> DataFrame:
    """1 in ``test_share_denominator`` rows go to 'test' by seeded hash;
    stable under repartitioning (unlike randomSplit)."""
    h = F.conv(F.substring(seeded_key(key, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("split", F.when(h % test_share_denominator == 0, F.lit("test"))
                         .otherwise(F.lit("train")))


def pending(selected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Selected keys with no finished output (left anti join)."""
    return selected.join(done.select(key), key, "left_anti")
