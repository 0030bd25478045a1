"""Exact dedup: a tree merge of sorted digest runs.

Every text is normalised (each run of the six ASCII blanks becomes one space) and stands for itself as
an entry: a 64-bit digest that orders the runs, the SHA-256 and byte length that verify it, its row
and a count. Rows of one input partition form a run: they are sorted by digest and equal entries
collapse before anything is sent. Runs then meet in rounds: there are ``FANIN ** rounds`` places, a place's number
has one base-``FANIN`` digit a round, and in round r every place deals its run among the ``FANIN`` places that differ
from it in digit r only, by digit r of the entry's digest. A place merges the ``FANIN`` sorted runs it gets: entries are
one only if digest, SHA-256 and length all agree, the smallest identifier stays, counts add up.
After the last round a place holds every entry of its digest range, so the places together are
one sorted run of all digests, and no place ever held more than its share of the distinct texts.

A group of copies of any size is one entry per input partition from the start and is halved in number at least
with each round, so it never lies in one task. Rows learn their group by a join: groups with more than
one in ``HOT_GROUPS`` of all rows (so at most ``HOT_GROUPS`` of them) by broadcast, the others by digest.

Only DataFrame functions are used. Digests and winners are tables in the shared folder, so a lost
executor costs the tasks it ran.

Defined results: a null text counts as empty; equal texts with equal ids (repeated rows) form one
group of which exactly one row stays; null ids come after all others, so ``keep_id`` is null only where all ids of the
group are; empty tables give empty results; other columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import private, text_of

FANIN_LOG2 = 3  # a place merges the runs of 2 ** 3 places a round
MIN_ROUNDS = 2
RUN_ROWS = 1 << 17  # entries a place holds at the end, about
HOT_GROUPS = 1 << 16  # groups above 1 / HOT_GROUPS of all rows are joined by broadcast

#: Runs of blanks that a single space would not already stand for.
_BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_ENTRY = ["digest", "sha", "n_bytes"]


def normalised(text: Column) -> Column:
    """Each run of blanks as one space; null is empty."""
    return F.regexp_replace(text_of(text), _BLANKS, " ")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, digest, sha, n_bytes) for every row, written once: ``row`` tells repeated rows apart."""
    t = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    return materialize(t.select("id", F.monotonically_increasing_id().alias("row"), F.xxhash64("t").alias("digest"),
                                F.unhex(F.sha2("t", 256)).alias("sha"), F.octet_length("t").alias("n_bytes")), "digests")


def rounds_for(rows: int, run_rows: int = RUN_ROWS) -> int:
    """Rounds after which a place holds about ``run_rows`` entries."""
    rounds = MIN_ROUNDS
    while run_rows << (FANIN_LOG2 * rounds) < rows:
        rounds += 1
    return rounds


def _merged(entries: DataFrame) -> DataFrame:
    """One entry of equal ones in a place. The buffer is a struct, so Spark merges in sorted order."""
    return entries.groupBy("place", *_ENTRY).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def merge_runs(rows: DataFrame, rounds: int) -> DataFrame:
    """(place, digest, sha, n_bytes, first, n): one entry per distinct text, sorted within places.

    ``first`` is (id is null, id, row) of the smallest identifier, ``n`` the size of the group.
    """
    places = 1 << (FANIN_LOG2 * rounds)
    runs = _merged(rows.select(F.pmod(F.hash(F.spark_partition_id()), F.lit(places)).alias("place"), *_ENTRY,
                               F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("first"),
                               F.lit(1).cast("long").alias("n")))
    digit = (1 << FANIN_LOG2) - 1
    for r in range(rounds):
        at = FANIN_LOG2 * (rounds - 1 - r)
        mine = F.shiftrightunsigned("digest", 64 - FANIN_LOG2 * (r + 1)).bitwiseAND(F.lit(digit)).cast("int")
        partner = F.col("place").bitwiseAND(F.lit(~(digit << at))).bitwiseOR(F.shiftleft(mine, at))
        dealt = runs.withColumn("place", partner).repartitionById(places, F.col("place"))
        runs = _merged(dealt.sortWithinPartitions("place", *_ENTRY))
    return runs


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN_ROWS,
                 hot_groups: int = HOT_GROUPS) -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, sha) with the normalised text's SHA-256."""
    rows = digest_rows(docs, id_col, text_col)
    total = rows.count()
    won = materialize(merge_runs(rows, rounds_for(total, run_rows)), "digest-runs")
    groups = won.where("n > 1").select("digest", "sha", "n_bytes", F.col("first.id").alias("keep_id"),
                                       F.col("first.row").alias("keep_row"), "n")
    is_hot = F.col("n") * hot_groups > total
    hot = F.broadcast(groups.where(is_hot))  # at most hot_groups rows of some 80 bytes
    out = [F.col("id"), F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
           F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
           F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"), F.col("sha")]
    large = rows.join(hot, _ENTRY).select(*out)
    small = (rows.join(hot.select(*_ENTRY), _ENTRY, "left_anti").join(groups.where(~is_hot), _ENTRY, "left").select(*out))
    return large.unionByName(small)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Of repeated rows of the smallest id one stays, any of them."""
    sha = private(docs.columns, "sha")
    kept = exact_groups(docs, id_col, text_col, **how).where("kept").select(
        F.col("id").alias(private(docs.columns, "kept_id")), F.col("sha").alias(private(docs.columns, "kept_sha")))
    d = docs.withColumn(sha, F.unhex(F.sha2(normalised(F.col(text_col)), 256)))
    same = (d[sha] == kept[kept.columns[1]]) & d[id_col].eqNullSafe(kept[kept.columns[0]])
    return d.join(kept, same, "left_semi").dropDuplicates([id_col, sha]).drop(sha)
