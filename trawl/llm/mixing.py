"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Targets: the mix takes ``share`` times all words. Sources in code-point order (null
   last) weigh ``weights`` in turn; a target stops at ``cap`` times its source and the
   excess goes to the others by weight (water filling, solved in closed form over one row
   per source).
2. Quotas: ``round(total / block_words)`` equal blocks are seats; seat k of a source has
   the quotient ``target / (2k - 1)`` and the highest quotients win. Seats in falling
   order of quotient fill shards of ``shard_blocks`` blocks, so every shard has integer
   quotas per source and every prefix of shards is itself apportioned. Seats are not
   materialised: among the first n seats a source surely holds all but about one per
   source either side of n * its share, so each shard boundary ranks only that window of
   seats (at most a few rows per source and shard).
3. Blocks: a source is a cyclic stream of its documents in seeded order (md5 of seed and
   doc_id); its quota takes the blocks from the stream's start. Whole passes repeat every
   document; the rest is a prefix of the seeded stream, cut to the word. Offsets come from
   two-level prefix sums (seeded bucket, then inside the bucket), so a hot source is never
   one window.

Single-partition windows run over one row per source only. Defined results: null text has
size 0; null ids are seeded as ''; rows repeating an id are separate documents; an empty
table gives an empty result; a source without words gets target 0. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import null_safe_key, split_words, text_of

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
BLOCK_WORDS, SHARD_BLOCKS, SEED = 32, 16384, 17
#: Seeded buckets per source: a window holds a 4096th of a source.
BUCKET_HEX = 3


def document_sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, src, seed_key): size = words of the whole text."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select("doc_id", "source",
                       F.size(split_words(text_of(F.col("text")))).cast("long").alias("size"),
                       null_safe_key(F.col("source")).alias("src"),
                       F.md5(F.concat(F.lit(f"{seed}:"), ids)).alias("seed_key"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(src, src_rank, source_size, target): one row per source."""
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    by_code = Window.orderBy((F.col("src") == "").cast("int"), "src")
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = per.withColumn("src_rank", F.row_number().over(by_code) - 1)
    per = per.withColumn("w", F.element_at(w, (F.col("src_rank") % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("w"), "src_rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    most = F.col("source_size") * cap
    per = (per.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("w_all", F.sum("w").over(everything))
              .withColumn("level", (F.col("total") - F.coalesce(F.sum(most).over(before), F.lit(0)))
                          / (F.col("w_all") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
              .withColumn("full", most <= F.col("w") * F.col("level")))
    per = per.withColumn("rest", F.col("total") - F.sum(F.when(F.col("full"), most).otherwise(0)).over(everything))
    per = per.withColumn("w_rest", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything))
    return per.select("src", "src_rank", "source_size",
                      F.when(F.col("full"), most.cast("double"))
                      .otherwise(F.col("w") * (F.col("rest") / F.nullif(F.col("w_rest"), F.lit(0.0))))
                      .alias("target"))


def shard_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS,
                 shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(shard, src, first_block, quota): integer quotas by highest quotients target / (2k - 1)."""
    everything = Window.partitionBy()
    t = (targets.withColumn("all_t", F.sum("target").over(everything))
                .withColumn("s", F.count(F.lit(1)).over(everything))
                .withColumn("seats", F.floor(F.col("all_t") / block_words + 0.5)))
    t = t.where(F.col("seats") > 0).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("seats") / shard_blocks) - 1)))
    n = F.least((F.col("shard") + 1) * shard_blocks, F.col("seats"))
    share = F.col("target") / F.col("all_t")
    lo = F.greatest(F.floor((n - F.col("s") / 2 - 2) * share + 0.5), F.lit(0).cast("long"))
    hi = F.floor((n + F.col("s") / 2 + 2) * share + 0.5) + 1
    seats = (t.withColumn("n", n).withColumn("sure", lo)
              .withColumn("k", F.explode(F.sequence(F.col("sure") + 1, F.greatest(hi, F.col("sure") + 1)))))
    in_shard = Window.partitionBy("shard")
    ranked = (seats.withColumn("base", F.sum(F.when(F.col("k") == F.col("sure") + 1, F.col("sure")).otherwise(0)).over(in_shard))
                   .withColumn("place", F.row_number().over(in_shard.orderBy(
                       (F.col("target") / (2 * F.col("k") - 1)).desc(), "src_rank"))))
    won = (F.col("place") <= F.col("n") - F.col("base")).cast("long")
    held = ranked.groupBy("src", "shard").agg((F.max("sure") + F.sum(won)).alias("held"))
    last = F.coalesce(F.lag("held").over(Window.partitionBy("src").orderBy("shard")), F.lit(0).cast("long"))
    return held.select("shard", "src", last.alias("first_block"), (F.col("held") - last).alias("quota"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP,
                block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS,
                seed: int = SEED) -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target, stream_start, takes).

    ``takes``: array of (copies, from_word, to_word), the word spans of this document
    that the mix holds; ``stream_start``: the document's first word in its source's stream.
    """
    sizes = materialize(document_sizes(docs, seed), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, cap), "mix-targets")
    quotas = shard_quotas(targets, block_words, shard_blocks)
    blocks = quotas.groupBy("src").agg(F.sum("quota").alias("blocks"))
    plan = targets.join(blocks, "src", "left").select(
        "src", "source_size", "target",
        F.least(F.coalesce("blocks", F.lit(0)) * block_words, F.col("source_size") * cap).alias("words"))
    sizes = sizes.withColumn("bucket", F.substring("seed_key", 1, BUCKET_HEX))
    by_bucket = sizes.groupBy("src", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (by_bucket.withColumn("bucket_start", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
              .drop("in_bucket").join(plan, "src"))
    inside = (Window.partitionBy("src", "bucket").orderBy("seed_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (sizes.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, ["src", "bucket"]))
    start = F.col("bucket_start") + F.col("inside")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rest = F.greatest(F.least(F.col("words") - F.col("passes") * F.col("source_size") - F.col("stream_start"),
                              F.col("size")), F.lit(0))
    span = lambda n, to: F.struct(n.cast("long").alias("copies"), F.lit(0).cast("long").alias("from_word"),
                                  to.cast("long").alias("to_word"))
    return (rows.withColumn("stream_start", start).withColumn("passes", passes)
            .select("doc_id", "source", "size", "source_size", "target", "stream_start",
                    F.filter(F.array(span(F.col("passes"), F.col("size")), span(F.lit(1), rest)),
                             lambda x: (x["copies"] > 0) & (x["to_word"] > 0)).alias("takes")))


def taken_words(takes):
    return F.aggregate(takes, F.lit(0).cast("long"),
                       lambda a, x: a + x["copies"] * (x["to_word"] - x["from_word"]))


def shard_pieces(mix: DataFrame, quotas: DataFrame, block_words: int = BLOCK_WORDS,
                 shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(doc_id, source, shard, copy, from_word, to_word): the mix written out shard by shard.

    ``mix`` and ``quotas`` come from ``mix_sources`` and ``shard_quotas`` with the same
    parameters. Blocks of a source go to shards in order, and spans meet the shards' block
    ranges on cells of ``shard_blocks`` blocks (a span or a range touches a few cells).
    """
    spans = (mix.select("doc_id", "source", null_safe_key(F.col("source")).alias("src"), "source_size", "stream_start",
                        F.posexplode("takes").alias("nth", "t"), F.col("takes")[0]["copies"].alias("whole"))
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("t.copies") - 1)).alias("i")))
    copy = F.col("i") + F.when(F.col("nth") > 0, F.col("whole")).otherwise(0)
    first = copy * F.col("source_size") + F.col("stream_start") + F.col("t.from_word")
    spans = spans.select("doc_id", "source", "src", copy.alias("copy"), F.col("t.from_word").alias("word"),
                         first.alias("first"), (first + F.col("t.to_word") - F.col("t.from_word")).alias("end"))
    cell = shard_blocks * block_words
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / cell), F.floor((b - 1) / cell))).alias("cell")
    spans = spans.select("*", cells(F.col("first"), F.col("end")))
    ranges = quotas.where("quota > 0").select(
        "shard", "src", (F.col("first_block") * block_words).alias("a"),
        ((F.col("first_block") + F.col("quota")) * block_words).alias("b"))
    ranges = ranges.select("*", cells(F.col("a"), F.col("b")))
    here = ((F.col("first") < F.col("b")) & (F.col("end") > F.col("a"))
            & (F.floor(F.greatest("first", "a") / cell) == F.col("cell")))  # a pair is found in one cell only
    start, stop = F.greatest("first", "a"), F.least("end", "b")
    return (spans.join(ranges, ["src", "cell"]).where(here)
            .select("doc_id", "source", "shard", "copy", (F.col("word") + start - F.col("first")).alias("from_word"),
                    (F.col("word") + stop - F.col("first")).alias("to_word")))
