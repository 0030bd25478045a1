"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets a few integer metrics in one pass over its whole text. The
distribution of each metric is sketched per (language, source) as counts per logarithmic
bin: values below 64 have a bin each, larger ones keep their six leading bits, so a
quantile read from the sketch is off by under 1/32 of its value. Sketches are plain
counts: they merge by addition, pre-aggregate before the shuffle (a hot source sends at
most a row per bin and task) and give the same thresholds at any partitioning.

A share that a few occurrences make says little: metrics are lower bounds, (x - 2 sqrt(x)) / n for x occurrences among
n. A limit is a fence from the upper part of the group's own sketch: q90 + ``spread`` * (q90 - q50), and one
unit of the sketch, which it cannot tell apart. Where nine texts in ten have nothing of a metric, any share that is
more than chance is beyond the fence; where a group's texts spread, its limit spreads with them. There is no switch for small groups: a
group's counts are blended with its language's as if ``prior`` texts of the language were among its own, and a
language's with the whole corpus' alike, so a group follows its own texts by the weight n / (n + prior). Weights are
exact integers. The limits are joined to the metrics in ``SALTS`` copies, so that a hot source's texts spread over tasks;
a document above any limit goes.

Defined results: null text has no words (it fails the base rule); null language or source
is a group of its own; rows repeating an id are judged one by one; an empty table gives an
empty result; very long texts are processed whole; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACES, UPPER, null_safe_key, split_words, text_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPREAD, PRIOR, SALTS = 3, 200, 16
#: Shares in thousandths, as lower bounds.
METRICS = ("symbol_mille", "dup_line_mille", "repeat_mille", "caps_mille")
_EXACT = "decimal(38,0)"


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _window_hashes(words: Column) -> Column:
    """64-bit hashes of the 3-word windows of a word-array column, in text order."""
    n = F.size(words)
    return F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def _repeat_starts(pairs: Column) -> Column:
    """Starts, in text order, of windows whose hash a neighbour in the sorted pairs shares."""
    def repeats(p, j):
        return (F.coalesce(F.get(pairs, j - 1)["h"] == p["h"], F.lit(False))
                | F.coalesce(F.get(pairs, j + 1)["h"] == p["h"], F.lit(False)))
    return F.sort_array(F.transform(F.filter(pairs, repeats), lambda p: p["i"]))


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at the given sorted starts."""
    return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
                       lambda a, i: F.struct((a["n"] + F.least(i - a["at"], F.lit(3))).alias("n"), i.alias("at")),
                       lambda a: a["n"])


def document_metrics(docs: DataFrame) -> DataFrame:
    """Keys (doc_id, lang, source, text_hash) and the integer metrics of each whole text.

    Each array used more than once is a column of its own projection, so that no
    expression is evaluated per element.
    """
    t = docs.select("doc_id", "lang", "source", text_of(F.col("text")).alias("t"),
                    F.xxhash64(F.col("text")).alias("text_hash"))
    t = t.select("*", split_words(F.col("t")).alias("words"),
                 F.filter(F.split("t", "\n"), lambda x: _without(x, SPACES) > 0).alias("lines"))
    t = t.select("doc_id", "lang", "source", "text_hash",
                 F.size("words").cast("long").alias("n_words"),
                 _without(F.col("t"), SPACES).cast("long").alias("word_chars"),
                 (F.length("t") - _without(F.col("t"), SYMBOLS)).cast("long").alias("n_symbols"),
                 (F.length("t") - _without(F.col("t"), UPPER)).cast("long").alias("n_caps"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 _window_hashes(F.col("words")).alias("hashes"))
    # Most prose repeats no window: only texts that do sort their (hash, start) pairs.
    t = t.withColumn("pairs", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    t = t.withColumn("n_repeat_words", F.coalesce(
        F.when(F.col("pairs").isNotNull(), _covered(_repeat_starts(F.col("pairs")))), F.lit(0).cast("long")))

    def mille(n: str, of: str) -> Column:
        sure = F.greatest(F.col(n) - 2 * F.sqrt(n), F.lit(0.0))
        return F.when(F.col(of) > 0, F.floor(1000 * sure / F.col(of))).otherwise(F.lit(0)).cast("long")
    return t.select("doc_id", "lang", "source", "text_hash", "n_words", "word_chars", "n_symbols",
                    "n_dup_lines", "n_repeat_words",
                    mille("n_symbols", "word_chars").alias("symbol_mille"),
                    mille("n_dup_lines", "n_lines").alias("dup_line_mille"),
                    mille("n_repeat_words", "n_words").alias("repeat_mille"),
                    mille("n_caps", "word_chars").alias("caps_mille"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _unit(x: Column) -> Column:
    """The width of the bin that holds x."""
    return F.pow(F.lit(2.0), F.greatest(F.length(F.bin(x)) - 6, F.lit(0))).cast("long")


def sketch_bin(x: Column) -> Column:
    """The value with its six leading bits kept (exact below 64)."""
    return x - x % _unit(x)


def quantile_sketches(metrics: DataFrame) -> DataFrame:
    """(lang_key, source_key, metric, bin, n): the mergeable sketches."""
    one = [F.struct(F.lit(m).alias("metric"), sketch_bin(F.col(m)).alias("bin")) for m in METRICS]
    return (metrics.select(null_safe_key(F.col("lang")).alias("lang_key"),
                           null_safe_key(F.col("source")).alias("source_key"),
                           F.explode(F.array(*one)).alias("x"))
            .groupBy("lang_key", "source_key", "x.metric", "x.bin").agg(F.count(F.lit(1)).alias("n")))


def adaptive_limits(sketches: DataFrame, spread: int = SPREAD, prior: int = PRIOR) -> DataFrame:
    """(lang_key, source_key, limit_<metric>...): fences of the blended sketches.

    With c texts in a bin, N texts in all and s = ``prior``, a language's blended count is c * N_all + s * c_all (of
    N_all * (N + s)), a source's c * N_all * (N_lang + s) + s * (that of its language).
    """
    sketches = sketches.withColumn("n", F.col("n").cast(_EXACT))
    s = F.lit(prior).cast(_EXACT)
    one = sketches.where(F.col("metric") == METRICS[0])  # every text is once in each metric
    n_all = one.agg(F.sum("n").cast(_EXACT)).first()[0]
    whole = F.lit(n_all if n_all is not None else 0).cast(_EXACT)
    # shares of a thousand have 224 bins at most: this is under a thousand rows
    corpus = F.broadcast(sketches.groupBy("metric", "bin").agg(F.sum("n").cast(_EXACT).alias("c_all")))
    in_lang = sketches.groupBy("lang_key", "metric", "bin").agg(F.sum("n").cast(_EXACT).alias("c"))
    n_lang = one.groupBy("lang_key").agg(F.sum("n").cast(_EXACT).alias("n_lang"))
    n_own = one.groupBy("lang_key", "source_key").agg(F.sum("n").cast(_EXACT).alias("n_own"))
    metrics = F.explode(F.array(*map(F.lit, METRICS))).alias("metric")
    by_lang = (n_lang.select("lang_key", "n_lang", metrics).join(corpus, "metric")
               .join(in_lang, ["lang_key", "metric", "bin"], "left")
               .select("lang_key", "metric", "bin", (whole * (F.col("n_lang") + s)).cast(_EXACT).alias("lang_total"),
                       (F.coalesce("c", F.lit(0).cast(_EXACT)) * whole + s * F.col("c_all")).cast(_EXACT).alias("lang_c")))
    keys = ["lang_key", "source_key", "metric"]
    own = sketches.select(*keys, "bin", "n")
    blended = (n_own.select("lang_key", "source_key", "n_own", metrics).join(by_lang, ["lang_key", "metric"])
               .join(own, [*keys, "bin"], "left")
               .select(*keys, "bin", (F.col("lang_total") * (F.col("n_own") + s)).cast(_EXACT).alias("total"),
                       (F.coalesce("n", F.lit(0).cast(_EXACT)) * F.col("lang_total") + s * F.col("lang_c")).cast(_EXACT).alias("c")))
    up_to = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    q = blended.select(*keys, "bin", "total", F.sum("c").over(up_to).alias("cum")).groupBy(*keys).agg(
        F.min(F.when(2 * F.col("cum") >= F.col("total"), F.col("bin"))).alias("q50"),
        F.min(F.when(10 * F.col("cum") >= 9 * F.col("total"), F.col("bin"))).alias("q90"))
    limit = F.col("q90") + spread * (F.col("q90") - F.col("q50")) + _unit(F.col("q90"))
    return q.groupBy("lang_key", "source_key").agg(*[
        F.max(F.when(F.col("metric") == m, limit)).alias(f"limit_{m}") for m in METRICS])


def judge_quality(docs: DataFrame, spread: int = SPREAD, prior: int = PRIOR) -> DataFrame:
    """Keys, metrics, limits, ``base_failed`` and ``kept`` for every row of ``docs``."""
    metrics = materialize(document_metrics(docs), "quality-metrics")
    sketches = materialize(quantile_sketches(metrics), "quality-sketches")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    limits = adaptive_limits(sketches, spread, prior).withColumn("salt", salts)
    salt = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int")
    joined = (metrics.withColumn("lang_key", null_safe_key(F.col("lang")))
              .withColumn("source_key", null_safe_key(F.col("source"))).withColumn("salt", salt)
              .join(limits, ["lang_key", "source_key", "salt"]).drop("salt"))
    within = reduce(lambda a, m: a & (F.col(m) <= F.col(f"limit_{m}")), METRICS, F.lit(True))
    return (joined.drop("lang_key", "source_key").withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & within))


def keep_good(docs: DataFrame, spread: int = SPREAD, prior: int = PRIOR) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    good = judge_quality(docs, spread, prior).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
        F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    same = (docs["doc_id"].eqNullSafe(good["_id"]) & (F.xxhash64(docs["text"]) == good["_hash"])
            & docs["lang"].eqNullSafe(good["_lang"]) & docs["source"].eqNullSafe(good["_source"]))
    return docs.join(good, same, "left_semi")
