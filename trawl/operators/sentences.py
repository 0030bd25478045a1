"""Sentence ends with learned abbreviations (for the word tokenizer of F1-F4).

The reference's tokenizer splits a text into sentences first, with a model that knows abbreviations: the period of
"Dr." stays with its word, the period that ends a sentence is a token. The model is learned here from the corpus itself, after
Kiss and Strunk (2006): an abbreviation is a word that collocates with a following period. For a word type seen c times, k
times with a period, among N words of which P carry one, the log-likelihood ratio compares "periods fall as anywhere" (p = P / N)
with "nearly always" (p = 0.99); it is weighted by exp(-letters) (abbreviations are short), by inner periods + 1, and by
letters ^ -(times without period). Types that score 0.3 or more are abbreviations.

Counting is one aggregate over (type, with, without); a text's decisions are a join of its period-bearing types with the
learned table, pre-aggregated per text, so neither depends on how many types there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# ---------------------------------------------------------------------------
# FIXED VALUES -- of the published method: share of periods after an abbreviation, least score.
# ---------------------------------------------------------------------------
NEARLY_ALWAYS, LEAST_SCORE = 0.99, 0.3

#: A word with what may stand around it: opening marks, letters with inner periods, then period or not, closing marks.
WORD = r"^[\"'(\[{]*(\p{L}+(?:\.\p{L}+)*)(\.?)[\"')\]},;:]*$"
#: A sentence ends with one of these, closing marks after it or not.
TERMINAL = r"[.!?][\"')\]}]*$"


def tokens(text: Column) -> Column:
    """Runs of anything but the six ASCII blanks; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), 0)


def type_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(type, with_period, without_period) over all words of all texts, lower-cased."""
    w = docs.select(F.explode(tokens(F.col(text_col))).alias("t"))
    w = w.select(F.lower(F.regexp_extract("t", WORD, 1)).alias("type"), (F.regexp_extract("t", WORD, 2) == ".").cast("long").alias("k"))
    return w.where("type <> ''").groupBy("type").agg(F.sum("k").alias("with_period"), F.sum(1 - F.col("k")).alias("without_period"))


def learn_abbreviations(counts: DataFrame) -> DataFrame:
    """(type, with_period, without_period, score, abbreviation) of types seen with a period.

    ``counts`` is read twice: give a written table.
    """
    total = counts.agg(F.sum("with_period").alias("p"), F.sum(F.col("with_period") + F.col("without_period")).alias("n")).first()
    share = min(max((total["p"] or 0) / (total["n"] or 1), 1e-9), 1 - 1e-9)
    k, rest = F.col("with_period"), F.col("without_period")
    anywhere = k * F.log(F.lit(share)) + rest * F.log(F.lit(1 - share))
    always = k * F.log(F.lit(NEARLY_ALWAYS)) + rest * F.log(F.lit(1 - NEARLY_ALWAYS))
    letters = F.length(F.replace(F.col("type"), F.lit("."), F.lit("")))
    score = (-2 * (anywhere - always) * F.exp(-letters) * (F.length("type") - letters + 1) * F.pow(letters.cast("double"), -rest))
    return counts.where(k > 0).withColumn("score", score).withColumn("abbreviation", F.col("score") >= LEAST_SCORE)


def sentence_counts(docs: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_abbreviations, n_sentences, n_tokens) for every row.

    A word that ends with '.', '!' or '?' ends a sentence, unless it is an abbreviation with its period; what follows the last end is a
    sentence too. Tokens are the words, and the periods that end sentences. Rows that repeat an id and text count alike.
    """
    t = materialize(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), tokens(F.col(text_col)).alias("ts"))
                    .select("id", "text_hash", F.size("ts").cast("long").alias("n_words"), F.filter("ts", lambda x: F.regexp_like(x, F.lit(TERMINAL))).alias("ends"),
                            F.coalesce(F.regexp_like(F.try_element_at("ts", F.lit(-1)), F.lit(TERMINAL)), F.lit(True)).alias("closed")), "terminals")
    types = t.select("id", "text_hash", F.explode(F.array_distinct(F.transform("ends", lambda x: F.when(
        F.regexp_extract(x, WORD, 2) == ".", F.lower(F.regexp_extract(x, WORD, 1)))))).alias("type")).where("type IS NOT NULL").distinct()
    known = (types.join(learned.where("abbreviation").select("type"), "type").groupBy("id", "text_hash")
             .agg(F.collect_set("type").alias("known")).withColumnsRenamed({"id": "known_id", "text_hash": "known_hash"}))
    same = F.col("id").eqNullSafe(F.col("known_id")) & F.col("text_hash").eqNullSafe(F.col("known_hash"))
    j = t.join(known, same, "left").select(
        "id", "n_words", "ends", "closed", F.coalesce("known", F.array().cast("array<string>")).alias("known"))

    def is_known(x: Column) -> Column:
        return (F.regexp_extract(x, WORD, 2) == ".") & F.array_contains("known", F.lower(F.regexp_extract(x, WORD, 1)))
    j = j.withColumn("short", F.size(F.filter("ends", is_known)).cast("long"))
    periods = F.size(F.filter("ends", lambda x: F.regexp_like(x, F.lit(r"\.[\"')\]}]*$")))).cast("long") - F.col("short")
    last_short = (F.size("ends") > 0) & F.col("closed") & is_known(F.try_element_at("ends", F.lit(-1)))
    open_end = (F.col("n_words") > 0) & (~F.col("closed") | F.coalesce(last_short, F.lit(False)))
    return j.select(F.col("id").alias(id_col), "n_words", F.col("short").alias("n_abbreviations"),
                    (F.size("ends") - F.col("short") + open_end.cast("long")).cast("long").alias("n_sentences"),
                    (F.col("n_words") + periods).alias("n_tokens"))
