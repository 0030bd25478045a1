"""Language identification (M1, F9): character trigrams with naive Bayes weights.

The reference asks a pretrained linear model over n-grams that is not available offline; this one has the
same shape and is trained on the ``lang`` column of the given documents. Every trigram of the training
texts counts. The most frequent ones (``HEAD_GRAMS`` at most, whole classes of frequency) go to every task; the weights of
all others are a table in the shared folder, and texts that hold trigrams outside the head meet it in a join
of their trigram counts, made per distinct text before anything is sent. Which trigrams are in the head changes
no score. With all trigrams in the head a text is judged where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import ENGLISH_MIN_SCORE
from ..functions.text import preprocess_for_classifier
from ..session import drop_table, materialize

#: Overlapping trigrams of running text are not independent: a text counts as the evidence
#: of this many average trigrams, so its score says how clear the language is, not how long the text.
EVIDENCE = 1
#: Trigrams whose weights every task holds (8 bytes, and 8 a language, each).
HEAD_GRAMS = 1 << 18
#: Characters of the texts that are taken together.
RUN_CHARS = 1 << 18
#: Texts meet the sums of their rarer trigrams in this many groups per text, so that copies of one text spread.
SALTS = 8


def language_text(text_col: str | Column) -> Column:
    """What the model sees: newlines as spaces, stripped, lower-cased, a space on both ends; null as blank."""
    seen = F.concat(F.lit(" "), F.lower(preprocess_for_classifier(text_col, lower=False)), F.lit(" "))
    return F.coalesce(seen, F.lit("  "))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code, index of its text) of every character trigram, in text order."""
    c = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    of = np.repeat(np.arange(len(texts)), size)
    code = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    inside = of[:-2] == of[2:]
    return code[inside], of[:-2][inside]


def runs(texts: list[str], limit: int = RUN_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) in runs of about ``limit`` characters, texts whole."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


class Places:
    """The place of codes among sorted ones: by a table of hashed slots, each held by the code put there last, else by search."""

    ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, codes: np.ndarray, last: np.ndarray):
        """``last``: the places in the order in which they take their slots, most frequent ones last."""
        self.codes = codes
        self.shift = np.uint64(64 - max(4, (4 * len(codes)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), dtype=np.int32)
        self.slots[self._slot(codes[last])] = last

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code * self.ODD) >> self.shift).view(np.int64)

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether the code is there)."""
        if not len(self.codes):
            return np.zeros(len(code), dtype=np.int32), np.zeros(len(code), dtype=bool)
        at = self.slots[self._slot(code)]
        known = self.codes[at] == code
        others = np.flatnonzero(~known)
        if len(others):
            place = np.minimum(np.searchsorted(self.codes, code[others]), len(self.codes) - 1)
            at[others], known[others] = place, self.codes[place] == code[others]
        return at, known


class LanguageModel(NamedTuple):
    """Multinomial naive Bayes with add-one smoothing over trigrams."""

    langs: list[str]
    prior: np.ndarray  # log share of the training texts
    base: np.ndarray  # log of (trigrams of the language + vocabulary)
    codes: np.ndarray  # head trigrams, sorted
    weights: np.ndarray  # [trigram, lang] log of (count + 1)
    rest: str | None = None  # table (code, w array<double>) of all other trigrams

    def places(self) -> Places:
        return Places(self.codes, np.argsort(self.weights.sum(axis=1), kind="stable"))

    def sums(self, texts: list[str], places: Places | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums of head weights [text, lang], head trigrams per text; code and text of the others."""
        code, of = trigrams(texts)
        at, known = (places or self.places()).find(code)
        at, whose = at[known], of[known]
        total = np.stack([np.bincount(whose, weights=self.weights[at, i], minlength=len(texts))
                          for i in range(len(self.langs))], axis=1)
        return total, np.bincount(whose, minlength=len(texts)), code[~known], of[~known]

    def judge(self, total: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        """Most probable language and its probability, from the sums over n known trigrams."""
        each = (total - n[:, None] * self.base) / np.maximum(n, 1)[:, None]
        s = self.prior + each * np.minimum(n, EVIDENCE)[:, None]
        e = np.exp(s - s.max(axis=1, keepdims=True))
        best = s.argmax(axis=1)
        score = e[np.arange(len(s)), best] / e.sum(axis=1)
        return pd.DataFrame({"lang": np.array(self.langs, dtype=object)[best], "score": score})


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, code, n): counted inside each run of texts, then one aggregate."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for _, run in runs(texts):
                    u, n = np.unique(trigrams(run)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), type=pa.string()), pa.array(u.view(np.int64)),
                                                      pa.array(n.astype(np.int64))], ["lang", "code", "n"])
    return (docs.select(lang_col, language_text(text_col).alias("t")).mapInArrow(work, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


def train_language_id(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                      head_grams: int = HEAD_GRAMS) -> LanguageModel:
    """Fit on labelled texts: one aggregate. The driver gets a row per head trigram and language.

    The head is whole frequency classes (eighths of powers of two) from the top, as many as fit.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    per_doc = {r[lang_col]: r["n"] for r in labelled.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_doc:
        raise ValueError("no text with a language to learn from")
    langs = sorted(per_doc)
    counts = materialize(trigram_counts(labelled, text_col, lang_col), "trigrams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    wide = counts.groupBy("code").agg(F.sum("n").alias("all"), F.array(*[
        F.log(F.coalesce(F.max(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) + 1) for x in langs]).alias("w"))
    grams = materialize(wide.withColumn("class", F.floor(F.log2("all") * 8).cast("int")), "trigram-weights")
    drop_table(counts)
    sizes = {r["class"]: r["n"] for r in grams.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    least, room = 1 << 30, head_grams
    for c in sorted(sizes, reverse=True):
        room -= sizes[c]
        if room < 0:
            break
        least = c
    head = grams.where(F.col("class") >= least).select("code", "w").toPandas()
    codes = head["code"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(codes)
    weights = np.array(head["w"].tolist(), dtype=float).reshape(-1, len(langs))[order]
    rest = None
    if len(codes) < sum(sizes.values()):
        rest = materialize(grams.where(F.col("class") < least).select("code", "w"), "trigram-rest").table_path
    drop_table(grams)
    base = np.log(np.array([totals.get(x, 0) for x in langs], dtype=float) + sum(sizes.values()))
    prior = np.log(np.array([per_doc[x] for x in langs], dtype=float) / sum(per_doc.values()))
    return LanguageModel(langs, prior, base, codes[order], weights, rest)


def with_language(df: DataFrame, model: LanguageModel, text_col: str | Column = "text", out: str = "_l") -> DataFrame:
    """``df`` with ``out``: struct(lang, score), the most probable language of the text and its probability."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((model, model.places()))
    if model.rest is None:
        @F.pandas_udf("lang string, score double")
        def judge(texts: pd.Series) -> pd.DataFrame:
            (m, places), found = sent.value, []
            for _, run in runs(texts.tolist()):
                total, n, _, _ = m.sums(run, places)
                found.append(m.judge(total, n))
            return pd.concat(found, ignore_index=True)
        return df.withColumn(out, judge(language_text(text_col)))

    k = len(model.langs)
    names = {c: _free(df, c) for c in ("seen", "key", "salt", "head", "total", "n")}

    @F.pandas_udf("total array<double>, n long, code array<long>, count array<long>")
    def head_sums(texts: pd.Series) -> pd.DataFrame:
        (m, places), parts = sent.value, []
        for _, run in runs(texts.tolist()):
            total, n, code, of = m.sums(run, places)
            others, times = [], []
            for c in np.split(code, np.searchsorted(of, np.arange(1, len(run)))):
                u, many = np.unique(c, return_counts=True)
                others.append(u.view(np.int64))
                times.append(many.astype(np.int64))
            parts.append(pd.DataFrame({"total": list(total), "n": n, "code": others, "count": times}))
        return pd.concat(parts, ignore_index=True)

    @F.pandas_udf("lang string, score double")
    def judge_sums(total: pd.Series, n: pd.Series) -> pd.DataFrame:
        return sent.value[0].judge(np.array(total.tolist(), dtype=float).reshape(-1, k), n.to_numpy(dtype=np.int64))

    seen = df.withColumn(names["seen"], language_text(text_col))
    seen = (seen.withColumn(names["key"], F.md5(names["seen"])).withColumn(names["head"], head_sums(names["seen"]))
            .withColumn(names["salt"], F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))))
    head = F.col(names["head"])
    others = (seen.select(F.col(names["key"]).alias("key"), F.explode(F.arrays_zip(head["code"], head["count"])).alias("o"))
              .groupBy("key", F.col("o.code").alias("code")).agg(F.max("o.count").alias("count")))
    rest = spark.read.parquet(model.rest)
    sums = (others.join(rest, "code").groupBy("key").agg(
        F.sum("count").alias(names["n"]),
        F.array(*[F.sum(F.col("count") * F.col("w")[i]) for i in range(k)]).alias(names["total"])))
    spread = sums.select(F.col("key").alias(names["key"]), names["n"], names["total"],
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias(names["salt"]))
    joined = seen.join(spread, [names["key"], names["salt"]], "left")
    total = F.when(F.col(names["total"]).isNull(), head["total"]).otherwise(
        F.zip_with(head["total"], names["total"], lambda a, b: a + b))
    n = head["n"] + F.coalesce(F.col(names["n"]), F.lit(0))
    return joined.withColumn(out, judge_sums(total, n)).select(*df.columns, out)


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = "_" + name
    return name


def identify_language(model: LanguageModel, df: DataFrame, text_col: str = "text",
                      keep: list[str] | None = None) -> DataFrame:
    """(…, lang, score, score_raw): top-1 language; score rounded to 4 places."""
    out = with_language(df, model, text_col, "_l")
    return out.select(*(keep or []), F.col("_l.lang").alias("lang"),
                      F.round("_l.score", 4).alias("score"), F.col("_l.score").alias("score_raw"))


def is_english(lang: str | Column = "lang", score_raw: str | Column = "score_raw") -> Column:
    """label 'en' and unrounded score >= 0.7."""
    lang, score = (F.col(x) if isinstance(x, str) else x for x in (lang, score_raw))
    return (lang == "en") & (score >= ENGLISH_MIN_SCORE)


@dataclass
class English:
    """F9 as a predicate for ``filter_by``: the model calls the text English, with a score of 0.7 or more."""

    model: LanguageModel

    def flag(self, df: DataFrame, text_col: str, name: str) -> DataFrame:
        judged = with_language(df, self.model, text_col, name)
        return judged.withColumn(name, is_english(F.col(name)["lang"], F.col(name)["score"]))
