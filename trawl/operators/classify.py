"""Content classifiers (M2-M6); language identification is in ``language.py``.

The reference calls pretrained fastText models that are not available
offline. fastText is a linear model over n-gram features; the same shape here:
Spark ML logistic regressions over words (and the look of the text) for toxicity and
quality, trained on the labels of the given tables. A fitted model is shipped
to executors once and applied to any text, labelled or not.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer,
                                RegexTokenizer, SQLTransformer, StopWordsRemover, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import preprocess_for_classifier
from ..session import drop_table, materialize

#: Rows of feature vectors that a training task has at least, when there are more.
ROWS_PER_PARTITION = 2_000
#: Words in fewer training documents carry no weight (they are memorised, not learned).
MIN_DOCS = 4

# ---------------------------------------------------------------------------
# FIXED VALUES -- label names of the reference's classifiers.
# ---------------------------------------------------------------------------
NSFW_LABELS = ("non-nsfw", "nsfw")
TOXIC_LABELS = ("non-toxic", "toxic")
QUALITY_LABELS = ("cc", "wiki")


def _balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """weight = n / (k * n_class): classes count equally (the labels are skewed)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    n_classes = counts.count()
    tot = counts.agg(F.sum("_c")).first()[0]
    w = counts.select(label, (F.lit(tot) / (n_classes * F.col("_c"))).alias("weight"))
    return df.join(F.broadcast(w), label)  # one row per class


# ------------------------------------------------------------------ M2/M3 content
def _partitioned(vectors: DataFrame) -> DataFrame:
    """Feature vectors in a task per core at most, kept for the iterations: every task of an iteration
    sends a gradient as long as the vocabulary, so their number must not grow with the rows. They are
    written once, without the names of features (which every task of every iteration would carry as
    part of its schema), so that no task carries the feature models and a lost block costs no tokenising."""
    unnamed = [F.col(c).alias(c, metadata={"comment": ""}) for c in vectors.columns]  # an empty one would keep the old
    vectors = materialize(vectors.select(*unnamed), "train-vectors")
    n, cores = vectors.count(), vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(max(1, min(cores, -(-n // ROWS_PER_PARTITION)))).persist()


def _most_frequent(terms: DataFrame, size: int) -> list[str]:
    """The ``size`` most frequent terms of an array column, by falling count, then term."""
    name = terms.columns[0]
    counts = terms.select(F.explode(name).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return [r["term"] for r in counts.orderBy(F.col("n").desc(), "term").limit(size).collect()]


def train_binary_text(df: DataFrame, label_col: str, text_col: str = "text",
                      min_docs: int = MIN_DOCS) -> PipelineModel:
    """Presence of words (in at least ``min_docs`` training documents), class-balanced
    logistic regression; the L1 penalty keeps the few words that matter."""
    x = df.where(F.col(label_col).isNotNull()).select(
        preprocess_for_classifier(text_col).alias("t"), F.col(label_col).cast("double").alias("label"))
    x = _balanced_weights(x, "label").persist()
    tok = RegexTokenizer(inputCol="t", outputCol="words", pattern=r"(?U)\b\w\w+\b", gaps=False)
    cv = CountVectorizer(inputCol="words", outputCol="features", binary=True, minDF=float(min_docs), vocabSize=1 << 18)
    feat = Pipeline(stages=[tok, cv]).fit(x)
    vectors = _partitioned(feat.transform(x).select("features", "label", "weight"))
    try:
        lr = LogisticRegression(weightCol="weight", maxIter=200, regParam=0.003, elasticNetParam=1.0,
                                standardization=False).fit(vectors)
    finally:
        vectors.unpersist()
        x.unpersist()
    return PipelineModel(stages=[*feat.stages, lr])


def classify_binary(model: PipelineModel, df: DataFrame, names: tuple[str, str],
                    text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(…, label, score): label name of the predicted class and its probability."""
    out = model.transform(df.withColumn("t", preprocess_for_classifier(F.coalesce(F.col(text_col), F.lit("")))))
    prob = vector_to_array("probability")
    pred = F.col("prediction").cast("int")
    return out.select(*(keep or []), F.when(pred == 1, F.lit(names[1])).otherwise(F.lit(names[0])).alias("label"),
                      F.element_at(prob, pred + 1).alias("score"), pred.alias("prediction"))


def relabel(classified: DataFrame, names: dict[str, str]) -> DataFrame:
    """The same decisions under other label names (M2 is M3 with NSFW labels)."""
    new = F.col("label")
    for old, name in names.items():
        new = F.when(F.col("label") == old, name).otherwise(new)
    return classified.withColumn("label", new)


# ------------------------------------------------------------------ M4/M5 quality
#: Shares of a text's characters that are neither letters nor spaces, capitals, and symbols
#: (all near zero in prose, so that the fit starts well conditioned).
LOOK = ("look_others", "look_capitals", "look_symbols")
LOOK_SCALE = 10.0


def with_look(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the LOOK columns, on the scale of a unit-length term vector times LOOK_SCALE."""
    n = F.greatest(F.length(text_col), F.lit(1))
    for name, pattern in zip(LOOK, (r"[^\p{L} ]", r"\p{Lu}", r"[^\p{L}\p{N}\s.,;:'\-]"), strict=True):
        df = df.withColumn(name, F.coalesce(
            (F.length(text_col) - F.length(F.regexp_replace(text_col, pattern, ""))) / n * LOOK_SCALE, F.lit(0.0)))
    return df


def train_quality_classifier(train: DataFrame, text_col: str = "text", label_col: str = "label",
                             vocab_size: int = 50_000, max_iter: int = 100,
                             balanced: bool = False) -> PipelineModel:
    """The look of the text beside TF-IDF (English stop words, 1-2-grams, top vocab by corpus
    frequency): idf = ln((1+n)/(1+df)) + 1 (tf * (idf_spark + 1)), rows L2-normalised. The
    logistic regression has an elastic-net penalty: a plain L2 fit over 50,000 mostly rare
    terms neither converges nor finds the minority class among a few hundred labels."""
    x = train.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("double").alias("label"))
    x = with_look(x).persist()                        # read by the vocabulary and the term counts
    tok = RegexTokenizer(inputCol="text", outputCol="tok", pattern=r"(?U)\b\w\w+\b", gaps=False)
    sw = StopWordsRemover(inputCol="tok", outputCol="words")
    bi = NGram(n=2, inputCol="words", outputCol="bigrams")
    cat = SQLTransformer(statement="SELECT *, concat(words, bigrams) AS terms FROM __THIS__")
    split = PipelineModel(stages=[tok, sw, bi, cat])  # none of them learns anything
    vocabulary = _most_frequent(split.transform(x).select("terms"), vocab_size)
    feat = PipelineModel(stages=[*split.stages, CountVectorizerModel.from_vocabulary(vocabulary, "terms", "tf")])
    tfed = materialize(feat.transform(x).select("tf", "label", *LOOK), "train-terms")
    x.unpersist()
    idf = IDF(inputCol="tf", outputCol="_idf").fit(tfed)
    scale = ElementwiseProduct(inputCol="tf", outputCol="tfidf",
                               scalingVec=Vectors.dense([v + 1.0 for v in idf.idf.toArray()]))
    norm = Normalizer(inputCol="tfidf", outputCol="terms_unit", p=2.0)
    both = VectorAssembler(inputCols=["terms_unit", *LOOK], outputCol="features")
    lr = LogisticRegression(maxIter=max_iter, regParam=0.01, elasticNetParam=0.5)
    if balanced:
        lr.setWeightCol("weight")
    prepared = both.transform(norm.transform(scale.transform(tfed))).select("features", "label")
    if balanced:
        prepared = _balanced_weights(prepared, "label")
    prepared = _partitioned(prepared)  # iterations read vectors, not text
    drop_table(tfed)
    try:
        lr_model = lr.fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel(stages=[feat, scale, norm, both, lr_model])


def classify_quality(model: PipelineModel, df: DataFrame, text_col: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """M5: (…, label in {wiki, cc}, score = probability of that label, prediction)."""
    out = model.transform(with_look(df.withColumn("text", F.coalesce(F.col(text_col), F.lit("")))))
    prob = vector_to_array("probability")
    pred = F.col("prediction").cast("int")
    return out.select(*(keep or []), F.when(pred == 1, F.lit(QUALITY_LABELS[1]))
                      .otherwise(F.lit(QUALITY_LABELS[0])).alias("label"),
                      F.element_at(prob, pred + 1).alias("score"), pred.alias("prediction"))
