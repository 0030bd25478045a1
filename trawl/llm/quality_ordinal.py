"""Quality classifier: ordinal cumulative-link regression on hashed text.

Ratings are ordered grades 0 .. K - 1. One weight vector w over hashed text features is
shared by all grades, and ordered thresholds t_1 < ... < t_(K-1) cut the score:
P(grade >= k) = sigmoid(w . x - t_k). A document gets its expected grade and the tail
probability P(grade >= ``good_grade``), on which selection is made.

Features of a whole text: presence of every lower-cased word (hashed, so a text of any
length is a set of slots) and, for the look of the text, the share of white-space tokens
per shape (case pattern, symbols, digits, closing marks), hashed into their own slots. Words
in fewer than ``min_docs`` fitted documents get no weight.

The fit uses a bounded sample of labelled rows (``max_rows``, by smallest hash of the id),
which the driver holds as arrays of slots; everything else is a map over Arrow batches
with a broadcast of fixed size: no shuffle of texts.

Defined results: null and empty texts have no features and get the thresholds' own
probabilities; rows repeating an id are scored row by row, and labels repeating an id count
each; null grades are not fitted; without labelled rows, or with one grade only, all texts get the same
probabilities (``fit_ordinal``); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import LETTERS_DIGITS, NOT_SPACE, Words, chunks

SLOTS_LOG2, SHAPES = 20, 128
MAX_ROWS, MIN_DOCS, EPOCHS, RATE, RIDGE = 12_000, 10, 120, 0.06, 2e-4
SHAPE_SCALE = 10.0


def _class_counts(w: Words, members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    total = np.concatenate([[0], np.cumsum(table[w.buf])])
    return total[w.ends] - total[w.starts]


def token_shapes(w: Words) -> np.ndarray:
    """A shape below SHAPES per white-space token."""
    upper = _class_counts(w, bytes(range(65, 91)))
    lower = _class_counts(w, bytes(range(97, 123)))
    digits = _class_counts(w, b"0123456789")
    symbols = _class_counts(w, b"#*$%&|<>@=+~^_\\/{}[]")
    marks = _class_counts(w, b"!?.,;:")
    case = np.where(upper == 0, 0, np.where(lower == 0, np.where(upper > 1, 3, 1), np.where(upper == 1, 1, 2)))
    return (case + 4 * np.minimum(symbols, 3) + 16 * (digits > 0) + 32 * np.minimum(marks, 3)).astype(np.int64)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slots, slots per text, shape shares [texts, SHAPES]): distinct word slots of each text."""
    w = Words(texts, LETTERS_DIGITS, lower=True)
    key = np.unique((w.text_of_word().astype(np.uint64) << np.uint64(SLOTS_LOG2))
                    | (w.hashes() >> np.uint64(64 - SLOTS_LOG2)))
    per = np.bincount((key >> np.uint64(SLOTS_LOG2)).astype(np.int64), minlength=len(texts))
    slots = (key & np.uint64((1 << SLOTS_LOG2) - 1)).astype(np.int32)
    t = Words(texts, NOT_SPACE)
    shape = np.bincount(t.text_of_word() * SHAPES + token_shapes(t), minlength=len(texts) * SHAPES)
    shape = shape.reshape(len(texts), SHAPES).astype(np.float32)
    return slots, per, shape / np.maximum(shape.sum(axis=1, keepdims=True), 1) * SHAPE_SCALE


class OrdinalModel(NamedTuple):
    words: np.ndarray  # weight per word slot
    shapes: np.ndarray  # weight per shape
    thresholds: np.ndarray  # increasing

    def scores(self, slots: np.ndarray, per: np.ndarray, shape: np.ndarray) -> np.ndarray:
        at = np.concatenate([[0], np.cumsum(per)])
        total = np.concatenate([[0.0], np.cumsum(self.words[slots], dtype=np.float64)])
        return total[at[1:]] - total[at[:-1]] + shape @ self.shapes

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K - 1, one column each."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)))


def loss_and_gradient(p: np.ndarray, width: int, col: np.ndarray, doc: np.ndarray, shape: np.ndarray,
                      grades: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with the ridge, and its gradient.

    ``p``: ``width`` word weights, shape weights, the first threshold, logarithms of the gaps to the next ones;
    ``col`` and ``doc``: word weight and row of every feature.
    """
    n, at = len(grades), width + shape.shape[1]
    rows, top = np.arange(n), len(p) - at
    w, s, gaps = p[:width], p[width:at], np.exp(p[at + 1:])
    theta = p[at] + np.concatenate([[0.0], np.cumsum(gaps)])
    score = np.bincount(doc, weights=w[col], minlength=n) + shape @ s
    tail = 1 / (1 + np.exp(-np.clip(score[:, None] - theta[None, :], -60, 60)))
    full = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
    prob = np.maximum(full[rows, grades] - full[rows, grades + 1], 1e-9)
    slope = np.concatenate([np.zeros((n, 1)), tail * (1 - tail), np.zeros((n, 1))], axis=1)
    lo, hi = slope[rows, grades] / prob, slope[rows, grades + 1] / prob
    d_score = (hi - lo) / n
    d_theta = np.zeros((n, top + 2))
    d_theta[rows, grades] += lo / n
    d_theta[rows, grades + 1] -= hi / n
    later = np.cumsum(d_theta.sum(axis=0)[1:-1][::-1])[::-1]
    g = np.concatenate([np.bincount(col, weights=d_score[doc], minlength=width) + ridge * w,
                        shape.T @ d_score + ridge * s, [later[0]], later[1:] * gaps])
    return float(-np.log(prob).mean() + ridge / 2 * ((w ** 2).sum() + (s ** 2).sum())), g


def fit_ordinal(slots: np.ndarray, per: np.ndarray, shape: np.ndarray, grades: np.ndarray,
                min_docs: int = MIN_DOCS, epochs: int = EPOCHS, rate: float = RATE,
                ridge: float = RIDGE, n_grades: int = 2) -> OrdinalModel:
    """Maximum likelihood with a ridge on the weights, by Adam over the whole sample.

    There are at least ``n_grades`` grades, seen or not. Without labelled rows, or with rows of one grade only,
    nothing tells texts apart: all get the same probabilities, the grades' shares (a half each without rows).
    """
    n = len(grades)
    top = max(int(grades.max()) if n else 0, n_grades - 1)
    share = np.array([(grades >= k).mean() if n else 0.5 for k in range(1, top + 1)]).clip(1e-4, 1 - 1e-4)
    # thresholds as a first value and log gaps: they stay ordered
    t0 = -np.log(share / (1 - share))
    if n == 0 or grades.min() == grades.max():
        return OrdinalModel(np.zeros(1 << SLOTS_LOG2, dtype=np.float32), np.zeros(SHAPES, dtype=np.float32), t0)
    df = np.bincount(slots, minlength=1 << SLOTS_LOG2)
    used = df[slots] >= min_docs
    doc = np.repeat(np.arange(n), per)[used]
    slots, number = slots[used], np.cumsum(df >= min_docs) - 1
    col, width = number[slots], int(number[-1]) + 1
    p = np.concatenate([np.zeros(width + SHAPES), [t0[0]], np.log(np.maximum(np.diff(t0), 0.05))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, epochs + 1):
        _, g = loss_and_gradient(p, width, col, doc, shape, grades, ridge)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(1 << SLOTS_LOG2, dtype=np.float32)
    weights[df >= min_docs] = p[:width]
    theta = p[width + SHAPES] + np.concatenate([[0.0], np.cumsum(np.exp(p[width + SHAPES + 1:]))])
    return OrdinalModel(weights, p[width:width + SHAPES].astype(np.float32), theta)


def labelled_features(docs: DataFrame, grades: DataFrame, max_rows: int = MAX_ROWS):
    """Slots, slots per text, shape shares and grades of the bounded sample."""
    sample = (grades.where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
              .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("grade", "text")  # max_rows ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grade = b.column(0).to_numpy(zero_copy_only=False)
            for first, texts in chunks(b.column(1)):
                slots, per, shape = features(texts)
                cuts = np.cumsum(per)[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grade[first:first + len(texts)], type=pa.int32()),
                     pa.array([x.tobytes() for x in np.split(slots, cuts)], type=pa.binary()),
                     pa.array([x.tobytes() for x in shape], type=pa.binary())], ["grade", "slots", "shape"])
    found = rows.select(F.col("grade").cast("int"), "text").mapInArrow(work, "grade int, slots binary, shape binary")
    got = found.toPandas().sort_values(["grade", "slots", "shape"])  # one order, whatever the partitions
    each = [np.frombuffer(x, dtype=np.int32) for x in got["slots"]]
    shape = np.array([np.frombuffer(x, dtype=np.float32) for x in got["shape"]]).reshape(len(got), SHAPES)
    return (np.concatenate(each) if each else np.zeros(0, np.int32), np.array([len(x) for x in each], dtype=np.int64),
            shape, got["grade"].to_numpy(dtype=np.int64))


def score_quality(docs: DataFrame, model: OrdinalModel, good_grade: int) -> DataFrame:
    """(doc_id, expected_grade, tail_probability) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tails = [sent.value.tails(sent.value.scores(*features(texts))) for _, texts in chunks(b.column(1))]
            t = np.concatenate(tails) if tails else np.zeros((0, len(sent.value.thresholds)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(t.sum(axis=1)), pa.array(t[:, good_grade - 1])],
                                             ["doc_id", "expected_grade", "tail_probability"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, expected_grade double, tail_probability double")


def graded_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 low quality, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
                         .when((F.col("toxic") == 0) & (F.col("quality") == 1), 2).alias("grade"))
