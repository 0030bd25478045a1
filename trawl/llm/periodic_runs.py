"""Periodic run detection with the dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least ``MIN_LENGTH`` words and ``MIN_EXPONENT``
periods long, that no neighbouring word extends with period q. The dictionary names, for every power-of-two
length, the factors (stretches of that length) of a text: equal factors of a text get equal names, level by level from
pairs of names half as long. Factors that occur once in their text get no name, so a level holds
only what still repeats.

At every level the successor of an occurrence is the next one of the same factor. Successors within
twice the factor's length that come again at the same distance, so three occurrences in arithmetic progression, propose
that distance as a period. A run of period q has such a progression at the smallest length that is at least q: a
factor as long as the period returns inside the run after exactly q words, and that length, below 2q, fits three times.
A proposal is extended to both sides by comparing names from the longest factor down; the stretches found
are deduplicated (one stretch, smallest period).

Spark deals the texts to tasks; within a task texts are taken ``bytewords.CHUNK_BYTES`` at a time, a text always whole,
and all proposals of a chunk are extended together in numpy. Names are made per text, so nothing reaches over a
text's edge. Nothing is shuffled.

Defined results: null, empty and blank texts have no words and no runs; repeated rows and null ids are taken row by
row; several runs may share words, and all of them are returned, by start, then period; an empty
table gives an empty result; other columns play no part. Words are compared by 64-bit hashes within a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import NOT_SPACE, Words, chunks, mix64

MIN_LENGTH, MIN_EXPONENT = 6, 4
RUNS = "array<struct<start:long,length:long,period:long>>"
_NONE = -1


class BasicFactors:
    """Names of the factors of every power-of-two length, and where each next occurs."""

    def __init__(self, hashes: np.ndarray, text: np.ndarray, longest: int):
        n = len(hashes)
        keys = mix64(hashes ^ mix64(text.astype(np.uint64) + np.uint64(1)))
        self.names: list[np.ndarray] = []
        self.successor: list[np.ndarray] = []  # distance to the next occurrence; 0: none
        at, size = np.arange(n), 1
        while len(at):
            order = at[np.argsort(keys, kind="stable")]  # by factor, then by place
            keys = np.sort(keys, kind="stable")
            same = np.zeros(len(keys) + 1, dtype=bool)
            same[1:-1] = keys[1:] == keys[:-1]
            again = same[:-1] | same[1:]
            if not again.any():
                break
            name, successor = np.full(n, _NONE, dtype=np.int32), np.zeros(n, dtype=np.int32)
            name[order[again]] = (np.cumsum(~same[:-1]) - 1)[again]
            first = np.flatnonzero(same[1:])
            successor[order[first]] = order[first + 1] - order[first]
            self.names.append(name)
            self.successor.append(successor)
            at = np.sort(order[again])
            at = at[at + size < n]
            at = at[name[at + size] != _NONE]
            keys = name[at].astype(np.int64) * n + name[at + size]
            size *= 2
            if size > longest // 2:  # a run of that period would not fit
                break

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, period): the first of every series of neighbouring progressions with one distance."""
        places, periods = [], []
        for level, d in enumerate(self.successor):
            i = np.flatnonzero((d > 0) & (d <= 2 << level))
            i = i[d[i + d[i]] == d[i]]
            new = np.ones(len(i), dtype=bool)
            new[1:] = (np.diff(i) > 1) | (np.diff(d[i]) != 0)
            places.append(i[new])
            periods.append(d[i[new]].astype(np.int64))
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(periods)

    def common(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """How many words from i and from j on (or before them) are equal."""
        n, out = len(self.names[0]), np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            size, name, on = 1 << level, self.names[level], np.arange(len(i))
            while len(on):
                if back:
                    a, b = i[on] - out[on] - size, j[on] - out[on] - size
                    fits = a >= 0
                else:
                    a, b = i[on] + out[on], j[on] + out[on]
                    fits = b + size <= n
                on, a, b = on[fits], a[fits], b[fits]
                equal = (name[a] != _NONE) & (name[a] == name[b])
                on = on[equal]
                out[on] += size
        return out


def find_runs(hashes: np.ndarray, text: np.ndarray, longest: int, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; places count over all texts."""
    factors = BasicFactors(hashes, text, longest)
    i, q = factors.proposals()
    if not len(i):
        return i, i, q
    before = factors.common(i, i + q, back=True)
    start, length = i - before, before + factors.common(i, i + q, back=False) + q
    ok = length >= np.maximum(min_length, min_exponent * q)
    start, length, q = start[ok], length[ok], q[ok]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(q), dtype=bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)  # one stretch: the smallest period
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def repeats(start: np.ndarray, length: np.ndarray, period: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(id, n_words, runs, collapsed): the runs of every text, and its words less what runs repeat, joined by a space."""
    if min_exponent < 4:
        raise ValueError("three progressive occurrences of a factor below 2q words need four periods")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in chunks(b.column(1)):
                w = Words(texts, NOT_SPACE)
                text = w.text_of_word()
                sizes = np.diff(w.first)
                start, length, period = find_runs(w.hashes(), text, int(sizes.max(initial=0)), min_length, min_exponent)
                gone = repeats(start, length, period, len(w))
                of = text[start] if len(start) else start
                has = np.zeros(len(texts), dtype=bool)
                has[of] = True
                kept = []
                for t, (raw, any_run) in enumerate(zip(texts, has.tolist(), strict=True)):
                    words = raw.split()  # bytes.split() knows exactly the six ASCII blanks
                    if any_run:
                        out = gone[w.first[t]:w.first[t + 1]].tolist()
                        words = [x for x, g in zip(words, out, strict=True) if not g]
                    kept.append(b" ".join(words))
                fields = [pa.array(x.astype(np.int64)) for x in (start - w.first[of], length, period)]
                runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)),
                                                pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.array(sizes.astype(np.int64)), runs,
                     pa.array(kept, type=pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])
    few = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = few.schema["id"].dataType.simpleString()
    return few.mapInArrow(find, f"id {id_type}, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as fractions; of equal ones the first. No runs: null."""
    def better(a: Column, b: Column) -> Column:
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    return F.reduce(runs, F.lit(None).cast(RUNS[6:-1]), better)


def runs_digest(runs: Column) -> Column:
    """Lowercase hex SHA-256 of ``start,length,period`` and a line feed for every run."""
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                 F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
