"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to lower-case words and put into one generalised suffix automaton
over word ids. Documents are streamed through it: at every word the automaton gives the
longest suffix of the text that occurs in some item, so an item window (``window``
consecutive words, or a whole shorter item) ends wherever that length reaches it, and the
state tells which items have it. Outside runs of words whose neighbouring pairs occur in
an item the matching length is one at most, so only such runs are streamed word by word;
splitting, hashing and the pair test are vectorised.

The benchmark is measured before anything is sent: its item pieces go in blocks of at most
about ``block_words`` words, an automaton (a broadcast of bounded size) and a pass per
block; results are merged per document. Documents are never shuffled with one block. With
several, ``remove_spans`` judges and cuts a document on the spans of all blocks together and
scans what was cut again over all blocks until none hits: the result of one large block.

Defined results: null texts and items have no words; an item without words has no window;
a null item_id is listed as ''; repeated items count once by id; rows repeating a doc_id
are judged one by one; empty tables give empty or clean results; an item longer than
``piece_words`` is cut into pieces that overlap by ``window - 1`` words, which keeps
every window; extra columns are ignored (``match_items``) or kept (``remove_spans``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bytewords import LETTERS_DIGITS, Words, chunks, mix64
from .common import ascii_lower, private, text_of

WINDOW = 10
BLOCK_WORDS, PIECE_WORDS = 200_000, 20_000
#: A document with a larger share of hit words goes.
MAX_COVERAGE = 0.5
_U = np.uint64
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text_of(text)), _NOT_WORD), "")


class SuffixAutomaton:
    """Generalised suffix automaton over words, with the items per window state."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.ids: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items if words]
        for _, word_ids in coded:
            last = 0
            for c in word_ids:
                last = self._extend(last, c)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        #: the state that holds a state's suffix of exactly ``window`` words, if it has one
        self.top = [-1] * len(self.link)
        for s in order:
            if self.length[s] >= window:
                self.top[s] = s if self.length[self.link[s]] < window else self.top[self.link[s]]
        self.items: dict[int, set[str]] = {}  # of window states
        self.short: dict[int, dict[int, set[str]]] = {}  # state -> length -> items shorter than a window
        for name, word_ids in coded:
            s = 0
            for i, c in enumerate(word_ids):
                s = self.next[s][c]
                if i + 1 >= window:
                    self.items.setdefault(self.top[self._holding(s, window)], set()).add(name)
            if len(word_ids) < window:
                s = self._holding(s, len(word_ids))
                self.short.setdefault(s, {}).setdefault(len(word_ids), set()).add(name)
        #: the nearest state up the suffix links, itself included, where a short item ends
        self.nearest = [-1] * len(self.link)
        for s in order:
            self.nearest[s] = s if s in self.short else self.nearest[self.link[s]]
        self.shortest = min([window] + [len(w) for _, w in coded])

    def _holding(self, s: int, length: int) -> int:
        """The state up the links from ``s`` that holds its suffix of ``length`` words."""
        while s and self.length[self.link[s]] >= length:
            s = self.link[s]
        return s

    def _new(self, length: int, link: int, out: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(out)
        return len(self.link) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of p's strings followed by c alone: q itself, or a clone cut from it."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        cur, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, c)
        return cur

    def stream(self, word_ids: list[int]) -> tuple[list[tuple[int, int]], set[str], int]:
        """(hit ranges, items with a window in the words, longest match) of one run of words."""
        hits, names, s, n, longest = [], set(), 0, 0, 0
        for i, c in enumerate(word_ids):
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if c in self.next[s]:
                s, n = self.next[s][c], n + 1
            longest = max(longest, n)
            if n >= self.window:
                hits.append((i + 1 - self.window, i + 1))
                names |= self.items[self.top[s]]
            at = self.nearest[s]
            while at > 0:
                for length, short in self.short[at].items():
                    if length <= n:
                        hits.append((i + 1 - length, i + 1))
                        names |= short
                at = self.nearest[self.link[at]]
        return hits, names, longest


class Hit(NamedTuple):
    spans: list[tuple[int, int]]
    items: list[str]
    longest: int

    def words(self) -> int:
        return sum(b - a for a, b in self.spans)


class Matcher:
    """The automaton with the sorted hashes of its words and word pairs (what is broadcast)."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.automaton = a = SuffixAutomaton(items, window)
        vocabulary = Words([w.encode() for w in a.ids], LETTERS_DIGITS).hashes()  # a word is one text
        order = np.argsort(vocabulary)
        self.hashes, self.word_ids = vocabulary[order], order
        pairs = [vocabulary[[a.ids[w] for w in words]] for _, words in items if len(words) > 1]
        self.pairs = np.unique(np.concatenate([self._pair(p) for p in pairs])) if pairs else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.pairs >> _U(44)).astype(np.int64)] = True
        single = [vocabulary[a.ids[words[0]]] for _, words in items if len(words) == 1]
        self.single = self.hashes if window == 1 else np.unique(np.array(single, dtype=np.uint64))

    @staticmethod
    def _pair(h: np.ndarray) -> np.ndarray:
        return mix64(h[:-1] * _U(0x9E3779B97F4A7C15) + h[1:])

    @staticmethod
    def _among(x: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
        if not len(sorted_values):
            return np.zeros(len(x), dtype=bool)
        return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x

    def match(self, words: Words) -> dict[int, Hit]:
        """Hits by text index; word positions count from the start of the text."""
        h = words.hashes()
        if not len(h):
            return {}
        text = words.text_of_word()
        joined = np.zeros(len(h), dtype=bool)  # word i and i + 1 are a pair of some item, in one text
        pair = self._pair(h)
        maybe = np.flatnonzero(self.seen[(pair >> _U(44)).astype(np.int64)] & (text[1:] == text[:-1]))
        joined[maybe[self._among(pair[maybe], self.pairs)]] = True
        first = np.concatenate([[True], ~joined[:-1]])  # a run starts where the word before is not joined
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(h))
        size = ends - starts
        runs = np.flatnonzero((size >= max(self.automaton.shortest, 2))
                              | ((size == 1) & self._among(h[starts], self.single)))
        found: dict[int, Hit] = {}
        for a, b in zip(starts[runs].tolist(), ends[runs].tolist(), strict=True):
            ids = self.word_ids[np.searchsorted(self.hashes, h[a:b])].tolist()
            hits, names, longest = self.automaton.stream(ids)
            if hits:
                t = int(text[a])
                base = a - int(words.first[t])
                old = found.get(t, Hit([], [], 0))
                found[t] = Hit(old.spans + merged([(base + x, base + y) for x, y in hits]),
                               sorted(names.union(old.items)), max(longest, old.longest))
        return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint spans that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                piece_words: int = PIECE_WORDS) -> Iterator[list[tuple[str, list[str]]]]:
    """Items (id, words) in blocks of about ``block_words`` words, each brought to the driver alone."""
    step = piece_words - window + 1
    pieces = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                               item_words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
              .select("item", "ws", F.explode(F.sequence(
                  F.lit(0), F.greatest(F.size("ws") - piece_words + step - 1, F.lit(0)), F.lit(step))).alias("at"))
              .select("item", F.slice("ws", F.col("at") + 1, piece_words).alias("ws")).distinct())
    total = pieces.agg(F.sum(F.size("ws"))).first()[0] or 0
    n = max(1, -(-total // block_words))
    for k in range(n):
        block = pieces.where(F.pmod(F.xxhash64("item", "ws"), F.lit(n)) == k).orderBy("item", "ws")
        yield [(r["item"], list(r["ws"])) for r in block.toLocalIterator()]


def _match_block(docs: DataFrame, matcher) -> DataFrame:
    """``docs(doc_id, text_hash, text)`` through one broadcast automaton."""
    spans_type = pa.list_(pa.struct([("from_word", pa.int32()), ("to_word", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, hits = [], {}
            for first, texts in chunks(b.column(2)):
                words = Words(texts, LETTERS_DIGITS, lower=True)
                n_words.append(np.diff(words.first))
                hits.update((first + t, hit) for t, hit in matcher.value.match(words).items())
            none = Hit([], [], 0)
            each = [hits.get(i, none) for i in range(len(b))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.concatenate(n_words) if n_words else [], type=pa.int64()),
                 pa.array([[{"from_word": x, "to_word": y} for x, y in h.spans] for h in each], type=spans_type),
                 pa.array([h.items for h in each], type=pa.list_(pa.string())),
                 pa.array([h.longest for h in each], type=pa.int32())],
                ["doc_id", "text_hash", "n_words", "spans", "items", "longest"])
    return docs.mapInArrow(work, "doc_id long, text_hash long, n_words long, "
                                 "spans array<struct<from_word:int,to_word:int>>, items array<string>, longest int")


def covered_words(spans: Column) -> Column:
    """Words in the union of the spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("at"))
    return F.aggregate(F.sort_array(spans), start, lambda a, x: F.struct(
        (a["n"] + F.greatest(x["to_word"] - F.greatest(x["from_word"], a["at"]), F.lit(0))).alias("n"),
        F.greatest(x["to_word"], a["at"]).alias("at")), lambda a: a["n"])


def match_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(doc_id, text_hash, n_words, spans, items, longest) for every row of ``docs``: hit word
    ranges, the ids (as strings, sorted) of items with windows there, the longest matching run.
    Spans are disjoint with one benchmark block; those of several blocks may overlap."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sc = docs.sparkSession.sparkContext
    parts = [_match_block(rows, sc.broadcast(Matcher(block, window)))
             for block in item_blocks(benchmark, window, block_words, piece_words)]
    if len(parts) == 1:
        return parts[0]
    everything = parts[0]
    for p in parts[1:]:
        everything = everything.unionByName(p)
    per = everything.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"), F.count(F.lit(1)).alias("_rows"))
    copies = F.sequence(F.lit(1).cast("long"), F.floor(F.col("_rows") / len(parts)))
    return per.withColumn("_copy", F.explode(copies)).drop("_rows", "_copy")  # a row per repeated row


def _without(text: bytes, words: Words, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans of its words."""
    for a, b in reversed(merged(spans)):
        text = text[:words.starts[a]] + text[words.ends[b - 1]:]
    return text


def _cut(text: bytes, matcher: Matcher, max_coverage: float) -> bytes | None:
    """The text without hit spans, scanned again until clean; None beyond ``max_coverage``."""
    first = True
    while True:
        words = Words([text], LETTERS_DIGITS, lower=True)
        hit = matcher.match(words).get(0)
        if hit is None:
            return text
        if first and hit.words() > max_coverage * len(words):
            return None
        first = False
        text = _without(text, words, hit.spans)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                 block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """``docs`` with hit spans cut from ``text``; documents hit in more than ``max_coverage``
    of their words go. There is no other limit on length: every window goes, and every whole
    item that is shorter than one, even of one word."""
    sc = docs.sparkSession.sparkContext
    matchers = [sc.broadcast(Matcher(block, window))
                for block in item_blocks(benchmark, window, block_words, piece_words)]
    if len(matchers) > 1:
        return _remove_by_blocks(docs, matchers, max_coverage)
    at, schema, matcher = docs.columns.index("text"), docs.schema, matchers[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = {first + t: _cut(texts[t], matcher.value, max_coverage) for first, texts in chunks(b.column(at))
                   for t in matcher.value.match(Words(texts, LETTERS_DIGITS, lower=True))}
            if new:
                old = b.column(at).to_pylist()
                cut = pa.array([new[i].decode() if new.get(i) is not None else x for i, x in enumerate(old)],
                               type=b.column(at).type)
                b = b.set_column(at, b.schema.field(at), cut)
                b = b.filter(pa.array([new.get(i, b"") is not None for i in range(len(b))]))
            yield b
    return docs.mapInArrow(work, schema)


def _cut_once(rows: DataFrame, limit: float) -> DataFrame:
    """``rows(row, text, spans)`` without their spans; null text where these exceed ``limit`` of the words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1), b.column(2), strict=True):
                raw = text.as_py().encode()
                words, hit = Words([raw], LETTERS_DIGITS, lower=True), merged([(x["from_word"], x["to_word"]) for x in spans.as_py()])
                gone = sum(y - x for x, y in hit) > limit * len(words)
                out.append(None if gone else _without(raw, words, hit).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=pa.string())], ["row", "text"])
    return rows.mapInArrow(work, "row long, text string")


def _remove_by_blocks(docs: DataFrame, matchers: list, max_coverage: float) -> DataFrame:
    """``remove_spans`` over several blocks: a pass per block, one automaton in a worker at a time."""
    row, new = private(docs.columns, "_row"), private(docs.columns, "_new")
    cut = private(docs.columns, "_cut")
    every = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "spans-docs")
    left, limit = every.select(F.col(row).alias("row"), "text"), max_coverage
    done = None
    while True:
        texts = left.select(F.col("row").alias("doc_id"), F.lit(0).cast("long").alias("text_hash"), "text")
        hits = None
        for m in matchers:
            hit = materialize(_match_block(texts, m).where(F.size("spans") > 0)
                              .select(F.col("doc_id").alias("row"), "spans"), "spans-hits")
            hits = hit if hits is None else hits.unionByName(hit)
        spans = hits.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        shorter = materialize(_cut_once(left.join(spans, "row").select("row", "text", "spans"), limit), "spans-cut")
        if done is not None:  # what was cut before and is clean now
            clean = materialize(left.join(hits.select("row").distinct(), "row", "left_anti"), "spans-clean")
            done = done.unionByName(clean)
        else:
            done = shorter.where(F.col("text").isNull())
        left, limit = shorter.where(F.col("text").isNotNull()), 1.0  # coverage is judged on the whole text alone
        if left.isEmpty():
            break
    done = done.select(F.col("row").alias(row), F.col("text").alias(new), F.lit(True).alias(cut))
    text = F.when(F.col(cut), F.col(new)).otherwise(F.col("text"))
    return (every.join(done, row, "left").where(F.col(cut).isNull() | F.col(new).isNotNull())
            .withColumn("text", text).select(*docs.columns))
