"""Lossless splitting of WARC / WET archives into records.

The text source cuts an archive at ``WARC/1.``; a piece then starts with the
version digit. A piece is a *record head* when a version line, header lines
with ``WARC-Type`` and ``Content-Length`` and a blank line come first. Pieces
are walked in file order, one state machine per file, inside the scan's own
task (no shuffle, one read):

* a head with all its payload is a record, cut to ``Content-Length`` bytes;
* a short head is held with the pieces after it. When the bytes reach its
  length exactly (up to the blank lines that end a record), the pieces were
  cut out of its payload and are joined again -- also when some of them look
  like heads. When they overshoot, or the file ends, the head is *truncated*:
  it is rejected and the held pieces are walked again on their own, so a
  damaged record never takes its followers with it;
* a piece without a head that belongs to no short record is rejected.

Every byte of the archive ends up in a record or in a rejected row. Splittable
(uncompressed) files are cut by the scan at arbitrary places: pieces at the
edges of a split go through the same machine once more, grouped by file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

SEPARATOR = b"WARC/1."
_BLANK = b"\r\n\r\n"
_TYPE = re.compile(rb"(?im)^WARC-Type:[ \t]*([^\r\n]*)")
_URI = re.compile(rb"(?im)^WARC-Target-URI:[ \t]*([^\r\n]*)")
_LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*(\d+)[ \t]*\r?$")

SCHEMA = ("file string, split long, seq long, warc_type string, uri string, "
          "content_length long, block binary, reason string")
_FIELDS = [("file", pa.string()), ("split", pa.int64()), ("seq", pa.int64()), ("warc_type", pa.string()),
           ("uri", pa.string()), ("content_length", pa.int64()), ("block", pa.binary()), ("reason", pa.string())]


class _Piece:
    __slots__ = ("raw", "seq", "head", "length", "warc_type", "uri")

    def __init__(self, raw: bytes, seq: tuple[int, int]):
        self.raw, self.seq, self.head = raw, seq, 0
        end = raw.find(_BLANK)
        if raw[:3] in (b"0\r\n", b"1\r\n") and end > 0:
            lines = raw[:end]
            kind, length, uri = _TYPE.search(lines), _LENGTH.search(lines), _URI.search(lines)
            if kind and length:
                self.head, self.length = end + len(_BLANK), int(length[1])
                self.warc_type = kind[1].decode("utf-8", "replace").strip()
                self.uri = uri[1].decode("utf-8", "replace").strip() or None if uri else None


class _Walker:
    """The pieces of one file in order; ``rows`` collects what is decided."""

    def __init__(self, file: str, rows: list[tuple], edges: bool):
        self.file, self.rows, self.edges = file, rows, edges
        self.held: list[_Piece] = []
        self.size = 0
        self.started = not edges  # a head was seen in this split

    def _record(self, head: _Piece, raw: bytes) -> None:
        block = raw[head.head:head.head + head.length]
        self.rows.append((self.file, *head.seq, head.warc_type, head.uri, head.length, block, None))

    def _reject(self, p: _Piece, reason: str) -> None:
        kind, uri, n = (p.warc_type, p.uri, p.length) if p.head else (None, None, None)
        self.rows.append((self.file, *p.seq, kind, uri, n, p.raw, reason))

    def push(self, p: _Piece) -> None:
        if self.held:
            self.held.append(p)
            self.size += len(SEPARATOR) + len(p.raw)
            need = self.held[0].head + self.held[0].length
            if self.size < need:
                return
            raw = SEPARATOR.join(x.raw for x in self.held)
            if not raw[need:].strip(b"\r\n") and len(raw) - need <= len(_BLANK):
                self._record(self.held[0], raw)
                self.held = []
            else:
                self._give_up()
        elif not p.head:
            self._reject(p, "edge" if not self.started else "no header")
        else:
            self.started = True
            if len(p.raw) >= p.head + p.length:
                self._record(p, p.raw)
            else:
                self.held, self.size = [p], len(p.raw)

    def _give_up(self) -> None:
        """The held head is truncated; what followed it is walked again."""
        first, *rest = self.held
        self.held = []
        self._reject(first, "truncated")
        for p in rest:
            self.push(p)

    def finish(self) -> None:
        if self.edges:  # the next split may hold the rest
            for p in self.held:
                self._reject(p, "edge")
            self.held = []
        while self.held:
            self._give_up()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(columns, _FIELDS, strict=True)],
                                      [n for n, _ in _FIELDS])


def split_records(edges: bool):
    """mapInArrow function over (file, split, value binary) in scan order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker, at, n, rows = None, None, 0, []
        for b in batches:
            for file, split, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (file, split) != at:
                    if walker:
                        walker.finish()
                    at, n, walker = (file, split), 0, _Walker(file, rows, edges)
                    if split == 0:
                        walker.started = True
                n += 1
                if raw:
                    walker.push(_Piece(raw, (split, n)))
            yield _batch(rows)
            rows.clear()
        if walker:
            walker.finish()
            yield _batch(rows)
    return work


def join_edges(pieces: pa.Table) -> pa.Table:
    """Edge pieces of one file (same schema) through the machine again."""
    rows: list[tuple] = []
    ordered = sorted(pieces.to_pylist(), key=lambda r: (r["split"], r["seq"]))
    walker = _Walker(ordered[0]["file"], rows, edges=False)
    for r in ordered:
        walker.push(_Piece(r["block"], (r["split"], r["seq"])))
    walker.finish()
    return pa.Table.from_batches([_batch(rows)])
