"""HTML -> text, two ways.

* ``html_to_text`` (P2): an Arrow UDF around a small ``html.parser`` walker
  with the reference extractor's defaults -- head/script/style dropped,
  inline whitespace collapsed, blocks separated by a blank line, list items
  as ``"  • item"``, link text kept without the target, entities decoded.
* ``strip_tags`` (P2b): the same idea as a chain of built-in regex
  replacements (no Python), which also runs in DuckDB for the oracle.

``decode_bytes`` (P1) turns raw payload bytes into a string.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES -- element classes of the extractor and the bullet text.
# ---------------------------------------------------------------------------
SKIP_TAGS = {"head", "script", "style", "noscript", "template", "title"}
BLOCK_TAGS = {"address", "article", "aside", "blockquote", "body", "dd", "details", "div",
              "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
              "h3", "h4", "h5", "h6", "header", "hr", "html", "main", "nav", "ol", "p", "pre",
              "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
BULLET = "  • "
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

_WS = re.compile(r"\s+")


class _Walker(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.cur: list[str] = []
        self.skip = 0
        self.want = 0
        self.prefix = ""

    def _flush(self):
        text = _WS.sub(" ", "".join(self.cur)).strip()
        self.cur = []
        if text:
            if self.out:
                self.out.append("\n" * max(self.want, 1))
            self.out.append(self.prefix + text)
            self.want = 0
        self.prefix = ""

    def _brk(self, n):
        self._flush()
        self.want = max(self.want, n)

    def handle_starttag(self, tag, attrs):
        if tag in SKIP_TAGS:
            self.skip += 1
        elif self.skip:
            return
        elif tag == "li":
            self._brk(1)
            self.prefix = BULLET
        elif tag == "br":
            self._brk(1)
        elif tag in BLOCK_TAGS:
            self._brk(2)

    def handle_startendtag(self, tag, attrs):
        if not self.skip and tag == "br":
            self._brk(1)

    def handle_endtag(self, tag):
        if tag in SKIP_TAGS:
            self.skip = max(self.skip - 1, 0)
        elif self.skip:
            return
        elif tag == "li":
            self._brk(1)
        elif tag in BLOCK_TAGS:
            self._brk(2)

    def handle_data(self, data):
        if not self.skip:
            self.cur.append(data)

    def text(self) -> str:
        self._flush()
        return "".join(self.out)


def html_to_text_py(html: str | None) -> str:
    if not html:
        return ""
    w = _Walker()
    w.feed(html)
    w.close()
    return w.text()


@F.pandas_udf(T.StringType())
def _html_to_text_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda h: None if h is None else html_to_text_py(h))


def html_to_text(col) -> Column:
    """Extracted plain text (Arrow-batched UDF, one parser per row)."""
    c = F.col(col) if isinstance(col, str) else col
    return _html_to_text_udf(c)


# ---------------------------------------------------------------------------
# Built-in regex chain. (pattern, replacement) pairs, replacements use
# {n} group placeholders like patterns.TOKEN_RULES.
# ---------------------------------------------------------------------------
_BLOCK_ALT = "|".join(sorted(BLOCK_TAGS - {"html", "body"}))
STRIP_RULES = [
    (r"(?is)<head\b.*?</head\s*>", " "),
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?i)<li\b[^>]*>", "\n\u0001"),
    (r"(?i)<br\s*/?>|</li\s*>", "\n"),
    (r"(?i)</?(?:" + _BLOCK_ALT + r")\b[^>]*>", "\n\n"),
    (r"<[^>]*>", ""),
]
TIDY_RULES = [
    (r"[ \t\r\f\x0B]+", " "),
    (r"(?m)^ +| +$", ""),
    (r"\n{3,}", "\n\n"),
    (r"^\n+|\n+$", ""),
    ("\u0001", BULLET),
]


def strip_tags(col) -> Column:
    """Tags out, entities decoded, blocks as blank-line separated text."""
    from .patterns import java_rep

    out = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    for pat, rep in STRIP_RULES:
        out = F.regexp_replace(out, pat, java_rep(rep))
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    for pat, rep in TIDY_RULES:
        out = F.regexp_replace(out, pat, java_rep(rep))
    return out


# ---------------------------------------------------------------------------
# Bytes -> string
# ---------------------------------------------------------------------------
def _decode_py(b: bytes | None, charset: str | None) -> str | None:
    if b is None:
        return None
    if not b:
        return ""
    try:
        return b.decode("utf-8")
    except UnicodeDecodeError:
        pass
    try:
        return b.decode(charset or "utf-8", errors="replace")
    except LookupError:
        return b.decode("utf-8", errors="replace")


@F.pandas_udf(T.StringType())
def _decode_udf(b: pd.Series, cs: pd.Series) -> pd.Series:
    return pd.Series([_decode_py(x, c) for x, c in zip(b, cs)])


def declared_charset(http_content_type: Column, payload: Column) -> Column:
    """charset= from the Content-Type header, else from a <meta> before the body."""
    head = F.regexp_extract(payload.cast("string"), r"(?is)^(.*?)(?:</head|<body|\z)", 1)
    from_header = F.regexp_extract(http_content_type, r"(?i)charset=[\"']?([A-Za-z0-9_.:-]+)", 1)
    from_meta = F.regexp_extract(head, r"(?i)<meta[^>]+charset=[\"']?([A-Za-z0-9_.:-]+)", 1)
    return F.lower(F.coalesce(F.nullif(from_header, F.lit("")), F.nullif(from_meta, F.lit(""))))


def decode_bytes(payload, charset: Column | None = None) -> Column:
    """Valid UTF-8 stays in the JVM; only invalid payloads go to the
    Arrow helper, which decodes with the declared charset and U+FFFD
    replacement (the others pass it a null)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    s = p.cast("string")
    ok = F.is_valid_utf8(s)
    cs = charset if charset is not None else F.lit(None).cast("string")
    slow = _decode_udf(F.when(~ok, p), F.when(~ok, cs))
    return F.when(p.isNull(), F.lit(None).cast("string")).when(ok, s).otherwise(slow)
