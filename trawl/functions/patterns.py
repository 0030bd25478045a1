"""Fixed values shared by the Spark expressions and the SQL oracles.

Everything here must stay equal to the behaviour being matched (mask tokens,
PII patterns, thresholds, URL pattern). Patterns are written once and used in
Java regex (Spark) and, where RE2 accepts them, in DuckDB as well.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES -- mask tokens, PII patterns, URL and reference-tag patterns,
# Gopher limits, language threshold, sampling seeds.
# ---------------------------------------------------------------------------
EMAIL_MASK = "|||EMAIL_ADDRESS|||"
PHONE_MASK = "|||PHONE_NUMBER|||"
IP_MASK = "|||IP_ADDRESS|||"

EMAIL_RE = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_RE = r"(?<!\d)(?:\+?1[-.\s]?)?(?:\(\d{3}\)|\d{3})[-.\s]?\d{3}[-.\s]?\d{4}(?!\d)"
IP_OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IP_RE = r"\b(?:" + IP_OCTET + r"\.){3}" + IP_OCTET + r"\b"

URL_RE = (r"\b(?:https?|telnet|gopher|file|wais|ftp):[\w/#~:.?+=&%@!\-.:?\\-]+?"
          r"(?=[.:?\-]*(?:[^\w/#~:.?+=&%@!\-.:?\-]|$))")
REF_TAG_RE = r"&lt;ref&gt(.*)&lt;/ref&gt;"

GOPHER_MIN_WORDS = 50
GOPHER_MAX_WORDS = 100_000
GOPHER_MIN_MEAN_LEN = 3
GOPHER_MAX_MEAN_LEN = 10
GOPHER_MAX_ELLIPSIS_SHARE = (3, 10)     # 0.3 as an exact fraction
GOPHER_MIN_ALPHA_SHARE = (4, 5)         # 0.8 as an exact fraction

ENGLISH_MIN_SCORE = 0.7
SHARD_SHUFFLE_SEED = 336
SPLIT_SEED = 42
CHUNK_GROUP_SIZE = 4
PREVIEW_CHARS = 350

# ---------------------------------------------------------------------------
# Character classes. Python's str.isspace() / splitlines() sets, spelled out
# so Java regex and RE2 see the same characters.
# ---------------------------------------------------------------------------
WS_CHARS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = "[" + WS_CHARS + "]"
# whitespace that is not a line boundary (what strip() removes inside one line)
WS_INLINE = "[" + r"\t \x1F\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}" + "]"
LINE_BREAK = r"(?:\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}])"
# whitespace outside ASCII (and \x1C-\x1F): mapped to ' ' before tokenising,
# so the tokenizer rules only need the six ASCII whitespace characters
RARE_WS = "".join(chr(c) for c in [0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680,
                                   *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                                   0x205F, 0x3000])
TWS_CHARS = r"\t\n\x0B\f\r "
TWS = "[" + TWS_CHARS + "]"

# ---------------------------------------------------------------------------
# Word tokenizer: a Treebank-style replacement chain without lookaround, so
# the same chain runs in Spark and in DuckDB. Placeholders {0}..{3} are group
# references ($n in Java, \n in RE2). After the chain, whitespace runs become
# one space and the string is split on it.
# ---------------------------------------------------------------------------
TOKEN_RULES = [
    ("(^|[" + TWS_CHARS + r"(\[{<])([\"“])", "{1} `` "),   # opening quotes
    (r"([:,])([^0-9])", " {1} {2}"),                               # : and , not in numbers
    (r"([:,])\z", " {1}"),
    (r"\.{2,}", " ... "),                                          # ellipsis
    ("[;!?*#$%&\"”“@<>(){}\\[\\]]|--", " {0} "),      # single punctuation, double dash
    (r"([^.])\.(" + TWS + r"|\z)", "{1} .{2}"),                    # full stop before space/end
    (r"([^'" + TWS_CHARS + r"])('[sSmMdD]|'ll|'LL|'re|'RE|'ve|'VE|n't|N'T|')(" + TWS + r"|\z)",
     "{1} {2}{3}"),                                                # clitics and closing quote
]


def java_rep(template: str) -> str:
    """Replacement template -> Java replacement string ($n, literal $ escaped)."""
    out = template.replace("\\", "\\\\").replace("$", "\\$")
    for i in range(10):
        out = out.replace("{%d}" % i, "$%d" % i)
    return out


def re2_rep(template: str) -> str:
    """Replacement template -> RE2 rewrite string (\\n)."""
    out = template.replace("\\", "\\\\")
    for i in range(10):
        out = out.replace("{%d}" % i, "\\%d" % i)
    return out
