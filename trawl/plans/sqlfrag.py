"""SQL fragments for the DuckDB oracles, built from the same fixed patterns.

DuckDB runs RE2: no lookaround, ``\\n`` group references, ``'g'`` for global
replacement. Each fragment states the reference semantics independently of
the Spark expression where possible (arrays and lambdas instead of counts).
"""

from __future__ import annotations

from ..functions.patterns import (LINE_BREAK, RARE_WS, TOKEN_RULES, TWS, WS, WS_CHARS,
                                  WS_INLINE, re2_rep)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def token_string(expr: str) -> str:
    out = f"translate(coalesce({expr}, ''), {lit(RARE_WS)}, {lit(' ' * len(RARE_WS))})"
    for pat, rep in TOKEN_RULES:
        out = f"regexp_replace({out}, {lit(pat)}, {lit(re2_rep(rep))}, 'g')"
    out = f"regexp_replace({out}, {lit(TWS + '+')}, ' ', 'g')"
    return f"regexp_replace({out}, '^ | $', '', 'g')"


def tokens(expr: str) -> str:
    """list of tokens from a token string."""
    return f"list_filter(string_split({expr}, ' '), lambda x: x <> '')"


def lines(expr: str) -> str:
    """``text.strip().splitlines()`` as a list."""
    s = strip(f"coalesce({expr}, '')")
    return (f"(CASE WHEN {s} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({s}, {lit(LINE_BREAK)}) END)")


def ellipsis_line(x: str) -> str:
    return f"regexp_matches({x}, {lit(chr(92) + '.' + chr(92) + '.' + chr(92) + '.' + WS_INLINE + '*$')})"


def normalize(expr: str) -> str:
    out = f"lower(strip_accents(coalesce({expr}, '')))"
    out = f"regexp_replace({out}, {lit('[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_' + WS_CHARS + ']')}, '', 'g')"
    out = f"regexp_replace({out}, {lit(WS + '+')}, ' ', 'g')"
    return f"regexp_replace({out}, '^ | $', '', 'g')"


def md5_u32le(expr: str) -> str:
    """uint32 little-endian of the first four md5 bytes, as BIGINT."""
    h = f"md5({expr})"
    return (f"CAST(('0x' || substr({h},7,2) || substr({h},5,2) || substr({h},3,2) "
            f"|| substr({h},1,2))::UBIGINT AS BIGINT)")


# ------------------------------------------------------------------ PII (RE2)
def _phone_guarded() -> str:
    from ..functions.patterns import PHONE_RE

    core = PHONE_RE.replace(r"(?<!\d)", "").replace(r"(?!\d)", "")
    return "(^|[^0-9])(" + core + ")([^0-9]|$)"


def mask(expr: str, kind: str) -> tuple[str, str]:
    """(masked, count) in DuckDB. Phones: lookaround guards put back as groups."""
    from ..functions.patterns import EMAIL_MASK, EMAIL_RE, IP_MASK, IP_RE, PHONE_MASK

    if kind == "email":
        pat, rep = EMAIL_RE, EMAIL_MASK
    elif kind == "ip":
        pat, rep = IP_RE, IP_MASK
    else:
        pat, rep = _phone_guarded(), "\\1" + PHONE_MASK + "\\3"
    return (f"regexp_replace({expr}, {lit(pat)}, {lit(rep)}, 'g')",
            f"CAST(len(regexp_extract_all({expr}, {lit(pat)})) AS BIGINT)")


# ------------------------------------------------------------------ HTML (RE2)
def strip_tags(expr: str) -> str:
    from ..functions.html import ENTITIES, STRIP_RULES, TIDY_RULES
    from ..functions.patterns import re2_rep

    out = f"coalesce({expr}, '')"
    for pat, rep in STRIP_RULES:
        out = f"regexp_replace({out}, {lit(pat)}, {lit(re2_rep(rep))}, 'g')"
    for ent, ch in ENTITIES:
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    for pat, rep in TIDY_RULES:
        out = f"regexp_replace({out}, {lit(pat)}, {lit(re2_rep(rep))}, 'g')"
    return out


def reference_urls(line: str) -> str:
    """List of URLs in a line's reference span. The lazy body + lookahead of
    the URL pattern equals: maximal run of URL characters with trailing
    '.:?-' trimmed (at least one character kept)."""
    from ..functions.patterns import REF_TAG_RE

    span = f"regexp_extract({line}, {lit(REF_TAG_RE)}, 0)"
    raw = (f"regexp_extract_all({span}, "
           + lit(r"\b(?:https?|telnet|gopher|file|wais|ftp):[\p{L}\p{N}_/#~:.?+=&%@!\\-]+") + ")")
    fix = ("lambda u: substr(u, 1, strpos(u, ':')) || CASE WHEN rtrim(substr(u, strpos(u, ':') + 1), '.:?-') = '' "
           "THEN substr(u, strpos(u, ':') + 1, 1) ELSE rtrim(substr(u, strpos(u, ':') + 1), '.:?-') END")
    return f"list_transform({raw}, {fix})"
