"""PII masking as Column expressions (regexp_replace + regexp_count).

Java regex is run with ``(?U)`` so ``\\d``, ``\\s`` and ``\\b`` are Unicode,
as they are for Python ``str`` patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import EMAIL_MASK, EMAIL_RE, IP_MASK, IP_RE, PHONE_MASK, PHONE_RE

KINDS = {
    "email": (EMAIL_RE, EMAIL_MASK),
    "phone": (PHONE_RE, PHONE_MASK),
    "ip": (IP_RE, IP_MASK),
}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _java(pattern: str) -> str:
    return "(?U)" + pattern


def _java_literal(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def mask(col, kind: str) -> tuple[Column, Column]:
    """(masked text, number of replacements) for one kind of PII."""
    pat, token = KINDS[kind]
    c = _c(col)
    return (F.regexp_replace(c, _java(pat), _java_literal(token)),
            F.regexp_count(c, F.lit(_java(pat))).cast("bigint"))


def mask_emails(col):
    return mask(col, "email")


def mask_phone_numbers(col):
    return mask(col, "phone")


def mask_ips(col):
    return mask(col, "ip")
