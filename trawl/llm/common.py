"""Column helpers shared by the native operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six ASCII white-space characters that separate words: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def text_of(col: Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(col.cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def split_words(col: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text: one translate, a split at one fixed
    character (no regex machine), empty pieces removed."""
    return F.array_remove(F.split(F.translate(col, SPACES, " " * len(SPACES)), " "), "")


def null_safe_key(col: Column) -> Column:
    """A non-null string key: '' for null, '+' before any value (keeps code-point order)."""
    return F.when(col.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), col.cast("string")))


def private(columns: list[str], name: str) -> str:
    """``name`` with as many leading underscores as it takes not to clash with ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
