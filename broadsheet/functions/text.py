"""Text helpers shared by validation and window statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def unicode_trim(c: Column) -> Column:
    """Strip Unicode white space at both ends (``trim`` alone strips only spaces)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    return unicode_trim(c) == ""


def text_length(c: Column, unit: str = "chars") -> Column:
    """Length in code points or in UTF-8 bytes."""
    return F.octet_length(c) if unit == "bytes" else F.length(c)


def words(c: Column) -> Column:
    """Lower-case words split at Unicode white space."""
    parts = F.split(F.lower(c), r"(?U)[\s\x1c-\x1f]+")
    return F.filter(parts, lambda w: w != "")


def keywords(c: Column, min_chars: int = 4) -> Column:
    """Words long enough to count as keywords."""
    parts = F.split(F.lower(c), r"(?U)[\s\x1c-\x1f]+")
    return F.filter(parts, lambda w: F.length(w) >= min_chars)


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def label_of(v: Column, key: str) -> Column:
    """Text of a variant that is either a plain value or an object naming itself under ``key``."""
    return F.coalesce(F.try_variant_get(v, f"$.{key}", "string"), v.cast("string"))


def labels_of(arr: Column, key: str) -> Column:
    """Array of variants to array of text; a NULL array is an empty one."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.transform(arr, lambda v: label_of(v, key)), none)
