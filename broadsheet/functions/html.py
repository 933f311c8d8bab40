"""HTML to plain text with native regular expressions.

``(?d)`` makes ``.`` stop only at a line feed and ``(?U)`` makes classes
Unicode. Where an opener has no closer in the rest of the text, the pattern's
last alternative takes the rest and puts it back, so text with many stray
openers is still scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import unicode_trim

# What counts as script, handler attribute and tag, and how entities decode, in order.
SCRIPT = r"(?d)<script[^>]*+>.*?</script>|(<script[^>]*+\z)"
HANDLER = r"(?U)on\w++\s*+="
HANDLER_REPLACEMENT = "data-removed="
TAG = r"<[^>]*+>|(<[^>]*+\z)"
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]

_UNCLOSED = "$1"


def _replace_where(c: Column, needle: str, pattern: str, replacement: str) -> Column:
    """Replace a pattern in texts that hold ``needle``; a plain search spares the others the scan."""
    return F.when(F.contains(c, F.lit(needle)), F.regexp_replace(c, pattern, replacement)).otherwise(c)


def strip_tags(c: Column) -> Column:
    return _replace_where(c, "<", TAG, _UNCLOSED)


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def sanitize_html(c: Column, *, sanitize: bool = True, remove_scripts: bool = True) -> Column:
    """Scripts out, event handlers defused, tags out, basic entities decoded, trimmed."""
    if remove_scripts:
        c = _replace_where(c, "</script>", SCRIPT, _UNCLOSED)
    c = _replace_where(c, "=", HANDLER, HANDLER_REPLACEMENT)
    if sanitize:
        c = decode_entities(strip_tags(c))
    return unicode_trim(c)
