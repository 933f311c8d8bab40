"""Link checks and normalisation, all native.

Every part is taken from the whole link by one anchored pattern, so that parts
do not nest and the expressions stay small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions import reasons
from broadsheet.functions.text import is_blank

# Accepted link text, default ports, and the characters a host may not and a path must escape.
LINK = r"(?Ud)^https?://[^\s/$.?#].[^\s]*\z"
HTTP_PORT, HTTPS_PORT = "80", "443"
HOST_CHAR = r"[^\x00-\x20#%/:<>?@\[\\\]^|\x7f]"
PATH_ESCAPED = r"[^\x21\x23-\x3b\x3d\x3f-\x5f\x61-\x7a\x7c\x7e]"
MAX_PORT = r"(?:\d{1,4}|[1-5]\d{4}|6[0-4]\d{3}|65[0-4]\d{2}|655[0-2]\d|6553[0-5])"

_END = r"(?:[/\\?#]|\z)"
_USER = r"(?:[^/\\?#]*@)?"
_HOST = r"(?:\[[^\]/\\?#]*\]|[^:/\\?#]*)"

NO_HOST = rf"^https?://{_USER}(?::[^/\\?#]*)?{_END}"
GOOD_HOST = rf"^https?://{_USER}(?:\[[0-9A-Fa-f:.]+\]|{HOST_CHAR}+)(?::[^/\\?#]*)?{_END}"
GOOD_PORT = rf"^https?://{_USER}{_HOST}(?::(?:0*{MAX_PORT})?)?{_END}"

_PREFIX = rf"^(https?://{_USER})"
_HOST_PART = rf"^https?://{_USER}({_HOST})"
_PORT_PART = (
    rf"^(?:http://{_USER}{_HOST}:(?!0*{HTTP_PORT}{_END})|https://{_USER}{_HOST}:(?!0*{HTTPS_PORT}{_END}))0*(\d+)"
)
_PATH_PART = r"^https?://[^/\\?#]*([^?#]*)"
# links whose path needs escaping or has dot segments
_ODD_PATH = rf"^https?://[^/\\?#]*[^?#]*?(?:{PATH_ESCAPED}|\\|(?i:[/\\](?:\.|%2e)))"
_DOT_END = r"(?i)/(?:\.|%2e){1,2}\z"


def _resolve_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments of an absolute path; the last one leaves a trailing slash."""
    closed = F.regexp_replace(path, _DOT_END, "$0/")

    def step(acc: Column, seg: Column) -> Column:
        name = F.replace(F.lower(seg), F.lit("%2e"), F.lit("."))
        return (
            F.when(name == ".", acc)
            .when(name == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
            .otherwise(F.concat(acc, F.array(seg)))
        )

    segments = F.split(F.substring(closed, 2, 1 << 30), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def _escape_path(path: Column) -> Column:
    """Percent-encode the characters that may not stand in a path."""
    escaped = F.transform(
        F.split(path, ""), lambda ch: F.when(ch.rlike(PATH_ESCAPED), F.url_encode(ch)).otherwise(ch)
    )
    return F.array_join(escaped, "")


def link_error(c: Column, schemes: tuple[str, ...] = ("http", "https")) -> Column:
    """Why a link is refused, NULL when it is accepted."""
    invalid = F.concat(F.lit(reasons.URL_INVALID), c)
    because = lambda detail: F.concat(invalid, F.lit(f": {detail}"))
    scheme = F.substring_index(c, ":", 1)
    return (
        F.when(is_blank(c), reasons.URL_INVALID + reasons.URL_EMPTY)
        .when(~c.rlike(LINK), invalid)
        .when(c.rlike(NO_HOST), because(reasons.URL_NO_HOST))
        .when(~c.rlike(GOOD_HOST), because(reasons.URL_BAD_HOST))
        .when(~c.rlike(GOOD_PORT), because(reasons.URL_BAD_PORT))
        .when(~scheme.isin(*schemes), F.concat(F.lit(reasons.URL_SCHEME), scheme))
    )


def clean_link(c: Column) -> Column:
    """Link cut after its path: lower-case host, default port, query and fragment dropped."""
    port = F.regexp_extract(c, _PORT_PART, 1)
    path = F.regexp_extract(c, _PATH_PART, 1)
    odd = _resolve_dots(_escape_path(F.concat(F.lit("/"), F.substring(F.replace(path, F.lit("\\"), F.lit("/")), 2, 1 << 30))))
    plain = F.concat(F.lit("/"), F.substring(path, 2, 1 << 30))
    return F.concat(
        F.regexp_extract(c, _PREFIX, 1),
        F.lower(F.regexp_extract(c, _HOST_PART, 1)),
        F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""),
        F.when(c.rlike(_ODD_PATH), odd).otherwise(plain),
    )


def site_of(url: Column) -> Column:
    """Scheme and host of a page address."""
    return F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1)


def absolute_link(link: Column, page_url: Column) -> Column:
    """Prefix the site of the page to a link that starts with ``/``."""
    return F.when(F.startswith(link, F.lit("/")), F.concat(site_of(page_url), link)).otherwise(link)
