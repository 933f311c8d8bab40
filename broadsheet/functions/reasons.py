"""Why a row is refused: error texts and their short codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error texts, in the order the checks run; some are followed by the refused text.
TITLE_EMPTY = "Title is empty or too short"
TITLE_TOO_LONG = "Title is too long (max {} characters)"
URL_INVALID = "Invalid URL: "
URL_EMPTY = "URL is empty"
URL_NO_HOST = "empty host"
URL_BAD_HOST = "invalid domain character"
URL_BAD_PORT = "invalid port number"
URL_SCHEME = "URL scheme not allowed: "
DESCRIPTION_TOO_LONG = "Description is too long (max {} characters)"
DATE_INVALID = "Invalid date format: "
DATE_FUTURE = "Date is in the future: "
DATE_TOO_OLD = "Date is too old (before 2000): "
SOURCE_EMPTY = "Field validation failed: Source cannot be empty"

# short code of each kind of error, found by the fixed start of its text
CODES = {
    "title_empty": TITLE_EMPTY,
    "title_too_long": TITLE_TOO_LONG,
    "url_invalid": URL_INVALID,
    "url_scheme": URL_SCHEME,
    "description_too_long": DESCRIPTION_TOO_LONG,
    "date_invalid": DATE_INVALID,
    "date_future": DATE_FUTURE,
    "date_too_old": DATE_TOO_OLD,
    "source_empty": SOURCE_EMPTY,
}


def reason_code(error: Column) -> Column:
    """Short code of an error text."""
    code = F.when(error.isNull(), F.lit(None).cast("string"))
    for name, text in CODES.items():
        code = code.when(F.startswith(error, F.lit(text.split("{")[0])), name)
    return code
