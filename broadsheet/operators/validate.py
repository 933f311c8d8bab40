"""Row validation as one pass of native expressions.

Checks run in the order title, link, description, published, source, and the
first failure is the reason a row is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.config import ValidationConfig
from broadsheet.functions import reasons
from broadsheet.functions.barrier import compute_once
from broadsheet.functions.dates import parse_published, rfc3339
from broadsheet.functions.html import sanitize_html
from broadsheet.functions.text import text_length, unicode_trim
from broadsheet.functions.urls import clean_link, link_error

FIELDS = ("title", "link", "description", "published", "source")


def clean_title(c: Column) -> Column:
    return unicode_trim(c)


def title_error(c: Column, cfg: ValidationConfig = ValidationConfig()) -> Column:
    text = unicode_trim(c)
    limit = cfg.max_title_length
    return F.when(text == "", reasons.TITLE_EMPTY).when(
        text_length(text, cfg.length_unit) > limit, reasons.TITLE_TOO_LONG.format(limit)
    )


def clean_description(c: Column, cfg: ValidationConfig = ValidationConfig()) -> Column:
    if cfg.html_sanitize:
        return sanitize_html(c, remove_scripts=cfg.remove_script_tags)
    return unicode_trim(c)


def description_error(cleaned: Column, cfg: ValidationConfig = ValidationConfig()) -> Column:
    limit = cfg.max_description_length
    return F.when(
        text_length(cleaned, cfg.length_unit) > limit, reasons.DESCRIPTION_TOO_LONG.format(limit)
    )


def date_error(
    text: Column, parsed: Column, as_of: Column, cfg: ValidationConfig = ValidationConfig()
) -> Column:
    reason = F.when(parsed.isNull(), F.concat(F.lit(reasons.DATE_INVALID), text))
    if not cfg.allow_future_dates:
        reason = reason.when(parsed > as_of, F.concat(F.lit(reasons.DATE_FUTURE), rfc3339(parsed)))
    return reason.when(
        F.year(parsed) < cfg.min_year,
        F.concat(F.lit(reasons.DATE_TOO_OLD), rfc3339(parsed)),
    )


def source_error(c: Column) -> Column:
    return F.when(unicode_trim(c) == "", reasons.SOURCE_EMPTY)


TEXT_CHECKS = ("checked_title", "title_error", "checked_description", "description_error", "checked_bytes")


def check_texts(df: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Add what validation needs of ``title`` and ``description``: the cleaned texts, their errors, bytes of the description.

    Taken from documents before they are joined to their articles, each text is cleaned once, and none has to
    pass the join where only the verdict is asked for.
    """
    parts = F.struct(
        clean_title(F.coalesce("title", F.lit(""))).alias("title"),
        clean_description(F.coalesce("description", F.lit("")), cfg).alias("description"),
    )
    rows = compute_once(df, parts, "_t")
    c = F.col("_t")
    values = (
        c["title"], title_error(c["title"], cfg), c["description"], description_error(c["description"], cfg),
        F.octet_length(c["description"]).cast("long"),
    )
    return rows.withColumns(dict(zip(TEXT_CHECKS, values, strict=True))).drop("_t")


def verdicts(df: DataFrame, as_of: Column, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Add ``success, error_code, error``, and the cleaned fields as ``valid_<field>`` where the row is accepted.

    A missing field counts as empty text. Text checks that are there are taken as they are.
    """
    if "checked_title" not in df.columns:
        df = check_texts(df, cfg)
    raw = {f: F.coalesce(F.col(f), F.lit("")) for f in ("link", "published", "source")}
    parts = F.struct(
        link_error(raw["link"], cfg.allowed_url_schemes).alias("link_error"),
        clean_link(raw["link"]).alias("link"),
        parse_published(raw["published"], as_of, cfg.date_mode).alias("at"),
        unicode_trim(raw["source"]).alias("source"),
    )
    rows = compute_once(df, parts, "_c")
    c = F.col("_c")
    error = F.coalesce(
        F.col("title_error"),
        c["link_error"],
        F.col("description_error"),
        date_error(raw["published"], c["at"], as_of, cfg),
        source_error(c["source"]),
    )
    rows = rows.withColumn("error", error)
    accepted = F.col("error").isNull()
    cleaned = {
        "title": F.col("checked_title"),
        "link": c["link"],
        "description": F.col("checked_description"),
        "published": rfc3339(c["at"]),
        "published_time": c["at"],
        "source": c["source"],
    }
    columns = {"success": accepted, "error_code": reasons.reason_code(F.col("error"))}
    columns |= {f"valid_{f}": F.when(accepted, v) for f, v in cleaned.items()}
    return rows.withColumns(columns).drop("_c", *TEXT_CHECKS[:4])


CLEANED = (*FIELDS[:4], "published_time", "source")


def validate(
    df: DataFrame, as_of: Column, cfg: ValidationConfig = ValidationConfig(), column: str = "verdict"
) -> DataFrame:
    """Add ``verdict``: success, error code and text, and the cleaned fields when accepted.

    Every other column, the raw fields included, is kept. A missing field counts as empty text.
    """
    # columns of the same names are put aside
    taken = [c for c in df.columns if c in ("success", "error_code", "error") or c.startswith("valid_")]
    aside = {c: f"_kept_{c}" for c in taken}
    rows = verdicts(df.withColumnsRenamed(aside), as_of, cfg)
    article = F.struct(*[F.col(f"valid_{f}").alias(f) for f in CLEANED])
    verdict = F.struct("success", "error_code", "error", F.when(F.col("success"), article).alias("validated_article"))
    rows = rows.withColumn(column, verdict).drop("success", "error_code", "error", "checked_bytes", *[f"valid_{f}" for f in CLEANED])
    return rows.withColumnsRenamed({v: k for k, v in aside.items()})


def split_valid(
    df: DataFrame, as_of: Column, cfg: ValidationConfig = ValidationConfig(), enabled: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows with their fields replaced by the cleaned ones, and refused rows with reasons.

    With ``enabled`` off every row is accepted as it is.
    """
    if not enabled:
        none = F.lit(None).cast("string")
        return df, df.filter(F.lit(False)).withColumns({"error_code": none, "error": none})
    checked = validate(df, as_of, cfg)
    valid = checked.filter("verdict.success")
    valid = valid.withColumns({f: F.col(f"verdict.validated_article.{f}") for f in FIELDS}).drop("verdict")
    invalid = checked.filter("not verdict.success").withColumns(
        {"error_code": F.col("verdict.error_code"), "error": F.col("verdict.error")}
    )
    return valid, invalid.drop("verdict")


def verdict_json(verdict: str = "verdict") -> Column:
    """Verdict as JSON: success with the cleaned article, or failure with its error text."""
    article = F.struct(*[F.col(f"{verdict}.validated_article.{f}").alias(f) for f in FIELDS])
    ok = F.to_json(F.struct(F.lit(True).alias("success"), article.alias("validated_article")))
    failed = F.to_json(F.struct(F.lit(False).alias("success"), F.col(f"{verdict}.error").alias("error")))
    return F.when(F.col(f"{verdict}.success"), ok).otherwise(failed)


def reason_counts(df: DataFrame, as_of: Column, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Rows per outcome, ``valid`` included."""
    code = F.coalesce(F.col("error_code"), F.lit("valid"))
    return verdicts(df, as_of, cfg).groupBy(code.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def write_routed(df: DataFrame, path: str, as_of: Column, cfg: ValidationConfig = ValidationConfig()) -> None:
    """Write accepted and refused rows in one job, in folders by ``outcome`` (valid, invalid).

    The fields of accepted rows are the cleaned ones; refused rows keep theirs and have ``error_code, error``.
    """
    rows = verdicts(df, as_of, cfg)
    fields = {f: F.when(F.col("success"), F.col(f"valid_{f}")).otherwise(F.col(f)).alias(f) for f in FIELDS}
    outcome = F.when(F.col("success"), "valid").otherwise("invalid").alias("outcome")
    columns = [fields.get(c, F.col(c)) for c in df.columns if c not in TEXT_CHECKS]
    rows.select(*columns, "error_code", "error", outcome).write.partitionBy("outcome").parquet(path)


def read_routed(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and refused rows with their reasons, as ``split_valid`` returns them; ``schema`` is that of the rows."""
    kept = [f for f in schema if f.name not in TEXT_CHECKS]
    reasons_of = [T.StructField(c, T.StringType()) for c in ("error_code", "error")]
    rows = spark.read.schema(T.StructType([*kept, *reasons_of, T.StructField("outcome", T.StringType())])).parquet(path)
    valid = rows.filter("outcome = 'valid'").drop("outcome", "error_code", "error")
    return valid, rows.filter("outcome = 'invalid'").drop("outcome")
