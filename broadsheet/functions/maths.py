"""Small numeric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trend limits in percent.
STRONG_PCT = 10
MODERATE_PCT = 2


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """Quotient as double, ``default`` where the divisor is 0 or missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def pct_change(new: Column, old: Column) -> Column:
    """Change in percent of ``old``; 0 unless ``old`` is positive."""
    return F.when(old > 0, (new - old) / old * 100).otherwise(F.lit(0.0))


def trend_class(pct: Column) -> Column:
    return (
        F.when(pct > STRONG_PCT, "strong_increase")
        .when(pct > MODERATE_PCT, "moderate_increase")
        .when(pct < -STRONG_PCT, "strong_decrease")
        .when(pct < -MODERATE_PCT, "moderate_decrease")
        .otherwise("stable")
    )


def round_half_even(c: Column, digits: int = 2) -> Column:
    return F.bround(c, digits)
