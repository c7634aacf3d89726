"""Column expressions shared by marts, reports and checks.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PASSED = ("Pass", "Distinction")


def round_dec(c: Column | str, n: int) -> Column:
    """Round half-up through decimal(28,10) and return a double.

    Plain ``round`` on a double disagrees between engines on binary ties
    (1.005 -> 1.01 or 1.0); going through a decimal first makes the rule
    explicit and identical everywhere.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(28,10)"), n).cast("double")


def rate_pct(cond: Column) -> Column:
    """avg(CASE WHEN cond THEN 100.0 ELSE 0.0 END): a null condition counts as 0."""
    return F.avg(F.when(cond, F.lit(100.0)).otherwise(F.lit(0.0)))


def pass_rate_pct(final_result: str = "final_result") -> Column:
    """Dashboard pass rate: Pass or Distinction, per fact row, 0..100."""
    return rate_pct(F.col(final_result).isin(*PASSED))


def risk_band(score: str = "score") -> Column:
    """null -> Unknown, >= 70 Low, >= 50 Medium, else High (order matters)."""
    s = F.col(score)
    return (F.when(s.isNull(), "Unknown")
            .when(s >= 70, "Low")
            .when(s >= 50, "Medium")
            .otherwise("High"))


def credit_band(credits: str = "studied_credits") -> Column:
    """Study-load bins on 60/120/180; a null falls through to '>= 180'."""
    c = F.col(credits)
    return (F.when(c < 60, "< 60")
            .when(c < 120, "60 - 119")
            .when(c < 180, "120 - 179")
            .otherwise(">= 180"))


def moment_corr(x: str, y: str) -> Column:
    """(avg(xy) - avg(x)avg(y)) / nullif(sd_pop(x) sd_pop(y), 0).

    Not ``corr()``: each average skips its own nulls, so with null x the
    terms cover different rows. Kept as the report defines it.
    """
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    den = F.stddev_pop(xd) * F.stddev_pop(yd)
    return (F.avg(xd * yd) - F.avg(xd) * F.avg(yd)) / F.nullif(den, F.lit(0.0))
