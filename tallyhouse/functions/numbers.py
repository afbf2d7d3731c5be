"""Exact decimal ratios.

Sums of money stay decimals, so totals do not depend on the order in which
tasks finish. Operands are brought to one width before dividing: Spark then
keeps 14 fractional digits in the quotient instead of the 6 it would fall back
to for two very wide sums.
"""

from pyspark.sql import functions as F

OPERAND = "decimal(24,4)"


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def ratio(numerator, denominator):
    """Quotient; NULL where the denominator is NULL or zero."""
    top = _column(numerator).cast(OPERAND)
    bottom = _column(denominator).cast(OPERAND)
    return top / F.nullif(bottom, F.lit(0).cast(OPERAND))


def percent(numerator, denominator, places=2):
    """Percentage rounded half up; NULL where the ratio is."""
    value = F.round(ratio(numerator, denominator) * 100, places)
    return value.cast(f"decimal(18,{places})")


def rounded_ratio(numerator, denominator, places):
    """Quotient rounded half up; NULL where the denominator is NULL or zero."""
    return F.round(ratio(numerator, denominator), places).cast(f"decimal(18,{places})")


def rate_or_zero(numerator, denominator, places=6):
    """Quotient for a KPI tile: an empty or zero denominator shows as 0."""
    return F.coalesce(rounded_ratio(numerator, denominator, places), F.lit(0).cast(f"decimal(18,{places})"))


def mean(column, places=2):
    """Mean of the non-null values from the exact sum and count, rounded half up."""
    column = _column(column)
    return rounded_ratio(F.sum(column), F.count(column), places)


def money(column, places=2, width=20):
    """Round half up and fix the decimal type."""
    return F.round(_column(column), places).cast(f"decimal({width},{places})")
