"""Money as decimal(18,2): parsing, rounding, the fee schedule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FEE_SCHEDULE, MONEY

_SHAPE = r"\A-?(?:0|[1-9][0-9]*)\.[0-9]{2}\z"


def cents(c) -> Column:
    """A decimal rounded half up (away from zero) to two places."""
    return F.round(F.col(c) if isinstance(c, str) else c, 2).cast(MONEY)


def parse_money(text: Column, allow_negative: bool = False) -> Column:
    """Money from text with exactly two decimals and ASCII digits; anything else, or a value beyond 16 digits, is null.

    ``-0.00`` is zero; negative values are null unless allowed.
    """
    value = F.when(F.rlike(text, F.lit(_SHAPE)), text.try_cast(MONEY))
    return value if allow_negative else F.when(value >= 0, value)


def format_money(value: Column) -> Column:
    return value.cast(MONEY).cast("string")


def contract_fee(method: Column, amount: Column) -> Column:
    """The contractual fee of a capture, rounded half up; null for an unknown method."""
    out = F.lit(None).cast(MONEY)
    for name, (fixed, rate) in FEE_SCHEDULE.items():
        out = F.when(
            method == name,
            cents(F.lit(fixed).cast("decimal(4,2)") + amount.cast(MONEY) * F.lit(rate).cast("decimal(4,3)"))
        ).otherwise(out)
    return out


def variance(expected: Column, actual: Column) -> Column:
    """actual - expected; null unless both are there."""
    return (actual - expected).cast(MONEY)


def total(c) -> Column:
    """A money sum that is 0.00 over no rows."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)


def retry_delay(attempt: Column, base_seconds: Column) -> Column:
    """Seconds until the next attempt: the base doubled with each failure, an hour at most."""
    return F.least(F.lit(3600), base_seconds * F.pow(F.lit(2), F.least(attempt - 1, F.lit(12)))).cast("long")
