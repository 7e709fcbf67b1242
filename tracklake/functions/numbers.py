"""Exact sums, rounding and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(28,12)"


def round_half_up(value: Column, digits: int) -> Column:
    """Round the double as its decimal text reads, ties away from zero, in one step; values that are not finite stay."""
    return F.round(value.cast("double"), digits)


def exact_sum(value: Column) -> Column:
    """A sum of doubles that does not depend on row order.

    Values are added as decimals of twelve places, exactly; the rare value no decimal can hold is added
    as a double, so that nothing is left out.
    """
    exact = value.try_cast(_EXACT)
    rest = F.sum(F.when(exact.isNull(), value.cast("double")))
    total = F.sum(exact).cast("double")
    return F.when(rest.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + rest)


def ratio_or_zero(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        round_half_up(numerator.cast("double") / denominator, digits)
    )


def safe_share(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole as a fraction; NULL where whole is 0 or NULL."""
    return round_half_up(F.try_divide(part.cast("double"), whole), digits)
