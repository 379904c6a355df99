"""Sums and means that do not depend on the order rows arrive in.

Doubles are added as decimals, so the same rows give the same total on any number of
partitions and after any task retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(28,8)"
PERCENT = AMOUNT
_LIMIT = 1e18  # smaller amounts fit the type and leave room for their sum


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _unfit(column: Column) -> Column:
    """Whether an amount is too large or not finite."""
    return F.coalesce(~(F.abs(column) < _LIMIT), F.lit(False))


def in_range(column: Column | str) -> Column:
    """Whether an amount is null, or finite and small enough to be summed exactly."""
    return ~_unfit(_col(column))


def sum_parts(column: Column | str) -> tuple[Column, Column, Column]:
    """Aggregates from which ``sum_of_parts`` makes a sum over groups of groups."""
    column = _col(column)
    fit = F.when(~_unfit(column), column).cast(AMOUNT)
    return F.sum(fit), F.sum(column), F.bool_or(_unfit(column))


def sum_of_parts(exact: Column | str, plain: Column | str, unfit: Column | str) -> Column:
    total = F.sum(_col(exact)).cast("double")
    return F.when(F.bool_or(_col(unfit)), F.sum(_col(plain))).otherwise(total)


def exact_sum(column: Column | str) -> Column:
    """Sum of amounts, exact to eight decimals. With an amount that is not finite or too large
    for the decimal, the sum is that of the doubles, so nothing is left out."""
    exact, plain, unfit = sum_parts(column)
    return F.when(unfit, plain).otherwise(exact.cast("double"))


def total_of_totals(column: Column | str) -> Column:
    """Sum of amounts that are sums already."""
    return exact_sum(column)


def exact_mean(column: Column | str) -> Column:
    """Mean of percentages."""
    return exact_sum(column) / F.count(_col(column))


def percent_of(part: Column, whole: Column) -> Column:
    """part as a percentage of whole, null where whole is zero."""
    return part * 100.0 / F.nullif(whole, F.lit(0.0))


def round_for_display(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Round the named columns; results are otherwise kept at full precision."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
