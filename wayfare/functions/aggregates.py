"""Aggregate columns whose result on no rows is zero, not NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Adding decimals gives the same sum in whatever order the shuffle delivers the partial sums; adding
# doubles does not. Four decimals hold the minor units of every currency and are added fastest.
MONEY = "decimal(18,4)"
FINE = "decimal(38,15)"


def count_if(predicate: Column) -> Column:
    """Rows for which the predicate holds; NULL counts as false."""
    return F.count_if(predicate)


def distinct_count(*columns: Column | str) -> Column:
    """Exact number of distinct values."""
    return F.count_distinct(*columns)


def _exactly(amount: Column, kind: str) -> Column:
    """The amount as a decimal if that loses nothing, else NULL."""
    decimal = amount.try_cast(kind)
    return F.when(decimal.cast("double") == amount, decimal)


def money_sum(amount: Column | str) -> Column:
    """Sum of an amount as a double; 0 over no rows.

    Amounts that are decimals of the kinds above are added exactly. All others (very large, very
    fine, not finite) are added as doubles, so no amount is lost and none can fail the job.
    """
    amount = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    plain, fine = _exactly(amount, MONEY), _exactly(amount, FINE)
    fine = F.when(plain.isNull(), fine)
    rest = F.when(plain.isNull() & fine.isNull(), amount)
    # Beyond 1e23 the fine sum overflows; it is then taken as a sum of doubles.
    fine_sum = F.try_sum(fine)
    exact = F.when(fine_sum.isNotNull(), F.try_add(F.sum(plain).try_cast(FINE), fine_sum)).cast("double")
    loose = F.coalesce(F.sum(plain).cast("double"), F.lit(0.0)) + F.coalesce(F.sum(fine.cast("double")), F.lit(0.0))
    return F.coalesce(exact, loose) + F.coalesce(F.sum(rest), F.lit(0.0))


def sum_if(amount: Column | str, predicate: Column) -> Column:
    """Sum of an amount over the rows for which the predicate holds; 0 if there are none."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return money_sum(F.when(predicate, amount))


def money_avg(amount: Column | str) -> Column:
    """Mean amount; NULL over no rows."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    rows = F.count(amount)
    return F.when(rows > 0, money_sum(amount) / rows)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating quotient, 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )
