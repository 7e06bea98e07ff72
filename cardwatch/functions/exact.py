"""Sums of doubles that don't depend on the order of the rows.

Adding doubles rounds at each step, so a sum's last digits change with the partitioning, and a mean may round the other
way. Here each value is taken as the decimal number that it prints as, to 18 places, and decimals are added exactly;
only the result becomes a double again. Sums up to 10^20 fit, a larger one fails (``ANSI``) or is NULL. NaN makes the result NaN,
as do infinities of both signs; one infinity stays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exact sum of values: what partial results are stored as.
SUM_TYPE = "decimal(38,18)"
_SPECIAL = ("NaN", "Infinity", "-Infinity")


def _finite(c: Column) -> Column:
    return F.when(~c.isin(*[float(s.replace("Infinity", "inf")) for s in _SPECIAL]), c)


def exact_sum(column: str) -> Column:
    """Exact sum (``SUM_TYPE``) of the finite values of a double column; NULL if there are none."""
    return F.sum(_finite(F.col(column)).cast(SUM_TYPE)).cast(SUM_TYPE)


def special_sum(column: str) -> Column:
    """Sum of the NaNs and infinities of a column (NULL: none); it is the same in any order."""
    c = F.col(column)
    return F.sum(F.when(c.isin(*[float(s.replace("Infinity", "inf")) for s in _SPECIAL]), c))


def as_double(total: Column, special: Column) -> Column:
    """The double next to an exact sum, or the NaN or infinity that it meets."""
    return F.coalesce(special, total.cast("double"))


def exact_avg(column: str) -> Column:
    """Mean of the non-null values of a double column, equal for every order and partitioning."""
    return as_double(exact_sum(column), special_sum(column)) / F.count(column)
