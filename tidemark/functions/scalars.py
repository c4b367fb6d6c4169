"""Column expressions shared by the operators and jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: How far an amount may lie from a whole number of its smallest unit: floating-point noise, no digit.
NOISE = 1e-4


def _exact(value: Column, scale: int, units: Column) -> Column:
    """``units``, the whole number next to the amount; fails where a digit would be lost, and for NaN and infinities."""
    amount = value.cast("double") * F.lit(float(10**scale))
    near = F.abs(amount - F.rint(amount)) < F.greatest(F.lit(NOISE), F.abs(amount) * F.lit(1e-12))
    told = F.concat(F.lit("not an amount with "), F.lit(str(scale)), F.lit(" decimals: "), value.cast("string"))
    # NaN, and what infinity less infinity gives, is below nothing: it takes the second branch.
    return F.when(value.isNull() | near, units).otherwise(F.raise_error(told))


def money(value: Column | str, scale: int = 2) -> Column:
    """Exact decimal form of a money column; sums stay free of float noise.

    Amounts with more decimals, NaN and infinities fail: nothing is rounded in
    silence.  Agrees with ``cents``.
    """
    value = as_col(value)
    return _exact(value, scale, value.cast(f"decimal(18,{scale})"))


def cents(value: Column | str, scale: int = 2) -> Column:
    """A money column as a whole number of its smallest unit; fails as ``money`` does.

    Much cheaper than a decimal cast, which goes through text for every row.
    """
    value = as_col(value)
    return _exact(value, scale, F.rint(value.cast("double") * F.lit(float(10**scale))).cast("bigint"))


def exact_sum(units: Column) -> Column:
    """Sum of whole numbers as decimal, which cannot overflow on the way.

    The high and the low 20 bits are summed apart in plain long arithmetic and
    put together once per group; a decimal sum would build an object per row.
    """
    high = F.sum(F.shiftright(units, 20)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**20 - 1).cast("bigint"))).cast("decimal(20,0)")
    return high * F.lit(2**20).cast("decimal(7,0)") + low


def money_sum(value: Column | str, scale: int = 2) -> Column:
    """Exact sum of a money column, handed out as double."""
    return exact_sum(cents(value, scale)).cast("double") / F.lit(float(10**scale))


def money_avg(value: Column | str, scale: int = 2) -> Column:
    """Average over non-null values from an exact sum; NULL for none."""
    return F.try_divide(money_sum(value, scale), F.count(as_col(value)).cast("double"))


def safe_cast(value: Column | str, to: str) -> Column:
    """NULL instead of an error for text that does not convert."""
    return as_col(value).try_cast(to)


def same(left: Column, right: Column) -> Column:
    """Null-safe equality."""
    return left.eqNullSafe(right)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def sort_columns(order: list[str]) -> list[Column]:
    """Sort expressions from names; a leading ``-`` sorts descending.

    Nulls go first ascending and last descending, always said explicitly.
    """
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_first()
        for name in order
    ]


def bare(order: list[str]) -> list[str]:
    """Column names of an order list."""
    return [name.lstrip("-") for name in order]
