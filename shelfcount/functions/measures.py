"""Numeric expressions: safe casts, variance arithmetic, tariffs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _col

MONEY = "decimal(18,4)"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(c: Column | str, dtype: str = "double") -> Column:
    """Number from text, null when the text is not one."""
    c = _col(c)
    return F.when(c.rlike(NUMBER), c.try_cast(dtype))


def decimal(c: Column | str, dtype: str = "decimal(18,2)") -> Column:
    """Decimal from text with thousands commas; blanks and bad text give null."""
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast(dtype)


def money(c: Column | str) -> Column:
    """Exact decimal for sums, so that the order of addition cannot change the result."""
    return _col(c).cast(MONEY)


def exact(df: DataFrame, c: Column | str) -> Column:
    """The value itself when its type adds exactly, else as a decimal.

    Types are left as narrow as they come: up to 18 digits Spark computes on plain longs.
    """
    dtype = df.select(_col(c)).schema[0].dataType
    return _col(c) if isinstance(dtype, (T.DecimalType, T.IntegralType)) else money(c)


def as_double(c: Column) -> Column:
    return c.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Quotient as a double; null when the divisor is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def positive_part(c: Column | str) -> Column:
    return F.when(_col(c) > 0, _col(c)).otherwise(F.lit(0))


def negative_part(c: Column | str) -> Column:
    return F.when(_col(c) < 0, _col(c)).otherwise(F.lit(0))


def mandays(soh: Column | str, per_piece: Column | str) -> Column:
    """Days of work, rounded half to even; 0 when the rate is null or 0."""
    soh, rate = _col(soh), _col(per_piece)
    return F.when(rate.isNull() | (rate == 0), F.lit(0.0)).otherwise(
        F.bround(F.try_divide(soh.cast("double"), rate.cast("double")), 0)
    )


def mandays_fixed(soh: Column | str, outsourced: Column | str, rate: float = 10500.0) -> Column:
    """Older rule: one fixed rate, 0 when no pieces are outsourced."""
    outsourced = _col(outsourced)
    return F.when(outsourced.isNull() | (outsourced == 0), F.lit(0.0)).otherwise(
        F.bround(_col(soh).cast("double") / F.lit(rate), 0)
    )


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition holds."""
    out = F
    for condition, value in rules:
        out = out.when(condition, F.lit(value))
    return out.otherwise(F.lit(default))
