"""Numeric coercion, the three rounding rules, and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One short cast per use: these expressions are evaluated in filters as well as in
# projections, and a long one would push the generated method past what the JVM
# compiles. DECIMAL parsing takes exactly the decimal spellings (" 2 ", "+4",
# "1e3", ".5") and none of "1d", "0x10", "1_0", "1,000", "inf", "nan".
_NUMBER_CHECK = "decimal(38,0)"
_INTEGER_VIA = "decimal(38,18)"


def number_column(df: DataFrame, name: str) -> Column:
    """A column as DOUBLE; what is not a finite decimal number (below 1e38) becomes null."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.NumericType):
        number = c.cast("double")
        return F.when(F.abs(number) < F.lit(float("inf")), number)
    text = c.cast("string")
    return F.when(text.try_cast(_NUMBER_CHECK).isNotNull(), text.try_cast("double"))


def integer_column(df: DataFrame, name: str) -> Column:
    """A column as BIGINT, truncated toward zero; null when not a number or out of range.

    Reads ``12.0`` and ``1e3`` as well as ``12``; ids above 2**53 keep every digit.
    """
    c = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    if isinstance(dtype, T.NumericType):
        return c.try_cast("bigint")
    return c.cast("string").try_cast(_INTEGER_VIA).try_cast("bigint")


def round_half_even_2(c: Column) -> Column:
    """Scale, round to the nearest integer (ties to even), scale back: numpy's rule for 2 digits."""
    return F.rint(c * F.lit(100.0)) / F.lit(100.0)


def round_half_up(c: Column, digits: int) -> Column:
    """SQL ROUND: ties away from zero."""
    return F.round(c, digits)


def cents(c: Column) -> Column:
    """A two-digit money amount as whole cents (BIGINT): sums do not depend on the order of rows."""
    return F.rint(c * F.lit(100.0)).cast("bigint")


def from_cents(c: Column) -> Column:
    """Whole cents as a DOUBLE amount, rounded once."""
    return (c.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("double")


def sum_cents(c: Column) -> Column:
    return F.sum(cents(c))


def money_sum(c: Column) -> Column:
    """Exact SUM of a two-digit money column, as DOUBLE."""
    return from_cents(sum_cents(c))


def mean_of_cents(total: Column, n: Column) -> Column:
    """AVG from a cents total and a row count; null when there are no rows."""
    return F.try_divide(from_cents(total), n.cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded half up; null on an empty whole."""
    return round_half_up(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)
