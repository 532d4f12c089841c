"""Optional presentation columns; nothing downstream computes with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars(c: Column, digits: int = 2) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(c, digits))


def thousands(c: Column) -> Column:
    """``1,234``"""
    return F.format_number(c, 0)


def pad_left(c: Column, width: int) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, " "))


def pad_right(c: Column, width: int) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.rpad(text, width, " "))


def two_digits(c: Column) -> Column:
    """``07``"""
    return F.format_string("%02d", c)


def dollars_padded(c: Column, width: int) -> Column:
    """``$`` and the amount right-aligned in ``width`` characters."""
    return F.concat(F.lit("$"), pad_left(F.format_number(c, 2), width))
