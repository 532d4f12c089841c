"""Dates: coercion, the YYYYMMDD key and the calendar attributes."""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_DATE = "yyyy-MM-dd"
ISO_DATE_TIME = "yyyy-MM-dd HH:mm:ss"  # or a T between, without seconds, with a fraction or a zone
ISO_FORMATS = (ISO_DATE, ISO_DATE_TIME)
_WITH_TIME = r"\A.{10}[ T]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?\z"


def date_column(
    df: DataFrame, name: str, formats: str | Sequence[str] = ISO_DATE, order: Sequence[Column] = ()
) -> Column:
    """A column as DATE by the first of the formats that reads it; other text becomes null.

    Of a date with a time the date counts as written, whatever its zone. ``FIRST_VALUE`` in
    place of formats reads the column by the layout of its first value in ``order`` (a job
    of its own), and each value by its own layout if that has none that is known.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    text = c.cast("string")
    if formats == FIRST_VALUE:
        layout = first_layout(df, name, order)
        return any_layout(text) if layout == "each" else layout.column(text)
    return F.coalesce(*(_read(text, fmt) for fmt in ([formats] if isinstance(formats, str) else formats)))


def _read(text: Column, fmt: str) -> Column:
    if fmt == ISO_DATE_TIME:
        return F.when(F.rlike(text, F.lit(_WITH_TIME)), _read(F.left(text, F.lit(10)), ISO_DATE))
    if fmt == ISO_DATE:
        # The plain cast is the fast parser, but it takes other spellings too:
        # a date that prints as it was written is in this format.
        d = text.try_cast("date")
        return F.when(d.cast("string") == text, d)
    return F.try_to_date(text, fmt)


def date_key(d: Column) -> Column:
    """20240115 for 2024-01-15, from the date parts (no text formatting)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_date(key: Column) -> Column:
    """Inverse of :func:`date_key`."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), (F.floor(key / 100) % 100).cast("int"), (key % 100).cast("int")
    )


def calendar_columns(d: Column) -> list[Column]:
    """The attributes of the date dimension, in table order. Monday is day 0."""
    return [
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
    ]


def period_label(year: Column, month: Column) -> Column:
    """``2024-03``."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


# --- one layout for a whole column, taken from its first value --------------------

# Stands for "the layout of the column's first value" where formats are asked for.
FIRST_VALUE = "first value"

# fixed values: digits as strptime takes them, and the names of months
_YEAR, _MONTH, _DAY = "(?<y>[0-9]{4})", "(?<m>1[0-2]|0[1-9]|[1-9])", "(?<d>3[01]|[12][0-9]|0[1-9]|[1-9])"
_MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
_LONG, _SHORT = (f"(?<m>{'|'.join(names)})" for names in (_MONTHS, [m[:3] for m in _MONTHS]))
# Month before day where a number may be either.
_DATES = [
    *(s.join(parts) for parts in ((_YEAR, _MONTH, _DAY), (_MONTH, _DAY, _YEAR), (_DAY, _MONTH, _YEAR)) for s in ("-", "/", r"\.")),
    *(text for m in (_LONG, _SHORT) for text in (f"{m} {_DAY}, {_YEAR}", f"{m} {_DAY} {_YEAR}", f"{_DAY} {m} {_YEAR}", f"{_DAY}-{m}-{_YEAR}")),
    _YEAR + _MONTH + _DAY, f"{_YEAR}-{_MONTH}", _YEAR,
]
_HOUR, _SIXTY = "(?:2[0-3]|[01][0-9]|[0-9])", "[0-5]?[0-9]"
_ZONE = "(?:Z|[+-][0-9]{2}:?[0-9]{2})"
_TIMES = [
    "", *(f"{sep}{_HOUR}:{_SIXTY}{rest}{zone}" for sep in (" ", "T") for rest in ("", f":{_SIXTY}", rf":{_SIXTY}\.[0-9]{{1,9}}") for zone in ("", _ZONE)),
]


@dataclass(frozen=True)
class Layout:
    """How a date is written: a regular expression with the groups y, and m and d where there are such."""

    pattern: str

    def column(self, text: Column) -> Column:
        """Text of this layout as DATE; other text, and days that no month has, become null."""
        whole = rf"\A(?i:{self.pattern})\z"
        order = sorted((self.pattern.index(f"(?<{g}>"), g) for g in "ymd" if f"(?<{g}>" in self.pattern)
        at = {g: i for i, (_, g) in enumerate(order, 1)}

        def part(group: str) -> Column:
            return F.regexp_extract(text, whole, at[group]) if group in at else F.lit("1")

        month = part("m")
        if "January" in self.pattern or "Jan" in self.pattern:
            month = (F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.left(month, F.lit(3)))) + 2) / 3
            month = month.cast("int").cast("string")
        # try_to_date checks the day of the month.
        read = F.try_to_date(F.concat_ws("-", part("y"), month, part("d")), "yyyy-M-d")
        return F.when(F.rlike(text, F.lit(whole)), read)


def layout_of(text: str | None) -> Layout | None:
    """The first known layout that reads a text, None if none does."""
    for date in _DATES if text is not None else ():
        for time in _TIMES:
            found = re.fullmatch((date + time).replace("(?<", "(?P<"), text)
            if found and _is_day(**found.groupdict()):
                return Layout(date + time)
    return None


def _is_day(y: str, m: str = "1", d: str = "1") -> bool:
    month = int(m) if m.isdigit() else next(i for i, name in enumerate(_MONTHS, 1) if name.startswith(m))
    try:
        return bool(datetime.date(int(y), month, int(d)))
    except ValueError:
        return False


def any_layout(text: Column) -> Column:
    """Each text by its own layout: what is left to do where the first value has none."""
    return F.coalesce(*(Layout(date + f"(?:{'|'.join(_TIMES[1:])})?").column(text) for date in _DATES))


def first_layout(df: DataFrame, name: str, order: Sequence[Column]) -> Layout | str:
    """The layout of the column's first non-null value in ``order``, or ``each`` if it has none that is known.

    One aggregate over the column and its order; a single value reaches the driver.
    """
    text = F.col(name).cast("string")
    first = df.where(text.isNotNull()).agg(F.min_by(text, F.struct(*order)).alias("text")).first().text
    return layout_of(first) or "each"
