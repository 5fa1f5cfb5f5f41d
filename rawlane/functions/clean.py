"""Brazilian number and date formats to typed columns.

Rows are independent of each other: the result of a cell never depends on its neighbours. Where a general-purpose
reader would guess a date format from the data, a fixed list of formats is tried instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Month abbreviations, January to December.
MONTHS = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")

# Two-digit years up to this one belong to the 2000s, later ones to the 1900s.
LAST_YEAR_OF_2000S = 68

# First and last whole day a 64-bit nanosecond timestamp can hold.
MIN_DATE = "1677-09-22"
MAX_DATE = "2262-04-11"


# Texts that are rewritten to year-month-day, tried one after the other. Two-digit years up to LAST_YEAR_OF_2000S come
# first; a time of day is dropped, and a day with a zone is the day as written, not moved to another zone. The last pattern empties whatever is not a year-month-day text by then.
_REWRITES = (
    (r"^(\d{1,2}([/.-])\d{1,2}\2(?:\d{4}|\d{2}))[ Tt]([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,9})?)?$", "$1"),
    (r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})$", "$4-$3-$1"),
    (r"^(\d{1,2})([/-])(\d{1,2})\2([0-5]\d|6[0-8])$", "20$4-$3-$1"),
    (r"^(\d{1,2})([/-])(\d{1,2})\2(\d{2})$", "19$4-$3-$1"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4}-\d{2}-\d{2})[ Tt]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})?$", "$1"),
    (r"(?s)^(?!\d{4}-\d{1,2}-\d{1,2}$).*$", ""),
)


def parse_number(text: Column, target: T.DataType) -> Column:
    """``1.000,50`` style text (already stripped) to a number; NULL where the text is not a number.

    Dots are always thousands marks, a lone dash is zero, and infinities are not numbers.
    """
    plain = F.when(text == "-", F.lit("0")).otherwise(F.translate(text, ",.", "."))
    if isinstance(target, T.DecimalType):
        return plain.try_cast(target)
    # Floating targets would accept words such as "Infinity", suffixes such as "1d" and numbers out of range.
    value = plain.try_cast(target)
    return F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") & (F.abs(value) != float("inf")), value)


def day_month_year(text: Column) -> Column:
    """``jan/2024``, in any case, as ``1/1/2024``; other text (already stripped) as it is."""
    starts = F.create_map(*[F.lit(x) for number, name in enumerate(MONTHS, start=1) for x in (f"{name}/", f"1/{number}/")])
    start = F.try_element_at(starts, F.lower(F.substring(text, 1, 4)))
    # Looked up only where the fourth character says that there may be a month name.
    return F.when(
        (F.substring(text, 4, 1) == "/") & start.isNotNull(),
        F.concat(start, F.split_part(text, F.lit("/"), F.lit(2))),
    ).otherwise(text)


def parse_date(text: Column) -> Column:
    """Date text from ``day_month_year`` to DATE; NULL where no known format fits or the day is impossible.

    The text is rewritten to ``yyyy-M-d`` and cast once. The usual format is cut up by position; only other texts pay
    for the rewrites. The expressions are kept few, since a table has many date columns and generated code must stay
    small enough to be compiled.
    """
    year, month, day = F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)
    other = text
    for pattern, replacement in _REWRITES:
        other = F.regexp_replace(other, pattern, replacement)
    usual = text.rlike(r"^\d\d/\d\d/\d{4}$")
    return F.when(usual, F.concat_ws("-", year, month, day)).otherwise(other).try_cast("date")


def in_date_range(day: Column) -> Column:
    """The day itself, or NULL outside the supported range."""
    return F.when(day.between(dt.date.fromisoformat(MIN_DATE), dt.date.fromisoformat(MAX_DATE)), day)
