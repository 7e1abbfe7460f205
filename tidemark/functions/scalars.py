"""Scalar expressions on text, dates and numbers."""

from __future__ import annotations

import datetime as dt
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that survive text cleaning. The blanks are those
# that Python's ``\s`` matches in text, spelled out because Java's set differs.
KEPT_LATIN = (
    string.ascii_letters + string.digits
    + " \\x{9}\\x{a}\\x{b}\\x{c}\\x{d}\\x{1c}\\x{1d}\\x{1e}\\x{1f}\\x{85}\\x{a0}" + ".,!?;:()\"'-"
)
KEPT_OTHER = "А-яЁё\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
# Single Latin characters in a class of their own are one bit test in Java, and most text ends there.
DROPPED_SYMBOLS = f"[^[{KEPT_LATIN}][{KEPT_OTHER}]]"


def joined(*columns: Column) -> Column:
    """Concatenation; NULL as soon as one part is NULL."""
    return F.concat(*columns)


def hash_key(*columns: Column) -> Column:
    """MD5 of the bare concatenation; NULL as soon as one part is NULL."""
    return F.md5(F.concat(*columns))


def hash_key_delimited(*columns: Column) -> Column:
    """MD5 with a delimiter between parts, so neighbouring values cannot run together."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns]))


def first_letter_up(column: Column) -> Column:
    """First letter upper, the rest lower, whatever blanks the text holds."""
    return F.concat(
        F.upper(F.substring(column, 1, 1)),
        F.lower(column.substr(F.lit(2), F.length(column))),
    )


def strip_symbols(column: Column) -> Column:
    """Delete every character outside the kept set; a missing text becomes empty."""
    return F.coalesce(F.regexp_replace(column, DROPPED_SYMBOLS, ""), F.lit(""))


def fill_missing(df: DataFrame, filler: str = "-") -> DataFrame:
    """Every column as text, with ``filler`` where a value is missing."""
    return df.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(filler)).alias(c) for c in df.columns])


def day_text(column: Column) -> Column:
    """First ten characters of a text timestamp; a missing one gives the empty text."""
    return F.coalesce(F.substring(column.cast("string"), 1, 10), F.lit(""))


def age_years(as_of: Column | dt.date, birthday: Column) -> Column:
    """Completed years between ``birthday`` and ``as_of``."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    not_yet = (F.month(as_of) < F.month(birthday)) | (
        (F.month(as_of) == F.month(birthday)) & (F.dayofmonth(as_of) < F.dayofmonth(birthday))
    )
    return F.year(as_of) - F.year(birthday) - not_yet.cast("int")


def month_start(as_of: Column | dt.date, months_back: int = 0) -> Column:
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.trunc(F.add_months(as_of, -months_back), "MM")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def moment(value: dt.datetime) -> Column:
    """A point in time to compare a column with: a naive value is wall-clock time, whatever the machine's zone."""
    if value.tzinfo is not None:
        return F.lit(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def days_over(start: Column, stop: Column, allowed_days: Column) -> Column:
    """Whole days by which ``stop - start`` exceeds the allowed days; 0 if it does not, or is open."""
    excess = (stop - start) - F.make_dt_interval(days=allowed_days.cast("int"))
    return F.greatest(F.coalesce(F.extract(F.lit("DAY"), excess), F.lit(0)), F.lit(0)).cast("long")


def whole_number(column: Column) -> Column:
    """Text to a whole number, rounded; text that is no number gives NULL."""
    return column.try_cast("decimal(38,0)")


def us_date(column: Column) -> Column:
    """``month/day/year`` text to a date, one or two digits; other text gives NULL."""
    return F.try_to_date(column, "M/d/yyyy")


def greatest_or_null(a: Column, b: Column) -> Column:
    """The larger value; NULL if either is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def rounded(column: Column, digits: int = 2) -> Column:
    """Half away from zero on the decimal value."""
    return F.round(column.cast("decimal(28,10)"), digits)


def percent_text(fraction: Column) -> Column:
    return F.concat(F.format_number(fraction * 100, 2), F.lit("%"))


def fixed_text(column: Column, digits: int = 1) -> Column:
    return F.format_number(column, digits)


# What the two jobs report.
SILVER_MESSAGE, GOLD_MESSAGE = "Processed %d rows into Silver.", "Gold Layer Updated. Rows merged: %d"


def silver_message(n: int) -> str:
    return SILVER_MESSAGE % n


def gold_message(n: int) -> str:
    return GOLD_MESSAGE % n
