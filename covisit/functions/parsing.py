"""Column expressions that read loosely formatted text without ever failing a job.

All of them stay inside the JVM and give null for what they cannot read, under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
LIST_SEPARATOR = r"\s*,\s*"
LAST_EPOCH_SECOND = 9_999_999_999  # a larger epoch number counts milliseconds
DAY_PATTERN = "yyyyMMdd"
# ----------------------------------------------------------------------------------------

# whole seconds that still fit a microsecond timestamp
_TIMESTAMP_SECONDS = 9_223_372_036_854
# and milliseconds
_TIMESTAMP_MILLIS = 9_223_372_036_854_775

# optional sign, optional digits, a point and whatever digits follow it
_FRACTION = r"^\s*(?<sign>[+-]?)(?<whole>[0-9]*)\.[0-9]*\s*$"


def whole_number(text: Column, to: str = "bigint") -> Column:
    """Text to an integer type, fractions cut off; null if it is no number or does not fit.

    Exponents are not numbers here ("1e3" is null). The fraction goes as text, so that no
    digit of a 64-bit id is lost to a floating-point or decimal detour, and only for text that
    is not a plain number already.
    """
    without_fraction = F.regexp_replace(text, _FRACTION, "${sign}0${whole}")
    return F.coalesce(text.try_cast(to), without_fraction.try_cast(to))


def spaced_number(text: Column, to: str = "bigint") -> Column:
    """``whole_number`` that also overlooks blanks between the digits."""
    return whole_number(F.regexp_replace(text, r"\s", ""), to)


def split_list(text: Column, keep_blanks: bool = False) -> Column:
    """A comma list to an array of trimmed elements; a missing list is an empty one.

    Blank elements are dropped, which moves later elements forward. ``keep_blanks`` leaves
    null in their place instead, so positions hold.
    """
    split = F.split(F.coalesce(text, F.lit("")), LIST_SEPARATOR)
    parts = F.transform(split, lambda part: F.trim(part))
    if not keep_blanks:
        return F.filter(parts, lambda part: part != "")
    nothing = F.trim(F.coalesce(text, F.lit(""))) == ""
    return F.when(nothing, F.array().cast("array<string>")).otherwise(
        F.transform(parts, lambda part: F.nullif(part, F.lit("")))
    )


def epoch(number: Column, precision: str = "s") -> Column:
    """Epoch seconds or milliseconds, told apart by size, to a timestamp.

    The result is in whole seconds; ``precision="ms"`` keeps milliseconds. Numbers past the
    range of a timestamp are null.
    """
    if precision not in ("s", "ms"):
        raise ValueError(f"precision must be 's' or 'ms', not {precision!r}")
    in_millis = number > F.lit(LAST_EPOCH_SECOND)
    seconds = F.when(in_millis, F.call_function("div", number, F.lit(1000))).otherwise(number)
    fits = seconds.between(F.lit(-_TIMESTAMP_SECONDS), F.lit(_TIMESTAMP_SECONDS))
    if precision == "s":
        return F.timestamp_seconds(F.when(fits, seconds))
    millis = F.when(in_millis & (number <= F.lit(_TIMESTAMP_MILLIS)), number)
    whole = F.when(~in_millis & fits, number)
    return F.coalesce(F.timestamp_millis(millis), F.timestamp_seconds(whole))


def instant(text: Column, precision: str = "s", number: Column | None = None) -> Column:
    """An epoch or ISO text to a timestamp. Any number is an epoch, even one that looks like a
    date. ``number`` may pass in ``whole_number(text)`` where it is a column already."""
    number = whole_number(text) if number is None else number
    return F.coalesce(epoch(number, precision), text.try_cast("timestamp"))


def day_start(label: Column) -> Column:
    """A yyyyMMdd label to midnight of that day; null if it is none."""
    return F.try_to_timestamp(label, F.lit(DAY_PATTERN))
