"""Cleaning rules for untyped source text.

The `lenient_*` rules turn unreadable text into NULL. The `strict_*` rules fail the job
on it, whether or not the session runs in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
GENDER_CODES = ("M", "F")
UNKNOWN_GENDER = "U"
DIGITS_ONLY = r"\A[0-9]+\z"
SLASH_DATE = "yyyy/M/d"
PLAIN_DATE = r"\A[1-9][0-9]{3}/[0-9]{1,2}/[0-9]{1,2}\z"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def age_canon(label: Column) -> Column:
    """`0~2` and `0-2` are one age band."""
    return F.replace(label, F.lit("~"), F.lit("-"))


def norm_gender(code: Column) -> Column:
    """Anything but a known code, NULL included, is the unknown gender."""
    return F.when(code.isin(*GENDER_CODES), code).otherwise(F.lit(UNKNOWN_GENDER))


def flag(text: Column, yes: str) -> Column:
    return text == F.lit(yes)


def lenient_int(text: Column) -> Column:
    """Whole numbers, also in decimal or exponent notation; fractions are rounded half away from zero."""
    trimmed = F.trim(text)
    # Nearly all texts are those of an int, and are read as such; a decimal costs more than the rest of a row.
    plain = trimmed.try_cast("int")
    number = F.round(trimmed.try_cast("decimal(38,18)")).try_cast("int")
    return F.when(plain.cast("string") == trimmed, plain).otherwise(number)


def lenient_double(text: Column) -> Column:
    return blank_to_null(text).try_cast("double")


def _strict(text: Column, parsed: Column, to: str) -> Column:
    """`parsed`, but a present text that did not parse fails the job."""
    failure = F.raise_error(F.concat(F.lit(f"malformed {to}: "), text.cast("string")))
    return F.coalesce(parsed, F.when(text.isNotNull(), failure).cast(to))


def strict_cast(value: Column, to: str) -> Column:
    return _strict(value, value.try_cast(to), to)


def strict_slash_date(text: Column) -> Column:
    """`2015/9/1`, padded or not, to a date."""
    trimmed = F.trim(text)
    # A cast reads the same date in a third of the time, but reads other texts too.
    plain = F.when(trimmed.rlike(PLAIN_DATE), F.replace(trimmed, F.lit("/"), F.lit("-")).try_cast("date"))
    return _strict(text, F.coalesce(plain, F.try_to_date(trimmed, SLASH_DATE)), "date")


def optional_slash_date(text: Column) -> Column:
    """As above, with the empty string for a missing date."""
    return strict_slash_date(blank_to_null(text))


def age_bounds(label: Column) -> tuple[Column, Column]:
    """Inclusive bounds of a canonical age band.

    `30-34` has both, `65+` no upper one, `0` the same twice, free text none. A band
    whose bounds are not numbers fails the job.
    """
    single = label.rlike(DIGITS_ONLY)
    open_ended = label.endswith("+")
    band = label.contains("-")

    def part(n: int) -> Column:
        return F.split_part(label, F.lit("-"), F.lit(n))

    lower = F.when(single, label).when(open_ended, F.rtrim(label, F.lit("+"))).when(band, part(1))
    upper = F.when(single, label).when(~open_ended & band, part(2))
    return strict_cast(lower, "smallint"), strict_cast(upper, "smallint")
