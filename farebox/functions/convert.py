"""Conversions that turn bad input into NULL instead of failing the job.

Spark 4 runs in ANSI mode, where ``cast`` and ``to_timestamp`` raise on bad
text. Loads must survive dirty rows, so everything here uses the ``try_``
family; the caller can count what became NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The accepted boolean words.
TRUE_WORDS = ("y", "yes", "true", "1")
FALSE_WORDS = ("n", "no", "false", "0")


def blank_to_null(c: Column) -> Column:
    """Trim; an empty result is NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def to_boolean(c: Column) -> Column:
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def to_type(c: Column, data_type: T.DataType) -> Column:
    """Lenient conversion of ``c`` to ``data_type``.

    Numbers that are not finite ("NaN", "Infinity", or too large for the type) become NULL like other
    bad text: one of them would make every mean of its column useless.
    """
    if isinstance(data_type, T.BooleanType):
        return to_boolean(c)
    value = c.try_cast(data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(F.abs(value) < F.lit(float("inf")), value)
    return value


def parse_timestamp(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def timestamp_from_parts(
    year: Column,
    month: Column,
    day: Column,
    hour: Column | None = None,
    minute: Column | None = None,
    second: Column | None = None,
) -> Column:
    """Timestamp from separate parts; absent time parts are zero, an impossible date is NULL."""

    def number(part: Column | None) -> Column:
        return F.lit(0) if part is None else part.try_cast("int")

    return F.try_make_timestamp(
        number(year),
        number(month),
        number(day),
        number(hour),
        number(minute),
        number(second).cast("decimal(16,6)"),
    )


def timestamp_from_pair(day: Column, time: Column, fmt: str) -> Column:
    """Timestamp from a date text and a time text; NULL when either is missing."""
    return parse_timestamp(F.concat(day, F.lit(" "), time), fmt)


def zero_pad(code: Column, width: int) -> Column:
    """Restore leading zeros of a numeric code without cutting longer codes."""
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
