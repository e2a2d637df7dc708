"""Casts that give NULL for bad values under any ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns keep junk away from the casts: try_cast gives NULL for it too, but
# by way of an exception per value, which costs far more than the match.
# Up to 18 digits after leading zeros fit a bigint.
INTEGER_PART = r"^[+-]?(0*[0-9]{1,18}([.][0-9]*)?|[.][0-9]+)$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INT_LOW, INT_HIGH = -(2**31), 2**31 - 1
STARTS_WITH_YEAR = r"^[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}([ T].*)?)?)?$"
TIME_ONLY = r"^[0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]+)?)?$"


def _to_int(value: Column, source: T.DataType) -> Column:
    """Truncate towards zero; NULL when it does not fit."""
    if isinstance(source, T.StringType):
        text = F.trim(value)
        digits = F.substring_index(text, ".", 1)
        whole = F.when(text.rlike(INTEGER_PART), F.when(digits.isin("", "+", "-"), "0").otherwise(digits))
        number = whole.try_cast("bigint")
    elif isinstance(source, T.NumericType):
        number = value
    else:
        return value.try_cast("int")
    # NaN is greater than any number, so it does not fit either.
    return F.when((number > INT_LOW - 1) & (number < INT_HIGH + 1), number).try_cast("int")


def _to_timestamp(value: Column, source: T.DataType, time_anchor: Column | None) -> Column:
    """Only text that starts with a four-digit year is a timestamp.

    A time of day alone has no date: it is NULL unless ``time_anchor`` gives the
    date to put it on. Without the pattern a text such as ``131500`` would be
    read as a year.
    """
    if not isinstance(source, T.StringType):
        return value.try_cast("timestamp")
    text = F.trim(value)
    stamp = F.when(text.rlike(STARTS_WITH_YEAR), text)
    if time_anchor is not None:
        anchored = F.concat_ws(" ", time_anchor.cast("date").cast("string"), text)
        stamp = F.coalesce(stamp, F.when(text.rlike(TIME_ONLY), anchored))
    return stamp.try_cast("timestamp")


def to_contract_type(
    value: Column,
    source: T.DataType,
    target: str,
    time_anchor: Column | None = None,
) -> Column:
    """Cast ``value`` of type ``source`` to ``target``; unreadable values give NULL."""
    if target == "int":
        return _to_int(value, source)
    if target == "timestamp":
        return _to_timestamp(value, source, time_anchor)
    if target.startswith("decimal") and isinstance(source, T.StringType):
        text = F.trim(value)
        return F.when(text.rlike(NUMBER), text).try_cast(target)
    return value.try_cast(target)
