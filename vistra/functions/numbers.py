"""Numeric parsing and arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_long(value: Column | str, source_type: T.DataType | None = None) -> Column:
    """Visit id text → nullable BIGINT.

    Integer text is taken exactly; otherwise the text is read as a number
    (``'12.0'`` → 12), as the reference's float reader does. Anything else is
    NULL. Integral inputs are cast directly, never through DOUBLE.
    """
    v = _col(value)
    if isinstance(source_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return v.cast("bigint")
    return F.coalesce(v.try_cast("bigint"), v.try_cast("double").try_cast("bigint"))


def parse_person_id(value: Column | str) -> Column:
    """Person id rule: ``try_cast(trim(id) AS BIGINT)`` (``'12.0'`` → NULL)."""
    return F.trim(_col(value).cast("string")).try_cast("bigint")


def clip_between(value: Column | str, low: float, high: float) -> Column:
    """Clip a non-null value into [low, high]."""
    return F.least(F.greatest(_col(value), F.lit(float(low))), F.lit(float(high)))
