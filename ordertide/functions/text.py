"""Keys, padded ids and shortened payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD_CHARS = 256


def order_id(biz_key: Column) -> Column:
    """Digits after the last dash (or the whole text) as a bigint, else null."""
    tail = F.substring_index(biz_key, "-", -1)
    return F.when(tail.rlike("^[+]?[0-9]+$"), tail.try_cast("bigint"))


def padded_id(prefix: str, number: Column) -> Column:
    """``prefix`` plus the number padded to ten digits; longer numbers stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(10), F.length(digits)), "0"))


def head(value: Column) -> Column:
    """K9: the first 256 characters, enough to recognise a bad message."""
    return F.left(value, F.lit(HEAD_CHARS))


def plain_amount(amount: Column) -> Column:
    """Decimal -> plain digits, never in scientific notation."""
    return amount.cast("string")
