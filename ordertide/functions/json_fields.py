"""Typed reads of loosely typed JSON fields.

A message is parsed once with every field as text. That loses two things: whether a
token was quoted, and digits of very long unquoted numbers. Where they could matter,
and only there, the field is read again from the message as a variant, which keeps both.
Each reader returns null where the field is absent, null or does not fit; ``given`` tells
"does not fit" from "not there".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRUPT = "_corrupt"
# Texts that stand for the same amount whether or not they passed through a double:
# up to 15 digits, of which at most 4 after the point.
SHORT_AMOUNT = r"^-?[0-9]{1,11}([.][0-9]{1,4})?$"


def parse(value: Column, fields: Sequence[str]) -> Column:
    """Message text -> struct of field texts. The struct is null for blank text, and
    names the text in ``_corrupt`` where it is no JSON object."""
    schema = ", ".join([f"{name} string" for name in (*fields, CORRUPT)])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
    }
    return F.from_json(value, schema, options)


def is_object(message: Column) -> Column:
    return message.isNotNull() & message[CORRUPT].isNull()


def _again(value: Column, field: str, dtype: str) -> Column:
    return F.try_variant_get(F.try_parse_json(value), f"$.{field}", dtype)


def given(text: Column) -> Column:
    """True where the field holds something other than null or blanks."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def is_nested(value: Column, field: str, text: Column) -> Column:
    """True where a scalar field holds an object or an array."""
    looks_nested = F.left(text, F.lit(1)).isin("{", "[")
    kind = F.schema_of_variant(_again(value, field, "variant"))
    return F.coalesce(F.when(looks_nested, kind.rlike("^(OBJECT|ARRAY)<")), F.lit(False))


def _unless_boolean(value: Column, field: str, text: Column, dtype: str) -> Column:
    return F.when(given(text) & ~text.isin("true", "false"), _again(value, field, dtype))


def integer(value: Column, field: str, text: Column) -> Column:
    """A whole number, quoted or not. The fraction of an unquoted number is cut off."""
    return F.coalesce(text.try_cast("bigint"), _unless_boolean(value, field, text, "bigint"))


def decimal(value: Column, field: str, text: Column) -> Column:
    """A number, quoted or not, as decimal(18,4), rounded half up."""
    dtype = "decimal(18,4)"
    return F.when(text.rlike(SHORT_AMOUNT), text.try_cast(dtype)).otherwise(
        _unless_boolean(value, field, text, dtype)
    )
