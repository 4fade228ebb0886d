"""Text expressions with the split and number-parsing rules of the line formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped around a number, and accepted spellings of one.
CONTROLS = "".join(map(chr, range(0x21)))
INTEGER_PATTERN = r"^[+-]?[0-9]+\z"
DOUBLE_PATTERN = (
    r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\z"
)


def split_fields(text: Column, separator: str) -> Column:
    """Split on a one-character separator, dropping trailing empty fields.

    ``''`` gives one empty field and a text of separators only gives none.
    """
    if len(separator) != 1:
        raise ValueError("separator must be one character")
    body = F.rtrim(text) if separator == " " else F.rtrim(text, F.lit(separator))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, re.escape(separator)))
    )


def lines_of(text: Column) -> Column:
    """The lines of a whole text."""
    return F.split(text, "\n")


def parse_integer(text: Column, type_name: str = "int") -> Column:
    """Strict whole-number parse: blanks, decimals and overflow give NULL."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(type_name))


def parse_double(text: Column) -> Column:
    """Blanks and control characters (up to U+0020) around the number are dropped."""
    trimmed = F.btrim(text, F.lit(CONTROLS))
    return F.when(trimmed.rlike(DOUBLE_PATTERN), trimmed.try_cast("double"))


def require(value: Column, raw: Column, what: str) -> Column:
    """``value``, or a failed job naming the raw text when it is NULL."""
    message = F.concat(F.lit(f"cannot parse {what}: "), F.coalesce(raw, F.lit("<missing>")))
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def fail_if_prefixed(text: Column, prefix: str = "error") -> Column:
    """``text`` itself; the job fails on the first record with the prefix."""
    message = F.concat(F.lit("bad record: "), text)
    return F.when(text.startswith(prefix), F.raise_error(message)).otherwise(text)
