"""Cleansing rules (SC-01..14). Invalid text becomes null; nothing here raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from claimsieve.functions import fixed_values as fixed


def named(column: str) -> Column:
    """A column by its exact name, which may hold blanks."""
    return F.col(f"`{column}`")


def blank_to_null(value: Column, null_tokens: Sequence[str] = ()) -> Column:
    """SC-11: blank text becomes null; other values keep their type and their outer blanks."""
    text = F.trim(value.cast("string"))
    missing = text == ""
    if null_tokens:
        missing = missing | text.isin(*null_tokens)
    return F.when(missing, None).otherwise(value)


def load_nulls(value: Column) -> Column:
    """SRC-04: the exact texts that mean null in delimited files."""
    return F.when(value.isin(*fixed.LOAD_NULL_TOKENS), None).otherwise(value)


def trimmed(value: Column) -> Column:
    """SC-01; blanks only, a tab stays."""
    return F.trim(value.cast("string"))


def titled(value: Column) -> Column:
    """SC-02: words are split at blanks, the rest of each word is lower-cased."""
    return F.initcap(trimmed(value))


def uppered(value: Column) -> Column:
    """SC-03."""
    return F.upper(trimmed(value))


def whole_number(value: Column, width: str = "int") -> Column:
    """SC-05: text to integer; a plain fraction is cut off, anything else that is no number is null.

    The pattern (SC-12) keeps other text away from the cast, which handles it by way of an
    exception per value.
    """
    digits = F.regexp_extract(value.cast("string"), r"^\s*([+-]?[0-9]+)(?:\.[0-9]*)?\s*\z", 1)
    return F.nullif(digits, F.lit("")).try_cast(width)


def number_id(value: Column) -> Column:
    """SC-05 for ids, which outgrow 32 bits on large tables."""
    return whole_number(value, "bigint")


def safe_decimal(value: Column, precision: int = fixed.MONEY[0], scale: int = fixed.MONEY[1]) -> Column:
    """SC-06: drops thousands commas; half-up to `scale`; null when not a number or too large."""
    return F.replace(value.cast("string"), F.lit(","), F.lit("")).try_cast(DecimalType(precision, scale))


def strict_date(value: Column) -> Column:
    """SC-07: `yyyy-MM-dd` with two-digit month and day, or null.

    A shape check and a cast give the dates of `try_to_date(value, "yyyy-MM-dd")` at a fraction of
    the cost of its formatter.
    """
    text = value.cast("string")
    return F.when(text.rlike(fixed.DATE_SHAPE), text.try_cast("date"))


def decode(value: Column, table: Sequence[tuple[Sequence[str], str]], other: str) -> Column:
    """Code to label, ignoring case and outer blanks; null and unknown codes give `other`."""
    code = uppered(value)
    first, *rest = table
    label = F.when(code.isin(*first[0]), F.lit(first[1]))
    for codes, text in rest:
        label = label.when(code.isin(*codes), F.lit(text))
    return label.otherwise(F.lit(other))


def gender(value: Column) -> Column:
    """SC-08."""
    return decode(value, fixed.GENDER, fixed.GENDER_OTHER)


def claim_status(value: Column) -> Column:
    """SC-09."""
    return decode(value, fixed.CLAIM_STATUS, fixed.CLAIM_STATUS_OTHER)


def group_type(value: Column) -> Column:
    """SC-10."""
    return decode(value, fixed.GROUP_TYPE, fixed.GROUP_TYPE_OTHER)


def money_or_zero(value: Column) -> Column:
    """SC-13 for amounts: the typed money column, null counted as zero."""
    return F.coalesce(value.cast(DecimalType(*fixed.MONEY)), F.lit(0).cast(DecimalType(*fixed.MONEY)))


def contains_ignoring_case(value: Column, text: str) -> Column:
    """FLT-04 / SC-18: null does not match."""
    return F.upper(value).contains(text.upper())
