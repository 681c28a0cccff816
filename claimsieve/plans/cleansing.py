"""CL-01..08: raw text tables to clean, typed tables, driven by their TableSpec."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from claimsieve.functions.rules import blank_to_null, named
from claimsieve.operators.dedupe import one_row_per_key
from claimsieve.sources.specs import TableSpec


def normalise(raw: DataFrame, null_tokens: Sequence[str] = (), untouched: Sequence[str] = ()) -> DataFrame:
    """PRJ-03: blank to null on every column but the `untouched`, in one projection."""

    def value(column: str):
        return named(column) if column in untouched else blank_to_null(named(column), null_tokens).alias(column)

    return raw.select(*map(value, raw.columns))


def apply_rules(normalised: DataFrame, spec: TableSpec) -> DataFrame:
    """PRJ-01 / PRJ-02: rename, clean and type every field, in one projection."""
    return normalised.select(*(field.rule(named(field.raw)).alias(field.name) for field in spec.fields))


def clean(raw: DataFrame, spec: TableSpec, null_tokens: Sequence[str] = ()) -> DataFrame:
    """The whole cleaner. One shuffle, on the key.

    By default only blank text is null, so the word `NaN` in a name column stays a word;
    pass `null_tokens=("NaN",)` to treat it as missing.
    """
    return one_row_per_key(apply_rules(normalise(raw, null_tokens), spec), spec.keys)
