"""SNK-02: a table in its declared columns and types, always matched by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from claimsieve.functions.rules import load_nulls, named


def conform(df: DataFrame, schema: StructType, text_input: bool = False) -> DataFrame:
    """Declared order and types; a value that does not fit its type becomes null.

    `text_input` applies the null texts of delimited files first (SRC-04).
    """
    source_types = {field.name.lower(): field.dataType for field in df.schema}
    columns = []
    for field in schema:
        value = named(field.name)
        if text_input and isinstance(source_types.get(field.name.lower()), StringType):
            value = load_nulls(value)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)
