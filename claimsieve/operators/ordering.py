"""ST-01..03: orders with the null position always spelled out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_columns(order: Sequence[str]) -> list[Column]:
    """`"-name"` is descending with nulls first, `"name"` ascending with nulls last."""
    return [
        F.col(name[1:]).desc_nulls_first() if name.startswith("-") else F.col(name).asc_nulls_last() for name in order
    ]


def ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_columns(order)) if order else df


def top_k(df: DataFrame, order: Sequence[str], k: int | None) -> DataFrame:
    """The first `k` rows; sort and limit in one plan, so each task keeps only `k` rows."""
    sorted_rows = ordered(df, order)
    return sorted_rows if k is None else sorted_rows.limit(k)
