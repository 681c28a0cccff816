"""DQ-01 and DQ-02: null profile and duplicate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsieve.functions.rules import named


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """AG-06: one row with the null count of every column, from a single pass."""
    counts = [F.count_if(named(name).isNull()).alias(name) for name in df.columns]
    return df.agg(*counts).withColumn("dataset_name", F.lit(dataset))


def null_profile_long(df: DataFrame, dataset: str) -> DataFrame:
    """The same, one row per column, so that profiles of different tables stack."""
    wide = null_profile(df, dataset)
    return wide.unpivot("dataset_name", [named(name) for name in df.columns], "column_name", "null_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str], dataset: str) -> DataFrame:
    """AG-07 / FLT-08: keys that occur more than once; null keys count as equal."""
    counts = df.groupBy(*(named(key) for key in keys)).agg(F.count("*").alias("count"))
    return counts.filter(F.col("count") > 1).withColumn("dataset_name", F.lit(dataset))


def duplicate_keys_long(df: DataFrame, keys: Sequence[str], dataset: str) -> DataFrame:
    """The same with the key as one JSON text, so that audits of different tables stack."""
    text = F.to_json(F.struct(*(named(key).cast("string").alias(key.strip()) for key in keys)))
    return duplicate_keys(df, keys, dataset).select("dataset_name", text.alias("duplicate_key"), "count")


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def null_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stacked([null_profile_long(df, dataset) for dataset, df in tables.items()])


def duplicate_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return stacked([duplicate_keys_long(df, keys[dataset], dataset) for dataset, df in tables.items()])
