"""Joining a table with many rows per key to a table with one row per key, however uneven the keys.

A sort-merge join sends all rows of a key to one task. A key above 1/HOT_PARTS of all rows is therefore cut into as
many parts as it has such shares: its rows are spread over the parts and its one value is copied to each. No part holds
more than 1/HOT_PARTS of the rows, and the list of hot keys and the copies of their values stay below HOT_PARTS and
2 x HOT_PARTS rows, whatever the size of the data. The large table is read once; the engine may still turn the join into
a broadcast by size.

Where the rows per key are not known anyway, `join_even` finds the hot keys by a sketch: every task keeps the frequent
keys of its rows in a table of fixed size, tables are merged in groups and then once, and no key is shuffled. A sketch
may miss or overrate a key near the limit, which moves work about and never changes the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_PARTS = 8192
SKETCH_PARTS = 512  # keys above this share of the rows are cut by `join_even`
SKETCH_ITEMS = 8 * SKETCH_PARTS  # a table of so many items is off by less than half of that share
MERGE_GROUPS = 64


def rows_per_key(df: DataFrame, key: str, count: str = "rows") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(count))


def hot_keys(frequency: DataFrame, key: str, count: str) -> DataFrame:
    """`hot key` and `parts` of the keys, null among them, with more than 1/HOT_PARTS of all rows."""
    total = frequency.agg(F.sum(count).alias("total"))
    share = F.col(count) * HOT_PARTS / total.scalar()
    hot = frequency.select(F.col(key).alias("hot key"), F.ceil(share).cast("int").alias("parts"))
    return hot.filter(F.col("parts") > 1)


def sketched_hot_keys(many: DataFrame, key: str) -> DataFrame:
    """`hot key` and `parts` of the keys with more than 1/SKETCH_PARTS of the rows, from sketches of fixed size."""
    by_task = many.select(key).groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("group"))
    sketches = by_task.agg(
        F.call_function("approx_top_k_accumulate", F.col(key), F.lit(SKETCH_ITEMS)).alias("sketch"),
        F.count(key).alias("rows"),
    )
    # grouped by a constant: a task without rows has no sketch to hand on
    merged = sketches.groupBy(F.lit("all")).agg(
        F.call_function("approx_top_k_combine", F.col("sketch")).alias("sketch"), F.sum("rows").alias("rows")
    )
    top = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(2 * SKETCH_PARTS))
    found = merged.filter(F.col("rows") > 0).select(F.explode(top).alias("top"), "rows")
    parts = F.ceil(F.col("top.count") * SKETCH_PARTS / F.col("rows")).cast("int")
    return found.select(F.col("top.item").alias("hot key"), parts.alias("parts")).filter(F.col("parts") > 1)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's estimate of the size is within the session's limit for broadcasts."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def join_even(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of `many` with `one`, which holds each key once, evenly whatever the keys; `how` is inner or left.

    A side within the session's limit is broadcast. Otherwise the hot keys of `many` are cut; filter it first, as its
    rows are read once for the sketch and once for the join.
    """
    if fits_broadcast(one):
        return many.join(F.broadcast(one), key, how)
    return _split_join(many, one, sketched_hot_keys(many, key), SKETCH_PARTS, key, how)


def join_one_per_key(
    many: DataFrame, one: DataFrame, frequency: DataFrame, key: str, count: str, how: str = "inner", nulls: bool = False
) -> DataFrame:
    """Join of `many` with `one`, which holds each key once; `how` is inner or left.

    `frequency` counts the rows of `many` by key. With `nulls`, a null key meets the null key.
    """
    return _split_join(many, one, hot_keys(frequency, key, count), HOT_PARTS, key, how, nulls)


def _split_join(
    many: DataFrame, one: DataFrame, hot: DataFrame, most_parts: int, key: str, how: str, nulls: bool = False
) -> DataFrame:
    hot = F.broadcast(hot)
    parts = F.coalesce(F.col("parts"), F.lit(1))

    def same(left, right):
        return left.eqNullSafe(right) if nulls else left == right

    # without `nulls` a null key meets nothing, and its rows may lie anywhere
    own_parts = parts if nulls else F.when(F.col(key).isNull(), F.lit(most_parts)).otherwise(parts)
    spread = many.join(hot, same(F.col(key), F.col("hot key")), "left").withColumn(
        "part", F.when(own_parts > 1, F.pmod(F.xxhash64(*many.columns), own_parts)).otherwise(F.lit(0)).cast("int")
    )
    values = one.withColumnRenamed(key, "value key")
    copies = values.join(hot, same(F.col("value key"), F.col("hot key")), "left").withColumn(
        "value part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    matching = same(F.col(key), F.col("value key")) & (F.col("part") == F.col("value part"))
    joined = spread.drop("hot key", "parts").join(copies.drop("hot key", "parts"), matching, how)
    return joined.drop("value key", "value part", "part")
