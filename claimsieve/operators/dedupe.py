"""AG-08 / AG-09: one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MARKS = 1 << 24


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep, per key, the smallest row by the other columns in order (ascending, nulls last).

    All null keys count as one key. The survivor does not depend on partitioning, retries or file order. The limit on
    the row number is applied before the shuffle too, so each input task ships at most one row per key: a key that holds
    a third of the table costs its reducer one row per task.
    """
    others = [F.col(name).asc_nulls_last() for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*others))
    return df.withColumn("key place", place).filter(F.col("key place") == 1).drop("key place")


def one_row_per_audited_key(df: DataFrame, keys: Sequence[str], repeated: DataFrame) -> DataFrame:
    """`one_row_per_key` with the help of a stored audit of the keys that occur more than once.

    Each repeated key sets one of MARKS marks, chosen by its hash. Rows that hit no mark have a key of their own and are
    kept without a shuffle or a sort; the rest is compared as usual. A row may hit the mark of another key, which costs
    time but changes nothing; with far more repeated keys than marks all rows are compared. The marks travel to every
    executor as 64-bit words, MARKS / 64 of them at most. Nothing runs before the result is asked for.
    """

    def with_mark(source: DataFrame) -> DataFrame:
        typed = [source[key].cast(df.schema[key].dataType) for key in keys]
        marked = source.withColumn("key mark", F.pmod(F.xxhash64(*typed), F.lit(MARKS)))
        return marked.withColumns(
            {"mark word": F.shiftright("key mark", 6), "mark bit": (F.col("key mark") % 64).cast("int")}
        )

    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("mark bit"))
    words = with_mark(repeated.select(*keys)).groupBy("mark word").agg(F.bit_or(set_bit).alias("word bits"))
    marked = with_mark(df).join(F.broadcast(words), "mark word", "left")
    hit = F.coalesce(F.getbit("word bits", F.col("mark bit")) == 1, F.lit(False))
    singles = marked.filter(~hit).select(*df.columns)
    return singles.unionByName(one_row_per_key(marked.filter(hit).select(*df.columns), keys))
