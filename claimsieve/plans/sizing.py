"""Task sizes for the full job, from the bytes that lie in the input folder.

Shuffle partitions are planned before their size is known; adaptive execution can merge small ones but not cut large
ones. The targets are parameters: the driver tracks splits x shuffle partitions, so whoever runs an input of hundreds of
terabytes with a small driver raises them, and sees the tasks grow for it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from claimsieve.sources.readers import staged_files

MIB = 1 << 20
SHUFFLE_TARGET = 256 * MIB
SPLIT_TARGET = 128 * MIB


def input_bytes(spark: SparkSession, path: str) -> int:
    return staged_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def task_sizes(size: int, shuffle_target: int = SHUFFLE_TARGET, split_target: int = SPLIT_TARGET) -> dict[str, int]:
    """Shuffle partitions and bytes per input split for an input of `size` bytes."""
    return {
        "spark.sql.shuffle.partitions": max(1, math.ceil(size / shuffle_target)),
        "spark.sql.files.maxPartitionBytes": split_target,
    }


def _number(text: str) -> int | None:
    digits = text.lower().removesuffix("b")
    return int(digits) if digits.isdigit() else None


@contextmanager
def sized_tasks(
    spark: SparkSession, path: str, shuffle_target: int = SHUFFLE_TARGET, split_target: int = SPLIT_TARGET
) -> Iterator[None]:
    """Raise the session's settings to what the input needs, and put them back afterwards. Larger ones stay."""
    before = {}
    try:
        for key, wanted in task_sizes(input_bytes(spark, path), shuffle_target, split_target).items():
            current = _number(spark.conf.get(key))
            if current is not None and wanted > current:
                before[key] = spark.conf.get(key)
                spark.conf.set(key, str(wanted))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
