"""What several operators need: reading the tables, storing steps in the shared folder, labels."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimsieve.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: later steps read it whichever executors are lost."""
    path = scratch_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(pdfs: Iterator[pd.DataFrame], text: str, size: int) -> Iterator[pd.DataFrame]:
    """The batches of a task cut where their texts pass `size` characters; a longer text is a block of its own."""
    for pdf in pdfs:
        pdf = pdf.reset_index(drop=True)
        if len(pdf):
            lengths = pdf[text].fillna("").str.len()
            for _, part in pdf.groupby((lengths.cumsum() - lengths) // size, sort=False):
                yield part
            release()


def release() -> None:
    """Hands freed memory back to the system: a Python worker outlives its task and would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim:
        trim(0)


def crc_of_id(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string"))


def sampled_labels(labels: DataFrame, label: str, training, per_class: int) -> DataFrame:
    """(doc_id, label) of at most `per_class` training ids of each class, the first by hash of the id.

    Ids with a null or with contradicting labels teach nothing and are left out. `training` is a condition on doc_id.
    """
    clear = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & training)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("highest"))
        .filter(F.col("label") == F.col("highest"))
        .select("doc_id", "label")
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    classes = [clear.filter(F.col("label") == value).orderBy(*order).limit(per_class) for value in (0, 1)]
    return classes[0].unionByName(classes[1])


MARK_BITS = 1 << 22


def marked(df: DataFrame, key, keys: DataFrame, keys_key, bits: int = MARK_BITS) -> tuple[DataFrame, F.Column]:
    """`df` with the marks that `keys` set, and the condition that a row of `df` hits one.

    Every key sets one of `bits` marks by its hash. The marks are broadcast as 64-bit words, 1 MB at most by default,
    however many keys there are. A row without a hit is surely not among the keys; one with a hit has to be compared.
    """

    def place(hashed):
        return F.pmod(hashed, F.lit(bits))

    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place(keys_key) % 64).cast("int"))
    set_bits = keys.select(F.shiftright(place(keys_key), 6).alias("mark word"), set_bit.alias("mark bit"))
    words = set_bits.groupBy("mark word").agg(F.bit_or("mark bit").alias("mark bits"))
    with_word = df.withColumn("mark word", F.shiftright(place(key), 6)).join(F.broadcast(words), "mark word", "left")
    hit = F.coalesce(F.getbit("mark bits", (place(key) % 64).cast("int")) == 1, F.lit(False))
    return with_word, hit


def numbered(df: DataFrame, *order) -> DataFrame:
    """`df` as a stored table with `place`: the number of each row in the order, from 0.

    Rows are dealt out by ranges of the order and sorted there; a place is the rows of the ranges before and the row's
    number in its range. Nothing but a row per range goes to a single task, and the broadcast holds as many rows: no
    more than the session has shuffle partitions. `order` must set rows of a hot key apart, or they share a range.
    """
    runs = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id counts the rows of a partition in its low 33 bits and the partitions above them
    kept = stored(runs.withColumn("place", F.monotonically_increasing_id()))
    run = F.shiftright("place", 33).alias("run")
    sizes = kept.groupBy(run).agg(F.count("*").alias("rows"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows ahead"))
    counted = kept.select("*", run).join(F.broadcast(ahead), "run")
    own = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return counted.withColumn("place", F.col("rows ahead") + own).select(*df.columns, "place")
