"""SRC-04: CSV whose quoted values may hold line breaks, each file read by many tasks, in one pass over its bytes.

The text source splits a file at line feeds, whatever they end. Quotes within a value are doubled, so a line with an odd
number of quotes turns "inside a value" round and one with an even number keeps it. A window adds the turns up within a
split of the file; the sums of the splits, a row each, are composed in the order of the file and tell how each split
begins. A line that begins outside all values begins a record. Records of one line are parsed where they are; the others
are put together first, also across splits. The source is scanned once: both branches of the query read the same shuffle
of the lines, which are dealt out by split, so that no group outgrows one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE_FEED = "\n"
QUOTE = '"'
# as the delimited sink writes: quotes doubled, line breaks of a value kept as they are
DIALECT = {"escape": QUOTE, "multiLine": "true", "lineSep": LINE_FEED}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block, id, turn (1: the state turns round) and state (turns of the split before the line, modulo 2)."""
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    read = spark.read.option("lineSep", LINE_FEED).text(path)
    cut = read.select("value", file, block, F.monotonically_increasing_id().alias("id"))
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))
    before = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2
    return cut.withColumn("turn", quotes % 2).withColumn("state", state)


def split_starts(found: DataFrame) -> DataFrame:
    """Per split of a file: its state at the start, the record that it begins in (the split and number of its first
    line), and whether the file ends outside all values."""
    splits = found.groupBy("file", "block").agg(
        (F.sum("turn") % 2).alias("turn"),
        F.count_if(F.col("state") == 0).alias("begun0"),
        F.count_if(F.col("state") == 1).alias("begun1"),
        F.sum(F.length("value")).alias("characters"),
    )
    # asking for the text keeps this branch's shuffle the same as that of the records, so it is read and not made again
    splits = splits.filter(F.col("characters") >= 0)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = splits.withColumn("start", F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2)
    number = F.when(F.col("start") == 0, F.col("begun0")).otherwise(F.col("begun1"))
    holds = started.withColumn("number", number).withColumn("holds", F.when(F.col("number") > 0, F.struct("block", "number")))
    begun = F.last("holds", ignorenulls=True).over(before)
    return holds.select(
        *("file", "block", "start"),
        (F.sum("turn").over(Window.partitionBy("file")) % 2 == 0).alias("closed"),
        begun["block"].alias("begun_block"),
        begun["number"].alias("begun_number"),
    )


def records(found: DataFrame, starts: DataFrame) -> DataFrame:
    """file, text and `header` (the first record of its file) of every record; blank lines are none.

    A file that ends inside a value stops the job before its lines are put together: its last record has no end.
    """
    upto = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    known = found.join(starts, ["file", "block"]).withColumn("opens", F.col("state") == F.col("start"))
    numbered = known.withColumn("number", F.count_if("opens").over(upto))
    own = F.col("number") > 0
    open_end = F.raise_error(F.concat(F.lit("a quoted value has no end: "), F.col("file")))
    keyed = numbered.select(
        *("file", "block", "id"),
        F.when(F.col("closed"), F.col("value")).otherwise(open_end).alias("value"),
        (F.col("opens") & (F.col("turn") == 0)).alias("alone"),
        F.when(own, F.col("block")).otherwise(F.col("begun_block")).alias("begun_block"),
        F.when(own, F.col("number")).otherwise(F.col("begun_number")).alias("begun_number"),
    )
    header = ((F.col("begun_block") == 0) & (F.col("begun_number") == 1)).alias("header")
    whole = keyed.filter(F.col("alone") & (F.col("value") != "")).select("file", F.col("value").alias("text"), header)
    parts = F.sort_array(F.collect_list(F.struct("block", "id", "value")))
    joined = keyed.filter(~F.col("alone")).groupBy("file", "begun_block", "begun_number").agg(parts.alias("parts"))
    return whole.unionByName(joined.select("file", F.array_join("parts.value", LINE_FEED).alias("text"), header))


def _values(columns: Sequence[str]) -> Column:
    names = ["`" + name.replace("`", "``") + "`" for name in columns]
    return F.from_csv("text", ", ".join(f"{name} string" for name in names), DIALECT)


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The rows of headed CSV files, every column text; an empty value is null, quoted or not.

    Every file begins with the header `columns`; another one stops the job. A row with too few values is filled with
    nulls and surplus values are cut. A file without a byte has no rows.
    """
    found = lines(spark, path)
    read = records(found, split_starts(found)).withColumn("row", _values(columns))
    names = F.array(*(F.lit(name) for name in columns))
    given = F.array(*(F.col("row").getField(name) for name in columns))
    other = F.raise_error(F.concat(F.lit("another header: "), F.col("file")))
    # a header is never a row, and one that differs is an error
    is_row = F.when(~F.col("header"), True).when(given == names, False).otherwise(other.cast("boolean"))
    return read.filter(is_row).select("row.*")
