"""SRC-02: bracketed arrays of objects, each file read by many tasks, in one pass over its bytes.

The text source splits a file at closing braces, whatever they close. Whether a piece begins inside a string, and how
deep, depends on all pieces before it, so a piece is described for both cases:

- an odd number of quotes turns "inside a string" round, an even one keeps it;
- what is outside the strings if the piece begins outside is inside if it begins inside, and the other way round. One
  count of brackets outside and one of all brackets give the change of depth in both cases.

Pieces are dealt out by split of their file. Windows add them up within a split, again for both cases; the sums of the
splits are composed in the order of the file, a row per split and depth. That tells how each split begins, and so which
pieces end an element of the array. Elements of one piece are parsed where they are; the others, with nested objects or
braces in values, are put together first, also across splits. The source is scanned once: all branches of the query read
the same shuffle of the pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the format.
BRACE = "}"
FIRST = r"^[\s﻿]*\[\s*\{"
FOLLOWING = r"^\s*,\s*\{"
LAST = r"^\s*\]\s*$"
NOTHING = r"^[\s﻿]*(\[\s*\]\s*)?$"
STRING = r'"[^"]*(?:"|\z)'
BEFORE_OBJECT = r"^[\s\[,﻿]+"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block and id: the text of files cut at closing braces, in the order of id within a block."""
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    read = spark.read.option("lineSep", BRACE).text(path)
    return read.select("value", file, block, F.monotonically_increasing_id().alias("id"))


def _count(text: Column, sign: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _net(text: Column) -> Column:
    """Opening less closing brackets; the closing braces are the cuts."""
    return _count(text, "{") + _count(text, "[") - _count(text, "]")


def lexed(cut: DataFrame) -> DataFrame:
    """The pieces with `turn` (1: the state turns round) and the change of depth if they begin outside or inside."""
    # a backslash and what it escapes say nothing; valid text has none before a cut
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    counted = cut.withColumn("clean", plain).withColumns(
        {
            "turn": _count(F.col("clean"), '"') % 2,
            "opened": _count(F.col("clean"), "{"),
            "squares": _count(F.col("clean"), "["),
            "closed": _count(F.col("clean"), "]"),
        }
    )
    every = F.col("opened") + F.col("squares") - F.col("closed")
    # the usual piece has one bracket, in front of all quotes: its strings need not be taken out
    usual = (F.col("opened") == 1) & (F.col("squares") + F.col("closed") == 0) & F.col("clean").rlike(FOLLOWING)
    net = F.when(usual, 1).otherwise(_net(F.regexp_replace("clean", STRING, "")))
    closes = F.col("turn") == 0  # the brace behind a piece counts where the piece ends outside
    return counted.withColumns({"net": net, "every": every}).select(
        *("value", "file", "block", "id", "turn"),
        (F.col("net") - closes.cast("int")).alias("outside"),
        (F.col("every") - F.col("net") - (~closes).cast("int")).alias("inside"),
    )


def _earlier(*keys: str, order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def placed(described: DataFrame) -> DataFrame:
    """The pieces with `begins` (the start of the split that lets them end outside: 0 outside, 1 inside), `reach` (the
    depth behind them in that case, counted from the start of the split) and the changes of depth in both cases."""
    before = _earlier("file", "block", order="id")
    turned = described.withColumn("state", _sum_before("turn", before) % 2)
    here, there = F.col("state") == 0, F.col("state") == 1
    change = {
        "change0": F.when(here, F.col("outside")).otherwise(F.col("inside")),
        "change1": F.when(there, F.col("outside")).otherwise(F.col("inside")),
    }
    changed = turned.withColumns(change).withColumns(
        {"depth0": _sum_before("change0", before), "depth1": _sum_before("change1", before)}
    )
    begins = (F.col("state") + F.col("turn")) % 2
    reach = F.when(begins == 0, F.col("depth0") + F.col("change0")).otherwise(F.col("depth1") + F.col("change1"))
    fields = "value", "file", "block", "id", "turn", "change0", "change1"
    return changed.select(*fields, begins.alias("begins"), reach.alias("reach"))


def split_starts(found: DataFrame) -> DataFrame:
    """Per split of a file: state and depth at its start, where the element that it begins in was begun, and whether
    the file ends behind its closing bracket.

    Behind the last piece of a file stands no brace, yet one is counted: a closed array ends one deeper than it began.
    """
    tally = found.groupBy("file", "block", "begins", "reach").agg(
        F.sum("turn").alias("turn"),
        F.sum("change0").alias("change0"),
        F.sum("change1").alias("change1"),
        F.count("*").alias("pieces"),
        F.sum(F.length("value")).alias("characters"),
    )
    reached = F.struct("begins", "reach", "pieces")
    splits = tally.groupBy("file", "block").agg(
        *(F.sum(name).alias(name) for name in ("turn", "change0", "change1", "characters")),
        F.collect_list(reached).alias("reached"),
    )
    # asking for the text keeps this branch's shuffle the same as that of the records, so it is read and not made again
    splits = splits.filter(F.col("characters") >= 0)
    before, whole = _earlier("file", order="block"), Window.partitionBy("file")
    turned = splits.withColumn("start", _sum_before("turn", before) % 2)
    changed = turned.withColumn("change", F.when(F.col("start") == 0, F.col("change0")).otherwise(F.col("change1")))
    deep = changed.withColumn("depth", _sum_before("change", before))
    # an element ends where the depth is back at that of the array
    ended = F.expr("aggregate(filter(reached, r -> r.begins = start AND r.reach = 1 - depth), 0L, (n, r) -> n + r.pieces)")
    counted = deep.withColumn("ended", ended).withColumn("holds", F.when(F.col("ended") > 0, F.struct("block", "ended")))
    begun = F.last("holds", ignorenulls=True).over(before)
    end = F.struct((F.col("start") + F.col("turn")) % 2, F.col("depth") + F.col("change"))
    return counted.select(
        *("file", "block", "start", "depth"),
        (F.max_by(end, "block").over(whole) == F.struct(F.lit(0), F.lit(-1))).alias("closed"),
        F.coalesce(begun["block"], F.lit(-1)).alias("begun_block"),
        F.coalesce(begun["ended"], F.lit(0)).alias("begun_number"),
    )


def _refuse(reason: str, file: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"not an array of objects ({reason}): "), file))


def _object(text: Column, first: Column) -> Column:
    """The element in a text that ends with its last piece; anything but a comma or the bracket before it is refused."""
    led = F.when(first, text.rlike(FIRST)).otherwise(text.rlike(FOLLOWING))
    body = F.concat(F.regexp_replace(text, BEFORE_OBJECT, ""), F.lit(BRACE))
    return (
        F.when(~F.col("closed"), _refuse("brackets do not match", F.col("file")))
        .when(~led, _refuse("no comma or bracket before an object", F.col("file")))
        .otherwise(body)
    )


def elements(found: DataFrame, starts: DataFrame) -> DataFrame:
    """file and text of every element of the arrays; what stands behind the last one has to be the closing bracket."""
    known = found.join(starts, ["file", "block"])
    ends = (F.col("begins") == F.col("start")) & (F.col("reach") == 1 - F.col("depth"))
    order = Window.partitionBy("file", "block").orderBy("id")
    before = _earlier("file", "block", order="id")
    marked = known.withColumn("ends", ends).withColumns(
        {
            "number": F.count_if("ends").over(before),
            # the piece before ended an element, or the split begins between elements
            "fresh": F.coalesce(F.lag("ends").over(order), (F.col("start") == 0) & (F.col("depth") <= 1)),
        }
    )
    own = F.col("number") > 0
    keyed = marked.select(
        *("value", "file", "block", "id", "ends", "fresh", "closed"),
        F.when(own, F.col("block")).otherwise(F.col("begun_block")).alias("begun_block"),
        F.when(own, F.col("number")).otherwise(F.col("begun_number")).alias("begun_number"),
    )
    first = (F.col("begun_block") == -1) & (F.col("begun_number") == 0)
    alone = F.col("ends") & F.col("fresh")
    whole = keyed.filter(alone).select("file", _object(F.col("value"), first).alias("text"))
    joined = (
        keyed.filter(~alone)
        .groupBy("file", "begun_block", "begun_number")
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "id", "value"))).alias("parts"),
            F.bool_or("ends").alias("ends"),
            F.bool_and("closed").alias("closed"),
        )
        .withColumn("text", F.array_join(F.col("parts.value"), BRACE))
    )
    nothing = first & F.col("text").rlike(NOTHING)
    tail = nothing | (~first & F.col("closed") & F.col("text").rlike(LAST))
    checked = F.when(F.col("ends"), _object(F.col("text"), first)).when(
        ~tail, _refuse("no closing bracket at the end", F.col("file"))
    )
    return whole.unionByName(joined.select("file", checked.alias("text")).filter(F.col("text").isNotNull()))


def elements_of(spark: SparkSession, path: str) -> DataFrame:
    """file and text of every element of the arrays in the files of a path."""
    found = placed(lexed(pieces(spark, path)))
    return elements(found, split_starts(found))


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One array of objects per file, of any size and any nesting, each file read by many tasks.

    A file of blanks or an empty array has no rows. Files that are cut, lack a bracket or a comma, hold anything but
    objects in their array or anything behind it stop the job, as do objects that do not parse.
    """
    return elements_of(spark, path).select(F.inline(F.array(F.from_json("text", schema, {"mode": "FAILFAST"}))))
