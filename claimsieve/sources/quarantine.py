"""SRC-01, SRC-02: damaged rows are counted and kept, in the same pass that reads the good ones.

A checked read has the declared columns and three more: the file of a row, its text as delivered if it is damaged, and
what is wrong with it. Staging stores them beside the columns, so the quarantine of a table is a filter on what is
staged already: the source is parsed once.

A delivered CSV row with too few or too many values still gives a row, filled with nulls or cut, as the delivered data
have such rows; it is reported as well. A JSON record that does not parse gives none. How many damaged rows a table may
have before the job stops is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimsieve.functions.rules import named
from claimsieve.sources.json_arrays import elements_of

RECORD, FILE, REASON = "_damaged_record", "_file", "_damage"
CHECKS = RECORD, FILE, REASON
TOO_FEW, TOO_MANY, NOT_JSON = "too few values", "too many values", "no JSON object"


class DamagedInput(Exception):
    """A table has more damaged rows than the job allows."""


def with_record(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(RECORD, StringType())])


def _file() -> Column:
    return F.col("_metadata.file_path").alias(FILE)


def read_csv_checked(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV as delivered with the check columns. Which values are wanted does not change what counts as damaged."""
    options = {"header": True, "inferSchema": False, "enforceSchema": False, "escape": '"', "columnPruning": False}
    names = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in names])
    reader = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    rows = reader.schema(with_record(schema)).csv(path)
    # a damaged row is parsed once more with a place for one value too many
    wider = StructType([StructField(f"c{i}", StringType()) for i in range(len(names) + 1)])
    surplus = F.from_csv(F.col(RECORD), wider.simpleString()[len("struct<") : -1].replace(":", " "), {"escape": '"'})
    reason = F.when(F.col(RECORD).isNull(), None).when(surplus[f"c{len(names)}"].isNull(), F.lit(TOO_FEW))
    return rows.select(*map(named, names), RECORD, _file(), reason.otherwise(F.lit(TOO_MANY)).alias(REASON))


def _json_reason() -> Column:
    return F.when(F.col(RECORD).isNotNull(), F.lit(NOT_JSON)).alias(REASON)


def read_json_lines_checked(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One object per line with the check columns."""
    reader = spark.read.schema(with_record(schema)).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", RECORD).json(path)
    return rows.select(*map(named, schema.fieldNames()), RECORD, _file(), _json_reason())


def read_json_array_checked(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Arrays of objects with the check columns. Files whose brackets or commas are damaged still stop the job: where
    their elements begin cannot be told."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    parsed = F.from_json("text", with_record(schema), options)
    rows = elements_of(spark, path).select(F.col("file").alias(FILE), F.inline(F.array(parsed)))
    return rows.select(*map(named, schema.fieldNames()), RECORD, FILE, _json_reason())


def damaged(staged: DataFrame) -> DataFrame:
    """The quarantine of a checked table: file, reason and record of every damaged row."""
    found = staged.filter(F.col(RECORD).isNotNull())
    return found.select(F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))


def damage_report(quarantine: DataFrame) -> DataFrame:
    """Damaged rows per file and reason."""
    return quarantine.groupBy("file", "reason").agg(F.count("*").alias("rows"))


def refuse_beyond(quarantine: DataFrame, dataset: str, limit: int | None) -> None:
    """Stop where a table has more damaged rows than `limit`; null allows any number."""
    if limit is None:
        return
    found = quarantine.groupBy("reason").agg(F.count("*").alias("rows")).collect()
    if sum(row.rows for row in found) > limit:
        counts = ", ".join(sorted(f"{row.rows} {row.reason}" for row in found))
        raise DamagedInput(f"{dataset}: {counts}; allowed {limit}")
