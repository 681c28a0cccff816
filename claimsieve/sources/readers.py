"""SRC-01, 02, 04, 05: raw files in, as text columns matched by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimsieve.functions.rules import named
from claimsieve.sources import quarantine
from claimsieve.sources.json_arrays import read_json_array
from claimsieve.sources.quoted_csv import read_quoted_csv
from claimsieve.sources.specs import TableSpec


def rows_per_file(df: DataFrame, file: Column | None = None) -> DataFrame:
    """SRC-05: the files that a table is read from, with their rows; no column is read."""
    file = F.col("_metadata.file_path") if file is None else file
    return df.groupBy(file.alias("file")).agg(F.count("*").alias("rows"))


def staged_files(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: the files below a folder; their content is not read."""
    return _listed(spark, path).select("path", "length", "modificationTime")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def inventory(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """SRC-05: path, length, modificationTime and rows of every file below a folder, in folders of any depth.

    Rows are counted for Parquet files, those whose name matches `pattern`: a single scan over all of them, whatever
    their columns, asks for no column and so reads footers alone. A file without rows has 0, any other file null.
    """
    # the files differ in their columns; a name that none of them has is never read
    files = spark.read.schema("`no column` int").option("recursiveFileLookup", True)
    counts = rows_per_file(files.option("pathGlobFilter", pattern).parquet(path))
    name = F.col("_metadata.file_name")
    counted = name.like(pattern.replace("%", r"\%").replace("_", r"\_").replace("*", "%"))
    listed = _listed(spark, path).select(
        *("path", "length", "modificationTime"), F.col("_metadata.file_path").alias("file"), counted.alias("counted")
    )
    rows = F.when(F.col("counted"), F.coalesce("rows", F.lit(0)))
    return listed.join(counts, "file", "left").select("path", "length", "modificationTime", rows.alias("rows"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV as delivered, every column text, names exactly as in the header, blanks kept.

    Files are split like text, so a delivered value cannot hold a line break; `read_export` reads values that do. Files
    of one folder must agree on the header; a differing one fails the read instead of being matched by position. A row
    with too few values is filled with nulls and surplus values are cut, as delivered files have such rows.
    """
    return _csv(spark).csv(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """CSV that `export_csv` wrote, every column text: quoted values may hold line breaks of any kind, and many tasks
    read a file."""
    whole = _csv(spark).option("multiLine", True).option("lineSep", "\n").csv(path)
    # a folder of files without a byte has no header
    return read_quoted_csv(spark, path, whole.columns) if whole.columns else whole


def _csv(spark: SparkSession) -> DataFrameReader:
    options = {"header": True, "inferSchema": False, "enforceSchema": False, "escape": '"'}
    return spark.read.options(**options)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One object per line; files are split like text."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_whole(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Any JSON layout, one value per file, whatever its size; one task per file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


# `split` is the former name of a reader by many tasks, which `array` now is
JSON_READERS = {"array": read_json_array, "whole": read_json_whole, "lines": read_json_lines, "split": read_json_array}


def read_raw(spark: SparkSession, spec: TableSpec, path: str, json_layout: str = "array") -> DataFrame:
    """A raw table in the declared columns. A JSON field absent from the file reads as null."""
    if spec.is_json:
        return JSON_READERS[json_layout](spark, path, spec.raw_schema)
    return read_csv(spark, path).select(*(named(column) for column in spec.raw_columns))


def read_raw_checked(spark: SparkSession, spec: TableSpec, path: str, json_layout: str = "array") -> DataFrame:
    """`read_raw` with the columns that tell damaged rows."""
    if not spec.is_json:
        rows = quarantine.read_csv_checked(spark, path)
        return rows.select(*(named(column) for column in spec.raw_columns), *quarantine.CHECKS)
    if json_layout == "lines":
        return quarantine.read_json_lines_checked(spark, path, spec.raw_schema)
    if json_layout == "whole":
        raise ValueError("a file read as one value has no records to set aside")
    return quarantine.read_json_array_checked(spark, path, spec.raw_schema)
