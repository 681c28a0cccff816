"""SNK-01, 03, 04, 05: full-refresh writes and views.

Tables are Parquet and keep the partitioning of their plan; adaptive execution sizes the files
after a shuffle. No write is forced through a single task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table; running a job again gives the same state."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Headed CSV that `read_export` reads back: quotes doubled, blanks and line breaks kept. The file tells null and ''
    apart, the reader gives null for both."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""')
        .csv(path)
    )


def export_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Lazy views for SQL users."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
