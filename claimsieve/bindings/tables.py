"""Loading the test tables and making results comparable across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

Tables = Callable[[str], DataFrame]


def loader(spark: SparkSession, sf_dir: str) -> Tables:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which every engine prints alike."""

    def plain(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(f"`{field.name}`").cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.col(f"`{field.name}`").cast("string").alias(field.name)
        return F.col(f"`{field.name}`")

    return df.select(*(plain(field) for field in df.schema))
