"""The corpus pipeline: good, harmless, distinct documents without secrets, packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's `docs`. All stages but the last return the columns of `documents`. Null and empty texts pass like any other:
the classifiers score them, they are no copies of each other, hold no secret and pack as an end id. Repeated rows are
copies. Further columns of `docs` are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.llm import near_duplicates, pattern_packing, quality_cnn, secret_scan, toxicity
from claimsieve.llm.shared import crc_of_id, stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go; none where the labels of `docs` lack a class to learn from."""
    training = F.coalesce(crc_of_id(F.col("doc_id")) % 3 != 1, F.lit(True))
    network = quality_cnn.train(docs, table(spark, sf_dir, "labels"), training)
    return docs.filter(quality_cnn.quality(network, F.col("text")) >= 0.5)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram classifier rejects go; none where the labels of `docs` lack a class to learn from."""
    training = F.coalesce(crc_of_id(F.col("doc_id")) % 5 != 0, F.lit(True))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), training)
    return docs.filter(toxicity.toxicity(model, F.col("text")) < 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest id."""
    return near_duplicates.one_per_class(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; documents without one stay as they are."""
    return secret_scan.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, each with its training sequence and place."""
    return pattern_packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# the classifiers are trained models and the packing is a search, which SQL cannot state; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
