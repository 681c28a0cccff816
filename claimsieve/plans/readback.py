"""VA-01..13 / SNK-06: the validation reads of the output tables.

A stored table has no order, so every limited read states its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimsieve.operators.ordering import top_k
from claimsieve.sinks.snapshots import current
from claimsieve.sources.layout import Layout


@dataclass(frozen=True)
class ReadBack:
    table: str
    order: tuple[str, ...] = ()
    limit: int | None = None


READ_BACKS = {
    "va01": ReadBack("uc01_claims_per_disease", ("-total_claims", "disease_name"), 10),
    "va02": ReadBack("uc02_young_subscribers", ("age", "sub_id"), 20),
    "va03": ReadBack("uc03_subgroups_per_group", ("-subgroup_count", "grp_id"), 10),
    "va04": ReadBack("uc04_patients_per_hospital", ("-patient_count", "hospital_id"), 10),
    "va05": ReadBack("uc05_subscriptions_per_subgroup", ("-subscription_count", "subgrp_id"), 10),
    "va06": ReadBack("uc06_rejected_claims"),
    "va07": ReadBack("uc07_claims_per_city", ("-total_claims", "city"), 10),
    "va08": ReadBack("uc08_policy_type_preference", ("-weighted_subscription_count", "grp_type")),
    "va09": ReadBack("uc09_average_premium"),
    "va10": ReadBack("uc10_group_profitability", ("-profit", "grp_id"), 10),
    "va11": ReadBack("uc11_minor_cancer_patients", ("patient_id",), 20),
    "va12": ReadBack("uc12_cashless_high_charges"),
    "va13": ReadBack("uc13_recent_knee_surgery"),
}


def view(name: str, df: DataFrame) -> DataFrame:
    """The validation read of an answer that is already at hand."""
    check = READ_BACKS[name]
    return top_k(df, check.order, check.limit)


def read_back(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The validation read of the stored table, of the current version unless `layout` names one."""
    return view(name, spark.read.parquet(current(spark, layout).output(READ_BACKS[name].table)))
