"""UC01..UC13 over the clean tables.

Each function takes the tables it reads and returns its answer; a stored table has no order, so orders belong to the
read-backs. Facts are
counted or summed by their key before they meet a dimension, so a key that holds a large part of
a table is reduced on the map side and no join sees more than one fact row per key. Results are
the same as for joining first, also when a dimension key occurs more than once.

`unique_keys=True` states that the cleaners have made the table keys unique; it saves work that
only repeated keys need and must not be set for other tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from claimsieve.functions import fixed_values as fixed
from claimsieve.functions.ages import AsOf, calendar_age, older_than, within_past_year, younger_than
from claimsieve.functions.rules import contains_ignoring_case, money_or_zero
from claimsieve.operators.allocation import TOTAL, allocate_to_groups
from claimsieve.operators.skew import join_even

MONEY_RESULT = TOTAL


def claims_per_disease(claims: DataFrame) -> DataFrame:
    """UC01: claims per disease; claims without a disease are a group of their own."""
    return claims.groupBy("disease_name").agg(F.count("*").alias("total_claims"))


def young_subscribers(
    subscribers: DataFrame, as_of: AsOf = None, years: int = fixed.YOUNG_SUBSCRIBER_AGE
) -> DataFrame:
    """UC02: subscribers of a subgroup who are younger than `years`."""
    birth = F.col("birth_date")
    young = subscribers.filter(younger_than(birth, years, as_of) & F.col("subgrp_id").isNotNull())
    return young.select(
        "sub_id",
        "first_name",
        "last_name",
        "birth_date",
        calendar_age(birth, as_of).alias("age"),
        "subgrp_id",
        "city",
        "elig_ind",
    )


def _distinct(column: str, unique_keys: bool) -> Column:
    """A distinct count; where the key is known to be unique, a plain one, which needs no shuffle of all pairs."""
    return F.count(column) if unique_keys else F.countDistinct(column)


def _attach(per_key: DataFrame, rows: DataFrame, key: str, unique_keys: bool) -> DataFrame:
    """Inner join of one result row per key with the rows of a large table, evenly even if a key repeats a lot."""
    if unique_keys:
        return per_key.join(rows, key)
    return join_even(rows, per_key, key)


def subgroups_per_group(groups: DataFrame, bridge: DataFrame, unique_keys: bool = False) -> DataFrame:
    """UC03: distinct subgroups of every mapped group. `unique_keys`: no pair of the bridge repeats."""
    counts = bridge.groupBy("grp_id").agg(_distinct("subgrp_id", unique_keys).alias("subgroup_count"))
    named = counts.join(groups.select("grp_id", "grp_name"), "grp_id")
    return named.groupBy("grp_id", "grp_name").agg(F.max("subgroup_count").alias("subgroup_count"))


def patients_per_hospital(hospitals: DataFrame, patients: DataFrame, unique_keys: bool = False) -> DataFrame:
    """UC04: distinct patients of every hospital that has any. `unique_keys`: no patient id repeats."""
    counts = patients.groupBy("hospital_id").agg(_distinct("patient_id", unique_keys).alias("patient_count"))
    named = counts.join(hospitals.select("hospital_id", "hospital_name"), "hospital_id")
    return named.groupBy("hospital_id", "hospital_name").agg(F.max("patient_count").alias("patient_count"))


def subscriptions_per_subgroup(subscribers: DataFrame, subgroups: DataFrame) -> DataFrame:
    """UC05: subscriptions per subgroup; missing and unknown subgroups stay, without a name."""
    counts = subscribers.groupBy("subgrp_id").agg(F.count("*").alias("subscription_count"))
    named = counts.join(subgroups.select("subgrp_id", "subgrp_name"), "subgrp_id", "left")
    return named.groupBy("subgrp_id", "subgrp_name").agg(F.sum("subscription_count").alias("subscription_count"))


def rejected_claims(claims: DataFrame, status: str = "Rejected") -> DataFrame:
    """UC06: one row with the number of rejected claims, 0 when there are none."""
    return claims.filter(F.col("claim_or_rejected") == status).agg(F.count("*").alias("rejected_claim_count"))


def claims_per_city(claims: DataFrame, patients: DataFrame, unique_keys: bool = False) -> DataFrame:
    """UC07: claims per city of their patient."""
    per_patient = claims.groupBy("patient_id").agg(F.count("*").alias("claims"))
    located = _attach(per_patient, patients.select("patient_id", "city"), "patient_id", unique_keys)
    return located.groupBy("city").agg(F.sum("claims").alias("total_claims"))


def policy_type_preference(
    subscribers: DataFrame, bridge: DataFrame, groups: DataFrame, weight_scale: int | None = None
) -> DataFrame:
    """UC08: subscriptions per group type, each split evenly over the groups of its subgroup."""
    per_subgroup = subscribers.groupBy("subgrp_id").agg(F.count("*").alias("subscriptions"))
    per_group = allocate_to_groups(bridge, per_subgroup, ["subscriptions"], weight_scale)
    typed = per_group.join(groups.select("grp_id", "grp_type"), "grp_id")
    weighted = F.round(F.sum("subscriptions"), 2).cast(MONEY_RESULT)
    return typed.groupBy("grp_type").agg(weighted.alias("weighted_subscription_count"))


def average_premium(subscribers: DataFrame, subgroups: DataFrame) -> DataFrame:
    """UC09: mean monthly premium over subscribers, null when nobody pays one."""
    per_subgroup = subscribers.groupBy("subgrp_id").agg(F.count("*").alias("subscribers"))
    premium = F.col("monthly_premium").cast(DecimalType(*fixed.MONEY))
    premiums = subgroups.groupBy("subgrp_id").agg(F.sum(premium).alias("premium"), F.count(premium).alias("premiums"))
    paid = per_subgroup.join(premiums.filter(F.col("premiums") > 0), "subgrp_id")
    total = F.sum(F.col("premium") * F.col("subscribers")).cast(TOTAL)
    mean = total / F.sum(F.col("premiums") * F.col("subscribers"))
    return paid.agg(F.round(mean, 2).cast(MONEY_RESULT).alias("avg_monthly_premium"))


def group_profitability(
    groups: DataFrame,
    bridge: DataFrame,
    subscribers: DataFrame,
    subgroups: DataFrame,
    claims: DataFrame,
    status: str = "Not Rejected",
    weight_scale: int | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """UC10: a year of premium less the claims that were not rejected, per group.

    Every subscriber takes the sum of its claims along, so that members, premium and claims are summed per subgroup in
    one pass over the subscribers and spread over the groups in another.
    Profit is the difference of the two rounded sums. Groups with neither are left out.
    """
    accepted = claims.filter(F.col("claim_or_rejected") == status)
    per_subscriber = accepted.groupBy("sub_id").agg(F.sum(money_or_zero(F.col("claim_amount"))).alias("claimed"))
    slim = subscribers.select("sub_id", "subgrp_id")
    join = slim.join if unique_keys else partial(join_even, slim)
    insured = join(per_subscriber, "sub_id", "left")
    members = insured.groupBy("subgrp_id").agg(
        F.count("*").alias("members"), F.coalesce(F.sum("claimed"), F.lit(0)).cast(TOTAL).alias("claimed")
    )
    monthly = subgroups.groupBy("subgrp_id").agg(F.sum(money_or_zero(F.col("monthly_premium"))).alias("monthly"))
    yearly = F.coalesce(F.col("monthly"), F.lit(0)) * fixed.MONTHS_PER_YEAR
    # a left join: a subgroup without a premium row counts with premium 0
    priced = members.join(monthly, "subgrp_id", "left")
    per_subgroup = priced.select("subgrp_id", (F.col("members") * yearly).cast(TOTAL).alias("premium"), "claimed")
    per_group = allocate_to_groups(bridge, per_subgroup, ["premium", "claimed"], weight_scale)
    # groups that got no share are 0 on both sides and would be filtered out: an inner join suffices
    rounded = groups.select("grp_id", "grp_name").join(
        per_group.select(
            "grp_id",
            F.round("premium", 2).cast(MONEY_RESULT).alias("total_allocated_premium"),
            F.round("claimed", 2).cast(MONEY_RESULT).alias("total_allocated_claim_amount"),
        ),
        "grp_id",
    )
    premium, claim = F.col("total_allocated_premium"), F.col("total_allocated_claim_amount")
    return rounded.filter((premium != 0) | (claim != 0)).withColumn("profit", (premium - claim).cast(MONEY_RESULT))


def minor_cancer_patients(
    patients: DataFrame, as_of: AsOf = None, years: int = fixed.MINOR_AGE, text: str = fixed.CANCER_TEXT
) -> DataFrame:
    """UC11: patients younger than `years` whose disease name holds `text`."""
    birth = F.col("patient_birth_date")
    matching = younger_than(birth, years, as_of) & contains_ignoring_case(F.col("disease_name"), text)
    return patients.filter(matching).select(
        "patient_id",
        "patient_name",
        "patient_gender",
        "patient_birth_date",
        calendar_age(birth, as_of).alias("age"),
        "disease_name",
        "city",
        "hospital_id",
    )


def _limitation(df: DataFrame, reason: str) -> DataFrame:
    """PRJ-04: the one-row answer of a use case whose columns are missing."""
    spark = df.sparkSession
    return spark.range(1).select(F.lit(fixed.NOT_AVAILABLE).alias("status"), F.lit(reason).alias("reason"))


def _with(facts: DataFrame, patients: DataFrame | None) -> DataFrame:
    return facts if patients is None else join_even(facts, patients, "patient_id")


def cashless_high_charges(
    charges: DataFrame,
    threshold: int = fixed.CASHLESS_CHARGES,
    flag: str = "Y",
    patients: DataFrame | None = None,
) -> DataFrame:
    """UC12: cashless patients with charges from `threshold` on; a stated limitation without the columns.

    `patients` adds the columns of each patient, one row per patient_id, to the charges that the filter leaves.
    """
    if not {"cashless_flag", "total_charges"} <= set(charges.columns):
        return _limitation(charges, fixed.NO_CASHLESS_COLUMNS)
    return _with(charges.filter((F.col("cashless_flag") == flag) & (F.col("total_charges") >= threshold)), patients)


def recent_knee_surgery(
    procedures: DataFrame,
    as_of: AsOf = None,
    years: int = fixed.KNEE_SURGERY_AGE,
    text: str = fixed.KNEE_TEXT,
    gender: str = "Female",
    patients: DataFrame | None = None,
) -> DataFrame:
    """UC13: women older than `years` with such surgery in the past year; a limitation without the columns.

    `patients`, one row per patient_id, may hold any columns but procedure_date; every table is filtered by what it
    holds before the two are joined.
    """
    sides = [procedures] if patients is None else [procedures, patients]
    if not {"procedure_name", "procedure_date"} <= {name for side in sides for name in side.columns}:
        return _limitation(procedures, fixed.NO_PROCEDURE_COLUMNS)
    conditions = {
        "patient_gender": F.col("patient_gender") == gender,
        "patient_birth_date": older_than(F.col("patient_birth_date"), years, as_of),
        "procedure_date": within_past_year(F.col("procedure_date"), as_of),
        "procedure_name": contains_ignoring_case(F.col("procedure_name"), text),
    }

    def matching(side: DataFrame) -> DataFrame:
        held = [condition for name, condition in conditions.items() if name in side.columns]
        return side.filter(reduce(Column.__and__, held)) if held else side

    return _with(matching(procedures), None if patients is None else matching(patients))


@dataclass(frozen=True)
class UseCase:
    """An answer, the tables it reads (in argument order) and which options it takes."""

    name: str
    answer: Callable[..., DataFrame]
    tables: tuple[str, ...]
    options: tuple[str, ...] = ()


USE_CASES = {
    case.name: case
    for case in (
        UseCase("uc01_claims_per_disease", claims_per_disease, ("claims",)),
        UseCase("uc02_young_subscribers", young_subscribers, ("subscribers",), ("as_of",)),
        UseCase("uc03_subgroups_per_group", subgroups_per_group, ("groups", "group_subgroup_bridge"), ("unique_keys",)),
        UseCase("uc04_patients_per_hospital", patients_per_hospital, ("hospitals", "patients"), ("unique_keys",)),
        UseCase("uc05_subscriptions_per_subgroup", subscriptions_per_subgroup, ("subscribers", "subgroups")),
        UseCase("uc06_rejected_claims", rejected_claims, ("claims",)),
        UseCase("uc07_claims_per_city", claims_per_city, ("claims", "patients"), ("unique_keys",)),
        UseCase(
            "uc08_policy_type_preference",
            policy_type_preference,
            ("subscribers", "group_subgroup_bridge", "groups"),
            ("weight_scale",),
        ),
        UseCase("uc09_average_premium", average_premium, ("subscribers", "subgroups")),
        UseCase(
            "uc10_group_profitability",
            group_profitability,
            ("groups", "group_subgroup_bridge", "subscribers", "subgroups", "claims"),
            ("weight_scale", "unique_keys"),
        ),
        UseCase("uc11_minor_cancer_patients", minor_cancer_patients, ("patients",), ("as_of",)),
        UseCase("uc12_cashless_high_charges", cashless_high_charges, ("patients",)),
        UseCase("uc13_recent_knee_surgery", recent_knee_surgery, ("patients",), ("as_of",)),
    )
}


def answer(name: str, tables: dict[str, DataFrame], **options) -> DataFrame:
    """A use case by name over a set of core tables; options it does not take are ignored."""
    case = USE_CASES[name]
    taken = {key: value for key, value in options.items() if key in case.options}
    return case.answer(*(tables[table] for table in case.tables), **taken)
