"""Dirty raw insurance tables, derived from the test tables.

Every row of the source table becomes one or two raw rows. Dirt (blanks, case, odd codes, bad
dates, commas in amounts, repeated keys) depends on the values of the row.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.bindings.tables import Tables

FIRST_BIRTH = datetime.date(1930, 1, 1)


def _text(value: Column) -> Column:
    return value.cast("string")


def _join(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(part) if isinstance(part, str) else _text(part) for part in parts))


def _twice(df: DataFrame, repeated: Column) -> DataFrame:
    """A column `copy`: 1 for every row, and 2 for the second delivery of the `repeated` ones."""
    copies = F.when(repeated, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(copies))


def coded(value: Column, table: dict[str, str], other: str | None) -> Column:
    """The raw code that stands for each value."""
    label = None
    for key, text in table.items():
        label = F.when(value == key, F.lit(text)) if label is None else label.when(value == key, F.lit(text))
    return label.otherwise(F.lit(other))


def _birth() -> Column:
    return F.date_add(F.lit(FIRST_BIRTH), F.floor("c_acctbal").cast("int"))


SEGMENT = "c_mktsegment"
GENDER_CODES = {"AUTOMOBILE": "m", "BUILDING": " MALE ", "FURNITURE": "f", "HOUSEHOLD": "Female "}
STATUS_CODES = {"F": "y", "O": " N"}


def patients(t: Tables) -> DataFrame:
    segment, nation = F.col(SEGMENT), F.col("c_nationkey")
    second = F.col("copy") == 2
    birth = F.when(nation == 24, F.lit("1924-13-40")).when(nation == 23, F.lit("2000-1-2")).otherwise(_text(_birth()))
    cancer = segment.isin("FURNITURE", "HOUSEHOLD")
    return _twice(t("customer"), segment == "AUTOMOBILE").select(
        F.when(second, _text(F.col("c_custkey"))).otherwise(_join("  ", F.col("c_custkey"), " ")).alias("Patient_id"),
        F.when(segment == "BUILDING", F.lit("   "))
        .when(second, _join(" the other ", F.upper("c_name")))
        .otherwise(F.upper("c_name"))
        .alias("Patient_name"),
        coded(segment, GENDER_CODES, "Others").alias("patient_gender"),
        birth.alias("patient_birth_date"),
        _join(" +91 ", F.col("c_custkey")).alias("patient_phone"),
        F.when(cancer, _join(F.lower(segment), " cancer ")).otherwise(F.lower(segment)).alias("disease_name"),
        _join(" cITY of nation ", nation).alias("city"),
        _join(" h", nation).alias("hospital_id"),
    )


def subscribers(t: Tables) -> DataFrame:
    segment, nation, second = F.col(SEGMENT), F.col("c_nationkey"), F.col("copy") == 2
    return _twice(t("customer"), segment == "HOUSEHOLD").select(
        F.when(second, _join(" SUBID", F.col("c_custkey"), " "))
        .otherwise(_join("subid", F.col("c_custkey")))
        .alias("sub _id"),
        F.when(segment == "BUILDING", F.lit("")).otherwise(F.lower(segment)).alias("first_name"),
        F.lower("c_name").alias("last_name"),
        _join(" mARIA  lane ", nation).alias("Street"),
        _text(_birth()).alias("Birth_date"),
        coded(segment, GENDER_CODES, None).alias("Gender"),
        F.when(second, F.lit(" ")).otherwise(_text(F.col("c_custkey"))).alias("Phone"),
        F.lit("INDIA").alias("Country"),
        _join("new-delhi ", nation).alias("City"),
        _join(" ", F.col("c_custkey")).alias("Zip Code"),
        F.when(nation == 7, F.lit(" ")).otherwise(_join(" s", nation)).alias("Subgrp_id"),
        F.when(segment == "MACHINERY", F.lit("")).when(segment == "FURNITURE", F.lit(" n")).otherwise(F.lit("y")).alias(
            "Elig_ind"
        ),
        _text(F.add_months(_birth(), 240)).alias("eff_date"),
        F.when(second, F.lit("31/12/1999")).otherwise(_text(F.add_months(_birth(), 480))).alias("term_date"),
    )


def claims(t: Tables) -> DataFrame:
    status, priority, second = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("copy") == 2
    amount = F.when(second, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return _twice(t("orders"), status == "P").select(
        F.when(second, _join(" ", F.col("o_orderkey"), " ")).otherwise(_text(F.col("o_orderkey"))).alias("claim_id"),
        _text(F.col("o_custkey")).alias("patient_id"),
        F.lower(priority).alias("disease_name"),
        _join("subid", F.col("o_custkey"), " ").alias("SUB_ID"),
        coded(status, STATUS_CODES, "NaN").alias("Claim_Or_Rejected"),
        F.lit(" CLAIMS OF value").alias("claim_type"),
        F.when(priority == "5-LOW", F.lit(" ")).otherwise(F.format_number(amount, 2)).alias("claim_amount"),
        _text(F.col("o_orderdate").cast("date")).alias("claim_date"),
    )


def groups(t: Tables) -> DataFrame:
    nation, second = F.col("s_nationkey"), F.col("copy") == 2
    kind = (
        F.when(nation < 8, F.lit("Govt."))
        .when(nation < 12, F.lit(" govt"))
        .when(nation < 20, F.lit("PRIVATE "))
        .when(nation < 23, F.lit("Trust"))
        .otherwise(F.lit(" "))
    )
    year = F.when(nation < 10, F.lit("1956")).when(nation < 20, F.lit("2000.0")).otherwise(F.lit("unknown"))
    return _twice(t("supplier"), nation < 5).select(
        F.lit("iNDIA").alias("Country"),
        F.format_number("s_acctbal", 2).alias("premium_written"),
        _join(" ", F.col("s_suppkey")).alias("zipcode"),
        F.when(second, _join("GRP", F.col("s_suppkey"))).otherwise(_join(" grp", F.col("s_suppkey"))).alias("Grp_Id"),
        F.col("s_name").alias("Grp_Name"),
        kind.alias("Grp_Type"),
        _join("city ", nation).alias("city"),
        year.alias("year"),
    )


def subgroups(t: Tables) -> DataFrame:
    return t("customer").select(
        _join(" s", F.col("c_nationkey")).alias("SubGrp_id"),
        _join(F.col(SEGMENT), " ").alias("SubGrp_Name"),
        F.format_number(F.abs("c_acctbal"), 2).alias("Monthly_Premium"),
    )


def bridge(t: Tables) -> DataFrame:
    nation, second = F.col("s_nationkey"), F.col("copy") == 2
    return _twice(t("supplier"), nation > 12).select(
        F.when(second, _join("S", nation)).otherwise(_join(" s", nation)).alias("SubGrp_ID"),
        _join("grp", F.col("s_suppkey"), " ").alias("Grp_Id"),
    )


def diseases(t: Tables) -> DataFrame:
    return t("part").select(
        _join(" ", F.lower("p_brand")).alias("SubGrpID"),
        F.col("p_type").alias(" Disease_ID"),
        F.upper("p_name").alias("Disease_name"),
    )


def hospitals(t: Tables) -> DataFrame:
    nation, segment = F.col("c_nationkey"), F.col(SEGMENT)
    return t("customer").select(
        _join(" h", nation).alias("Hospital_id"),
        F.col("c_name").alias("Hospital_name"),
        _join("CITY ", nation).alias("city"),
        F.when(segment == "BUILDING", F.lit("NaN")).otherwise(F.lower(segment)).alias("state"),
        F.lit("india").alias("country"),
    )


RAW = {
    "patients": patients,
    "subscribers": subscribers,
    "claims": claims,
    "groups": groups,
    "subgroups": subgroups,
    "group_subgroup_bridge": bridge,
    "disease_subgroup_map": diseases,
    "hospitals": hospitals,
}
