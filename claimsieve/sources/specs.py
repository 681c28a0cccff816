"""SRC-03: the eight tables, declared.

Each field names its typed column, the raw column it comes from, its rule and its type. The fields
stand in the declared column order. File names, column names and keys are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from claimsieve.functions import fixed_values as fixed
from claimsieve.functions import rules


@dataclass(frozen=True)
class Field:
    name: str
    raw: str
    rule: Callable[[Column], Column]
    type: DataType = StringType()


def _date(name: str, raw: str) -> Field:
    return Field(name, raw, rules.strict_date, DateType())


def _money(name: str, raw: str) -> Field:
    return Field(name, raw, rules.safe_decimal, DecimalType(*fixed.MONEY))


@dataclass(frozen=True)
class TableSpec:
    name: str
    file: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def is_json(self) -> bool:
        return self.file.endswith(".json")

    @property
    def raw_columns(self) -> list[str]:
        return [field.raw for field in self.fields]

    @property
    def raw_keys(self) -> list[str]:
        return [field.raw for key in self.keys for field in self.fields if field.name == key]

    @property
    def raw_schema(self) -> StructType:
        """The raw layer is text throughout."""
        return StructType([StructField(name, StringType()) for name in self.raw_columns])

    @property
    def schema(self) -> StructType:
        return StructType([StructField(field.name, field.type) for field in self.fields])


PATIENTS = TableSpec(
    "patients",
    "Patient_records.csv",
    ("patient_id",),
    (
        Field("patient_id", "Patient_id", rules.trimmed),
        Field("patient_name", "Patient_name", rules.titled),
        Field("patient_gender", "patient_gender", rules.gender),
        _date("patient_birth_date", "patient_birth_date"),
        Field("patient_phone", "patient_phone", rules.trimmed),
        Field("disease_name", "disease_name", rules.titled),
        Field("city", "city", rules.titled),
        Field("hospital_id", "hospital_id", rules.uppered),
    ),
)

SUBSCRIBERS = TableSpec(
    "subscribers",
    "subscriber.csv",
    ("sub_id",),
    (
        Field("sub_id", "sub _id", rules.uppered),
        Field("first_name", "first_name", rules.titled),
        Field("last_name", "last_name", rules.titled),
        Field("street", "Street", rules.titled),
        _date("birth_date", "Birth_date"),
        Field("gender", "Gender", rules.gender),
        Field("phone", "Phone", rules.trimmed),
        Field("country", "Country", rules.titled),
        Field("city", "City", rules.titled),
        Field("zip_code", "Zip Code", rules.trimmed),
        Field("subgrp_id", "Subgrp_id", rules.uppered),
        Field("elig_ind", "Elig_ind", rules.uppered),
        _date("eff_date", "eff_date"),
        _date("term_date", "term_date"),
    ),
)

CLAIMS = TableSpec(
    "claims",
    "claims.json",
    ("claim_id",),
    (
        Field("claim_id", "claim_id", rules.number_id, LongType()),
        Field("patient_id", "patient_id", rules.trimmed),
        Field("disease_name", "disease_name", rules.titled),
        Field("sub_id", "SUB_ID", rules.uppered),
        Field("claim_or_rejected", "Claim_Or_Rejected", rules.claim_status),
        Field("claim_type", "claim_type", rules.titled),
        _money("claim_amount", "claim_amount"),
        _date("claim_date", "claim_date"),
    ),
)

GROUPS = TableSpec(
    "groups",
    "group.csv",
    ("grp_id",),
    (
        Field("country", "Country", rules.titled),
        _money("premium_written", "premium_written"),
        Field("zipcode", "zipcode", rules.trimmed),
        Field("grp_id", "Grp_Id", rules.uppered),
        Field("grp_name", "Grp_Name", rules.trimmed),
        Field("grp_type", "Grp_Type", rules.group_type),
        Field("city", "city", rules.titled),
        Field("year", "year", rules.whole_number, IntegerType()),
    ),
)

SUBGROUPS = TableSpec(
    "subgroups",
    "subgroup.csv",
    ("subgrp_id",),
    (
        Field("subgrp_id", "SubGrp_id", rules.uppered),
        Field("subgrp_name", "SubGrp_Name", rules.trimmed),
        _money("monthly_premium", "Monthly_Premium"),
    ),
)

BRIDGE = TableSpec(
    "group_subgroup_bridge",
    "grpsubgrp.csv",
    ("subgrp_id", "grp_id"),
    (
        Field("subgrp_id", "SubGrp_ID", rules.uppered),
        Field("grp_id", "Grp_Id", rules.uppered),
    ),
)

DISEASES = TableSpec(
    "disease_subgroup_map",
    "disease.csv",
    ("subgrp_id", "disease_id"),
    (
        Field("subgrp_id", "SubGrpID", rules.uppered),
        Field("disease_id", " Disease_ID", rules.trimmed),
        Field("disease_name", "Disease_name", rules.titled),
    ),
)

HOSPITALS = TableSpec(
    "hospitals",
    "hospital.csv",
    ("hospital_id",),
    (
        Field("hospital_id", "Hospital_id", rules.uppered),
        Field("hospital_name", "Hospital_name", rules.trimmed),
        Field("city", "city", rules.titled),
        Field("state", "state", rules.titled),
        Field("country", "country", rules.titled),
    ),
)

TABLES = {
    spec.name: spec
    for spec in (PATIENTS, SUBSCRIBERS, CLAIMS, GROUPS, SUBGROUPS, BRIDGE, DISEASES, HOSPITALS)
}
