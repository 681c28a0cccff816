"""Cleaners, de-duplication and quality reports on small dirty tables."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimsieve.operators import dedupe
from claimsieve.operators.dedupe import one_row_per_audited_key, one_row_per_key
from claimsieve.operators.quality import duplicate_keys, duplicate_report, null_profile, null_report
from claimsieve.operators.typed import conform
from claimsieve.plans.cleansing import clean, normalise
from claimsieve.sources.specs import BRIDGE, CLAIMS, GROUPS, HOSPITALS, PATIENTS, SUBSCRIBERS, TABLES


def text_table(spark, spec, *rows):
    return spark.createDataFrame([tuple(row.get(c) for c in spec.raw_columns) for row in rows], spec.raw_schema)


@pytest.mark.parametrize("spec", TABLES.values(), ids=lambda s: s.name)
def test_every_cleaner_gives_the_declared_columns(spark, spec):
    cleaned = clean(text_table(spark, spec), spec)
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in spec.schema]


def test_patient(spark):
    raw = text_table(
        spark,
        PATIENTS,
        {"Patient_id": " 17 ", "Patient_name": "  ", "patient_gender": "f", "patient_birth_date": "1948-12-20",
         "patient_phone": " +91 1 ", "disease_name": "bladder CANCER", "city": " new  delhi", "hospital_id": "h1 "},
    )
    assert clean(raw, PATIENTS).first() == (
        "17", None, "Female", datetime.date(1948, 12, 20), "+91 1", "Bladder Cancer", "New  Delhi", "H1",
    )


def test_subscriber_with_blanks_in_header_names(spark):
    raw = text_table(
        spark,
        SUBSCRIBERS,
        {"sub _id": " subid1", "first_name": "ASHA", "Zip Code": " 12 ", "Subgrp_id": " ", "Elig_ind": "y",
         "Gender": "Others", "Birth_date": "1990-1-1", "eff_date": "2010-01-01"},
    )
    row = clean(raw, SUBSCRIBERS).first()
    assert (row.sub_id, row.first_name, row.zip_code, row.subgrp_id, row.elig_ind) == ("SUBID1", "Asha", "12", None, "Y")
    assert (row.gender, row.birth_date, row.eff_date) == ("NA", None, datetime.date(2010, 1, 1))


def test_claim(spark):
    raw = text_table(
        spark,
        CLAIMS,
        {"claim_id": "0", "patient_id": " 18", "disease_name": "anthrax", "SUB_ID": "subid9", "Claim_Or_Rejected": "NaN",
         "claim_type": "claims of value", "claim_amount": "79,874.5", "claim_date": "1949-03-14"},
    )
    assert clean(raw, CLAIMS).first() == (
        0, "18", "Anthrax", "SUBID9", "Unknown", "Claims Of Value", Decimal("79874.50"), datetime.date(1949, 3, 14),
    )


def test_group_and_hospital(spark):
    groups = text_table(
        spark, GROUPS, {"Country": "india", "premium_written": "72,000", "Grp_Id": "grp1", "Grp_Type": "Govt.", "year": "x"}
    )
    row = clean(groups, GROUPS).first()
    assert (row.country, row.premium_written, row.grp_id, row.grp_type, row.year) == (
        "India", Decimal("72000.00"), "GRP1", "Government", None,
    )
    hospital = text_table(spark, HOSPITALS, {"Hospital_id": "h1", "state": "NaN"})
    assert clean(hospital, HOSPITALS).first().state == "Nan"
    assert clean(hospital, HOSPITALS, null_tokens=("NaN",)).first().state is None


def test_keys_equal_after_cleaning_are_merged(spark):
    raw = text_table(
        spark,
        HOSPITALS,
        {"Hospital_id": "h1", "Hospital_name": "b"},
        {"Hospital_id": " H1 ", "Hospital_name": "a"},
        {"Hospital_id": " ", "Hospital_name": "x"},
        {"Hospital_id": None, "Hospital_name": "w"},
    )
    rows = {(r.hospital_id, r.hospital_name) for r in clean(raw, HOSPITALS).collect()}
    assert rows == {("H1", "a"), (None, "w")}


def test_pairs_are_distinct(spark):
    raw = text_table(
        spark, BRIDGE, {"SubGrp_ID": "s1", "Grp_Id": "g"}, {"SubGrp_ID": "S1 ", "Grp_Id": "G"}, {"Grp_Id": "G"}, {"Grp_Id": "g "}
    )
    assert sorted(map(tuple, clean(raw, BRIDGE).collect()), key=str) == sorted([("S1", "G"), (None, "G")], key=str)


def survivors(rows, key):
    """Per key the smallest row, nulls last in every column."""
    best = {}
    for row in rows:
        rank = [(v is None, v if v is not None else 0) for i, v in enumerate(row) if i != key]
        if row[key] not in best or rank < best[row[key]][0]:
            best[row[key]] = (rank, row)
    return {row for _, row in best.values()}


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_survivors_match_brute_force_with_a_hot_and_a_null_key(spark, parts):
    random.seed(5)
    values = [None, "a", "b", "Ä", ""]
    rows = [
        (random.choice(values), random.choice([7, 7, 7, None, None, *range(20)]), random.choice([None, 1, 2]))
        for _ in range(600)
    ]
    table = spark.createDataFrame(rows, "a string, k int, b int").repartition(parts)
    ordered = [tuple(None if v is None else (v.encode() if isinstance(v, str) else v) for v in row) for row in rows]
    expected = {tuple(v.decode() if isinstance(v, bytes) else v for v in row) for row in survivors(ordered, 1)}
    result = one_row_per_key(table, ["k"])
    assert result.columns == ["a", "k", "b"]
    collected = [tuple(row) for row in result.collect()]
    assert len(collected) == len(set(collected)) == len(expected)
    assert set(collected) == expected


@pytest.mark.parametrize("marks", [dedupe.MARKS, 1024, 64], ids=["apart", "colliding", "full"])
@pytest.mark.parametrize("keys", [["k"], ["k", "b"]])
def test_audited_keys_give_the_same_survivors(spark, monkeypatch, marks, keys):
    monkeypatch.setattr(dedupe, "MARKS", marks)
    random.seed(6)
    rows = [(random.choice("xyz"), random.choice([None, 7, 7, *range(400)]), random.choice([None, 1])) for _ in range(700)]
    table = spark.createDataFrame(rows, "a string, k int, b int").repartition(7)
    repeated = duplicate_keys(table, keys, "t")
    result = one_row_per_audited_key(table, keys, repeated)
    assert result.columns == table.columns
    assert sorted(result.collect(), key=str) == sorted(one_row_per_key(table, keys).collect(), key=str)


def test_an_audited_dedupe_runs_nothing_before_it_is_asked(spark):
    table = spark.range(100).selectExpr("id % 50 AS k", "id AS v")
    broken = table.select(F.raise_error(F.lit("ran")).cast("bigint").alias("k"), F.lit(2).alias("count"))
    one_row_per_audited_key(table, ["k"], broken)
    result = one_row_per_audited_key(table, ["k"], duplicate_keys(table, ["k"], "t"))
    assert result.agg({"v": "sum"}).first()[0] == sum(range(50))


def test_unrepeated_keys_are_kept_without_a_comparison(spark):
    table = spark.range(100).selectExpr("id AS k", "id AS v")
    result = one_row_per_audited_key(table, ["k"], duplicate_keys(table, ["k"], "t"))
    assert result.count() == 100


def test_null_profile_and_duplicates(spark):
    raw = normalise(
        text_table(
            spark, BRIDGE, {"SubGrp_ID": " ", "Grp_Id": "g"}, {"SubGrp_ID": None, "Grp_Id": "g"}, {"SubGrp_ID": "s", "Grp_Id": "g"}
        )
    )
    assert null_profile(raw, "bridge").first().asDict() == {"SubGrp_ID": 2, "Grp_Id": 0, "dataset_name": "bridge"}
    assert duplicate_keys(raw, ["SubGrp_ID", "Grp_Id"], "bridge").collect() == [(None, "g", 2, "bridge")]
    assert {tuple(r) for r in null_report({"bridge": raw}).collect()} == {("bridge", "SubGrp_ID", 2), ("bridge", "Grp_Id", 0)}
    assert duplicate_report({"bridge": raw}, {"bridge": BRIDGE.raw_keys}).collect() == [("bridge", '{"Grp_Id":"g"}', 2)]


def test_null_profile_of_an_empty_table(spark):
    assert null_profile(text_table(spark, BRIDGE), "bridge").first() == (0, 0, "bridge")


def test_typed_load_matches_by_name(spark):
    text = spark.createDataFrame(
        [("Rejected", "1", "10.5", "NULL"), ("null", "x", "NaN", "2000-01-02")],
        "claim_or_rejected string, CLAIM_ID string, claim_amount string, claim_date string",
    )
    rest = ["patient_id", "disease_name", "sub_id", "claim_type"]
    typed = conform(text.selectExpr("*", *(f"'' AS {c}" for c in rest)), CLAIMS.schema, text_input=True)
    assert typed.schema.names == CLAIMS.schema.names
    rows = {(r.claim_id, r.claim_or_rejected, r.claim_amount, r.claim_date, r.patient_id) for r in typed.collect()}
    assert rows == {
        (1, "Rejected", Decimal("10.50"), None, None),
        (None, None, None, datetime.date(2000, 1, 2), None),
    }
