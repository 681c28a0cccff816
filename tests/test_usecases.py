"""Use cases on random uneven tables, against plain SQL that joins first and aggregates after."""

import datetime
import random
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest

from claimsieve.bindings import oracles
from claimsieve.bindings.queries import uc08
from claimsieve.bindings.tables import comparable, loader
from claimsieve.functions import fixed_values as fixed
from claimsieve.operators import skew
from claimsieve.operators.allocation import allocation_weights
from claimsieve.operators.ordering import top_k
from claimsieve.plans import usecases as uc
from claimsieve.sources.specs import TABLES
from tests.comparing import SF_DIR, oracle_bag, physical, spark_bag

AS_OF = datetime.date(2020, 6, 30)
COLUMNS = {
    "claims": "claim_id int, patient_id string, disease_name string, sub_id string, claim_or_rejected string, "
    "claim_amount decimal(14,2)",
    "patients": "patient_id string, patient_name string, patient_gender string, patient_birth_date date, "
    "disease_name string, city string, hospital_id string",
    "subscribers": "sub_id string, first_name string, last_name string, birth_date date, city string, "
    "subgrp_id string, elig_ind string",
    "groups": "grp_id string, grp_name string, grp_type string",
    "subgroups": "subgrp_id string, subgrp_name string, monthly_premium decimal(14,2)",
    "group_subgroup_bridge": "subgrp_id string, grp_id string",
    "hospitals": "hospital_id string, hospital_name string",
}


def rows_of(seed, repeated_dimensions):
    """A third of the facts sits on one key; nulls, unknown keys and, if asked, repeated dimension keys."""
    r = random.Random(seed)

    def key(prefix, n, hot=True):
        if hot and r.random() < 0.34:
            return f"{prefix}0"
        return None if r.random() < 0.08 else f"{prefix}{r.randrange(n + 3)}"

    def day():
        return None if r.random() < 0.1 else datetime.date(r.randrange(1960, 2022), r.choice([1, 12]), r.choice([1, 31]))

    def money():
        return None if r.random() < 0.1 else Decimal(r.randrange(0, 10_000_000)).scaleb(-2)

    times = 2 if repeated_dimensions else 1
    diseases = [None, "Lung Cancer", "cancer", "Melanoma"]
    return {
        "claims": [
            (i, key("p", 30), r.choice(diseases), key("u", 40), r.choice(["Rejected", "Not Rejected", "Unknown"]), money())
            for i in range(400)
        ],
        "patients": [
            (f"p{i}", f"name {i}", r.choice(["Male", "Female"]), day(), r.choice(diseases), key("c", 6), key("h", 5))
            for i in range(30)
            for _ in range(times)
        ],
        "subscribers": [
            (f"u{i}", None, f"last {i}", day(), key("c", 6), key("s", 8), r.choice(["Y", "N", None]))
            for i in range(40)
            for _ in range(times)
        ],
        "groups": [
            (f"g{i}", f"group {i}", r.choice(["Government", "Private", "NA"])) for i in range(12) for _ in range(times)
        ],
        "subgroups": [(f"s{i}", f"subgroup {i}", money()) for i in range(8) for _ in range(times)],
        "group_subgroup_bridge": sorted({(key("s", 8), key("g", 12, hot=False)) for _ in range(60)}, key=str),
        "hospitals": [(f"h{i}", f"hospital {i}") for i in range(5) for _ in range(times)],
    }


ARROW = {"int": pa.int32(), "string": pa.string(), "date": pa.date32(), "decimal(14,2)": pa.decimal128(14, 2)}


def arrow_table(schema, rows):
    fields = [part.split() for part in schema.replace("14, 2", "14,2").split(", ")]
    arrays = [pa.array([row[i] for row in rows], ARROW[kind]) for i, (_, kind) in enumerate(fields)]
    return pa.table(arrays, names=[name for name, _ in fields])


@pytest.fixture(scope="module", params=[(1, False), (2, False), (3, True)], ids=["plain", "other", "repeated"])
def tables(request, spark):
    connection = duckdb.connect()
    frames = {}
    for name, rows in rows_of(*request.param).items():
        frames[name] = spark.createDataFrame(rows, COLUMNS[name]).repartition(5).cache()
        connection.register(f"t_{name}", arrow_table(COLUMNS[name], rows))
    return frames, connection


SQL = {
    "uc01_claims_per_disease": oracles.uc01_sql("t_claims"),
    "uc02_young_subscribers": oracles.uc02_sql("t_subscribers", "2020-06-30", 30),
    "uc03_subgroups_per_group": oracles.uc03_sql("t_groups", "t_group_subgroup_bridge"),
    "uc04_patients_per_hospital": oracles.uc04_sql("t_hospitals", "t_patients"),
    "uc05_subscriptions_per_subgroup": oracles.uc05_sql("t_subscribers", "t_subgroups"),
    "uc06_rejected_claims": oracles.uc06_sql("t_claims", "Rejected"),
    "uc07_claims_per_city": oracles.uc07_sql("t_claims", "t_patients"),
    "uc08_policy_type_preference": oracles.uc08_sql("t_subscribers", "t_group_subgroup_bridge", "t_groups"),
    "uc09_average_premium": oracles.uc09_sql("t_subscribers", "t_subgroups"),
    "uc10_group_profitability": oracles.uc10_sql(
        "t_groups", "t_group_subgroup_bridge", "t_subscribers", "t_subgroups", "t_claims", "Not Rejected"
    ),
    "uc11_minor_cancer_patients": oracles.uc11_sql("t_patients", "2020-06-30", 18, "CANCER"),
}


UNIQUE = [name for name, case in uc.USE_CASES.items() if "unique_keys" in case.options]


@pytest.mark.parametrize("name", UNIQUE)
def test_unique_keys_save_shuffles(spark, name):
    frames = {table: spark.createDataFrame(rows, COLUMNS[table]) for table, rows in rows_of(4, False).items()}
    counted, distinct = uc.answer(name, frames, unique_keys=True), uc.answer(name, frames)
    assert physical(counted).count("hashpartitioning") < physical(distinct).count("hashpartitioning")
    assert spark_bag(counted) == spark_bag(distinct)


def test_weighted_subscriptions_add_up_to_the_subscribers(spark):
    t = loader(spark, SF_DIR)
    total = uc08(t).agg({"weighted_subscription_count": "sum"}).first()[0]
    assert abs(total - t("customer").count()) <= Decimal("0.03")


SPLIT_JOINS = ("uc07_claims_per_city", "uc08_policy_type_preference", "uc10_group_profitability")


@pytest.mark.parametrize("name", SQL)
def test_use_case(tables, name):
    frames, connection = tables
    result = comparable(uc.answer(name, frames, as_of=AS_OF))
    assert spark_bag(result) == oracle_bag(connection, SQL[name])


@pytest.mark.parametrize("name", SPLIT_JOINS)
@pytest.mark.parametrize("hot_parts", [6, 1])
def test_use_case_with_few_or_no_hot_keys(tables, monkeypatch, name, hot_parts):
    monkeypatch.setattr(skew, "HOT_PARTS", hot_parts)
    frames, connection = tables
    result = comparable(uc.answer(name, frames, as_of=AS_OF))
    assert spark_bag(result) == oracle_bag(connection, SQL[name])


@pytest.mark.parametrize("hot_parts", [skew.HOT_PARTS, 6, 1])
def test_weights_with_null_hot_and_cold_subgroups(tables, monkeypatch, hot_parts):
    monkeypatch.setattr(skew, "HOT_PARTS", hot_parts)
    frames, connection = tables
    sql = oracles.PAIR_WEIGHTS.format(bridge="t_group_subgroup_bridge").replace("AS weight", "AS allocation_weight")
    weights = allocation_weights(frames["group_subgroup_bridge"])
    assert spark_bag(weights) == oracle_bag(connection, sql)
    per_subgroup = weights.groupBy("subgrp_id").sum("allocation_weight").collect()
    assert all(abs(row[1] - 1) < 1e-9 for row in per_subgroup)


def test_totals_add_up(tables):
    frames, _ = tables
    members = frames["subscribers"].count()
    assert uc.answer("uc05_subscriptions_per_subgroup", {**frames, "subgroups": frames["subgroups"].dropDuplicates(["subgrp_id"])}).agg(
        {"subscription_count": "sum"}
    ).first()[0] == members
    assert uc.claims_per_disease(frames["claims"]).agg({"total_claims": "sum"}).first()[0] == frames["claims"].count()


def test_same_answer_whatever_the_partitioning(tables, spark):
    frames, _ = tables
    one = uc.answer("uc10_group_profitability", {name: df.coalesce(1) for name, df in frames.items()})
    many = uc.answer("uc10_group_profitability", {name: df.repartition(23) for name, df in frames.items()})
    assert sorted(one.collect(), key=str) == sorted(many.collect(), key=str)


def test_fixed_point_weights(spark):
    bridge = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], COLUMNS["group_subgroup_bridge"])
    assert {r[2] for r in allocation_weights(bridge, weight_scale=7).collect()} == {Decimal("0.3333333")}
    subscribers = spark.createDataFrame([(f"u{i}", "s") for i in range(300_000)], "sub_id string, subgrp_id string")
    groups = spark.createDataFrame([("a", "Private")], "grp_id string, grp_type string")
    exact = uc.policy_type_preference(subscribers, bridge, groups).first()
    fixed_point = uc.policy_type_preference(subscribers, bridge, groups, weight_scale=7).first()
    assert (exact[1], fixed_point[1]) == (Decimal("100000.00"), Decimal("99999.99"))


def test_empty_claims(spark):
    claims = spark.createDataFrame([], COLUMNS["claims"])
    assert uc.rejected_claims(claims).collect() == [(0,)]
    subscribers = spark.createDataFrame([], COLUMNS["subscribers"])
    subgroups = spark.createDataFrame([], COLUMNS["subgroups"])
    assert uc.average_premium(subscribers, subgroups).collect() == [(None,)]


def test_profit_of_groups_with_one_side_only(spark):
    groups = spark.createDataFrame([("a", "A", "x"), ("b", "B", "x"), ("z", "Z", "x")], COLUMNS["groups"])
    bridge = spark.createDataFrame([("s", "a"), ("s", "b"), ("q", "z")], COLUMNS["group_subgroup_bridge"])
    subscribers = spark.createDataFrame([("u1", "s"), ("u2", "unmapped")], "sub_id string, subgrp_id string")
    claims = spark.createDataFrame(
        [("u1", "Not Rejected", Decimal("10.01")), ("u1", "Rejected", Decimal("99")), ("nobody", "Not Rejected", Decimal("5")),
         ("u1", "Not Rejected", None)],
        "sub_id string, claim_or_rejected string, claim_amount decimal(14,2)",
    )
    no_premium = spark.createDataFrame([], COLUMNS["subgroups"])
    half = Decimal("5.01")  # 5.005 rounded half up
    assert sorted(uc.group_profitability(groups, bridge, subscribers, no_premium, claims).collect()) == [
        ("a", "A", Decimal("0.00"), half, -half),
        ("b", "B", Decimal("0.00"), half, -half),
    ]
    premium = spark.createDataFrame([("s", "S", Decimal("1.00"))], COLUMNS["subgroups"])
    none = claims.filter("false")
    assert sorted(uc.group_profitability(groups, bridge, subscribers, premium, none).collect()) == [
        ("a", "A", Decimal("6.00"), Decimal("0.00"), Decimal("6.00")),
        ("b", "B", Decimal("6.00"), Decimal("0.00"), Decimal("6.00")),
    ]


def test_limitations_without_the_columns(spark):
    patients = spark.createDataFrame([], TABLES["patients"].schema)
    assert uc.cashless_high_charges(patients).collect() == [(fixed.NOT_AVAILABLE, fixed.NO_CASHLESS_COLUMNS)]
    assert uc.recent_knee_surgery(patients).collect() == [(fixed.NOT_AVAILABLE, fixed.NO_PROCEDURE_COLUMNS)]


def test_cashless_and_surgery_with_the_columns(spark):
    day = datetime.date
    patients = spark.createDataFrame(
        [
            ("1", "Female", day(1979, 12, 31), "Y", Decimal("50000"), "Left KNEE surgery", day(2019, 6, 30)),
            ("2", "Female", day(1980, 1, 1), "Y", Decimal("49999.99"), "knee surgery", day(2020, 1, 1)),
            ("3", "Male", day(1950, 1, 1), "N", Decimal("90000"), "knee surgery", day(2020, 1, 1)),
            ("4", "Female", day(1950, 1, 1), None, None, "knee surgery", day(2019, 6, 29)),
        ],
        "patient_id string, patient_gender string, patient_birth_date date, cashless_flag string, "
        "total_charges decimal(14,2), procedure_name string, procedure_date date",
    )
    assert [r.patient_id for r in uc.cashless_high_charges(patients).collect()] == ["1"]
    assert [r.patient_id for r in uc.recent_knee_surgery(patients, AS_OF).collect()] == ["1"]


def test_top_k_ties_and_nulls(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), (None, 1), ("x", None), ("y", 0)], "k string, n int")
    assert [r.k for r in top_k(rows, ("-n", "k"), 4).collect()] == ["x", "a", "b", None]
    assert top_k(rows, ("-n", "k"), None).count() == 5
