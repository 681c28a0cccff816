"""What the plans must and must not hold."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from claimsieve.bindings import queries as bound
from claimsieve.bindings.tables import loader
from claimsieve.operators import skew
from claimsieve.operators.allocation import allocate_to_groups, allocation_weights
from claimsieve.operators.dedupe import one_row_per_key
from claimsieve.plans import usecases as uc
from claimsieve.plans.job import open_core
from claimsieve.sources.layout import Layout
from claimsieve.sources.specs import TABLES
from tests.comparing import SF_DIR, physical, plan_nodes


def scan_of(plan, column):
    return next(line for line in plan.splitlines() if "FileScan" in line and column in line)


@pytest.fixture(scope="module")
def t(spark):
    return loader(spark, SF_DIR)


@pytest.mark.parametrize("name", bound.OPERATORS)
def test_no_python_and_no_cross_joins(t, name):
    plan = physical(bound.OPERATORS[name](t))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_age_limit_reaches_the_scan(t):
    scan = scan_of(physical(bound.uc02(t)), "o_orderdate")
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in scan
    assert "IsNotNull(o_custkey)" in scan


def test_age_limit_of_today_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "subscribers")
    columns = "sub_id string, first_name string, last_name string, birth_date date, subgrp_id string, city string"
    spark.createDataFrame([], columns + ", elig_ind string").write.parquet(path)
    scan = scan_of(physical(uc.young_subscribers(spark.read.parquet(path))), "birth_date")
    assert re.search(rf"GreaterThanOrEqual\(birth_date,{datetime.date.today().year - 29}-01-01\)", scan)


def test_status_filter_and_pruning_reach_the_scan(t):
    scan = scan_of(physical(bound.uc06(t)), "o_orderstatus")
    assert "EqualTo(o_orderstatus,F)" in scan
    assert "ReadSchema: struct<o_orderstatus:string>" in scan


def test_core_tables_read_in_place_keep_the_pushdown(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for name, spec in TABLES.items():
        spark.createDataFrame([], spec.schema).write.parquet(layout.clean(name))
    scan = scan_of(physical(uc.rejected_claims(open_core(spark, layout)["claims"])), "claim_or_rejected")
    assert "EqualTo(claim_or_rejected,Rejected)" in scan
    assert "ReadSchema: struct<claim_or_rejected:string>" in scan


def test_top_k_is_one_operator(t):
    assert "TakeOrderedAndProject(limit=10" in physical(bound.readback.view("va01", bound.uc01(t)))


def test_dedupe_limits_rows_before_its_one_shuffle(t):
    plan = physical(one_row_per_key(t("lineitem"), ["l_orderkey"]))
    assert plan.count("Exchange ") == 1
    before, after = plan.split("Exchange ")
    assert re.search(r"WindowGroupLimit.*, Final", before) and re.search(r"WindowGroupLimit.*, Partial", after)


def test_counts_are_combined_before_the_join(t):
    plan = physical(bound.uc05(t))
    assert plan.index("Join") < plan.index("partial_count(1)")
    # one exchange for the counts; the other one is the broadcast
    assert len(re.findall(r"Exchange (hash|range)partitioning", plan)) == 1


def scans(df, column):
    """Scans of files that hold the column in the whole plan that ran, what is reused counted once."""
    return [text for kind, text in plan_nodes(df) if kind == "FileSourceScanExec" and re.search(rf"\b{column}#", text)]


def test_profitability_cleans_each_table_once(spark):
    """Five tables in the clean layer; the bridge's rows are counted and joined, from one exchange or two reads."""
    tables = {name: spark.createDataFrame([], spec.schema) for name, spec in TABLES.items()}
    plan = physical(uc.answer("uc10_group_profitability", tables, unique_keys=True))
    subscribers = [line for line in plan.splitlines() if "sub_id" in line and "Scan" in line and "subgrp_id" in line]
    assert len(subscribers) == 1


def test_wide_profitability_reads_lines_three_times(t):
    assert len(scans(bound.uc10_wide(t), "l_partkey")) <= 3


def test_wide_profitability_reads_lines_three_times_beyond_a_broadcast(t, nothing_fits_a_broadcast):
    assert len(scans(bound.uc10_wide(t), "l_partkey")) <= 3


def test_answers_are_not_sorted(t):
    for name, make in bound.VIEWS.items():
        assert "rangepartitioning" not in physical(make(t)), name


FACT_FILTERS = {
    "uc12": ("o_totalprice", ["EqualTo(o_orderstatus,F)", "GreaterThanOrEqual(o_totalprice,50000"]),
    "uc13": ("l_shipdate", ["GreaterThanOrEqual(l_shipdate,2000-11-04", "LessThan(l_shipdate,2001-11-05"]),
}


@pytest.mark.parametrize("name", FACT_FILTERS)
def test_a_small_side_is_broadcast_and_facts_read_once(t, name):
    column, filters = FACT_FILTERS[name]
    df = getattr(bound, name)(t)
    (scan,) = scans(df, column)
    assert all(condition in scan for condition in filters)
    assert "ShuffleExchangeExec" not in {kind for kind, _ in plan_nodes(df)}


@pytest.mark.parametrize("name", FACT_FILTERS)
def test_hot_keys_come_from_a_sketch_of_the_filtered_facts(t, name, nothing_fits_a_broadcast):
    column, filters = FACT_FILTERS[name]
    df = getattr(bound, name)(t)
    assert "approx_top_k_accumulate" in physical(df)
    found = scans(df, column)
    assert found and all(condition in scan for scan in found for condition in filters)
    # no shuffle of all keys: the sketches go to a group number
    keys = [text for kind, text in plan_nodes(df) if kind == "ShuffleExchangeExec" and "hashpartitioning(patient_id" in text]
    assert all("part#" in text for text in keys)


def test_sketch_finds_the_hot_keys(spark):
    keys = F.when(F.col("id") < 40_000, F.lit(-1)).when(F.col("id") < 50_000, F.lit(-2)).otherwise(F.col("id"))
    many = spark.range(0, 120_000, 1, 8).select(keys.alias("k"))
    hot = {row["hot key"]: row["parts"] for row in skew.sketched_hot_keys(many, "k").collect()}
    assert set(hot) == {-1, -2} and abs(hot[-1] - skew.SKETCH_PARTS / 3) < 3 and abs(hot[-2] - skew.SKETCH_PARTS / 12) < 3
    assert skew.sketched_hot_keys(many.filter("k > 10000000"), "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_even_join_is_a_join(spark, nothing_fits_a_broadcast, how):
    rows = [(k, i) for i, k in enumerate(["a"] * 500 + ["b"] * 20 + [f"k{j}" for j in range(300)] + [None] * 200)]
    many = spark.createDataFrame(rows, "k string, v int").repartition(4)
    one = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), *((f"k{j}", j) for j in range(0, 400, 3))], "k string, w int")
    even = skew.join_even(many, one, "k", how).select("k", "v", "w")
    plain = many.join(one, "k", how).select("k", "v", "w")
    assert sorted(map(str, even.collect())) == sorted(map(str, plain.collect()))
    by_task = even.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert by_task < 200


def skewed_bridge(spark):
    """A third of 300,000 pairs on one subgroup, the rest three each."""
    subgroup = F.when(F.col("id") < 100_000, F.lit(0)).otherwise(F.floor(F.col("id") / 3))
    return spark.range(0, 300_000, 1, 8).select(subgroup.alias("subgrp_id"), F.col("id").alias("grp_id"))


@pytest.fixture
def nothing_fits_a_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_subgroup_is_spread_over_tasks(spark, tmp_path, monkeypatch, nothing_fits_a_broadcast):
    monkeypatch.setattr(skew, "HOT_PARTS", 1000)
    skewed_bridge(spark).write.parquet(str(tmp_path / "bridge"))
    bridge = spark.read.parquet(str(tmp_path / "bridge"))
    weights = allocation_weights(bridge)
    by_task = weights.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert by_task[1] == 300_000
    assert by_task[0] < 60_000
    hot = weights.filter("subgrp_id = 0").agg(F.min("allocation_weight"), F.max("allocation_weight")).first()
    assert tuple(hot) == (1 / 100_000, 1 / 100_000)


def test_allocation_over_a_hot_subgroup(spark, monkeypatch, nothing_fits_a_broadcast):
    monkeypatch.setattr(skew, "HOT_PARTS", 1000)
    bridge = skewed_bridge(spark)
    per_subgroup = bridge.groupBy("subgrp_id").agg((F.count("*") * 2).alias("total"))
    per_group = allocate_to_groups(bridge, per_subgroup, ["total"])
    assert per_group.agg(F.count("*"), F.min("total"), F.max("total")).first() == (300_000, 2, 2)


def test_a_subscriber_with_a_third_of_the_rows_is_spread_over_tasks(
    spark, tmp_path, monkeypatch, nothing_fits_a_broadcast
):
    monkeypatch.setattr(skew, "HOT_PARTS", 1000)
    skewed_bridge(spark).toDF("patient_id", "city").write.parquet(str(tmp_path / "patients"))
    patients = spark.read.parquet(str(tmp_path / "patients"))
    per_patient = patients.select("patient_id").distinct().withColumn("claims", F.lit(2))
    located = uc._attach(per_patient, patients, "patient_id", unique_keys=False)
    by_task = located.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert by_task[1] == 300_000
    assert by_task[0] < 60_000


def test_the_hot_list_is_bounded(spark):
    frequency = spark.range(200_000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert skew.hot_keys(frequency, "k", "n").count() == 0
    few = spark.range(1000).select(F.col("id").alias("k"), F.lit(5).alias("n"))
    parts = skew.hot_keys(few, "k", "n")
    assert parts.count() == 1000
    assert parts.agg(F.sum("parts")).first()[0] <= 2 * skew.HOT_PARTS


@pytest.mark.parametrize("hot_parts", [1, 3, 8192])
def test_left_join_with_repeated_and_null_keys(spark, monkeypatch, hot_parts):
    monkeypatch.setattr(skew, "HOT_PARTS", hot_parts)
    many = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2, 3, None, None])], "k int, v int")
    one = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d"), (None, "n")], "k int, w string")
    frequency = skew.rows_per_key(many, "k")
    plain = sorted(map(tuple, many.join(one, "k", "left").collect()), key=str)
    split = skew.join_one_per_key(many, one, frequency, "k", "rows", "left")
    assert sorted(map(tuple, split.select("k", "v", "w").collect()), key=str) == plain
    null_safe = skew.join_one_per_key(many, one, frequency, "k", "rows", nulls=True)
    assert null_safe.filter("k IS NULL AND w = 'n'").count() == 2
    assert null_safe.count() == 53
