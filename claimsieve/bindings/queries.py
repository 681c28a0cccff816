"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimsieve.bindings import raw
from claimsieve.bindings.tables import Tables, comparable, loader
from claimsieve.functions import rules
from claimsieve.functions.rules import named
from claimsieve.operators.allocation import allocation_weights
from claimsieve.operators.dedupe import one_row_per_audited_key, one_row_per_key
from claimsieve.operators.ordering import top_k
from claimsieve.operators.quality import duplicate_keys, duplicate_report, null_profile, null_report
from claimsieve.operators.typed import conform
from claimsieve.plans import job, readback, usecases
from claimsieve.plans.cleansing import apply_rules, clean, normalise
from claimsieve.plans.usecases import answer
from claimsieve.session import scratch_folder
from claimsieve.sinks.writers import export_csv, export_json_lines, write_table
from claimsieve.sources.layout import Layout
from claimsieve.sources.readers import inventory, read_export, read_raw
from claimsieve.sources.specs import CLAIMS, TABLES

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_AS_OF = datetime.date(2002, 6, 30)
PARTS_AS_OF = datetime.date(2001, 6, 30)
SHIPPED_AS_OF = datetime.date(2001, 11, 4)
JOB_AS_OF = datetime.date(1965, 6, 30)


# --- rules and operators --------------------------------------------------------------------


def blank_to_null_profile(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("  ")).otherwise(F.col("o_orderstatus"))
    dirty = t("orders").select(
        "o_orderkey",
        status.alias("o_orderstatus"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        "o_orderpriority",
    )
    return null_profile(normalise(dirty), "orders")


def initcap_trim(t: Tables) -> DataFrame:
    dirty = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return t("part").select("p_partkey", rules.titled(dirty).alias("title"), rules.trimmed(dirty).alias("trimmed"))


def decode_category(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    sector = ((("MACHINERY", "AUTOMOBILE"), "Vehicles"), (("BUILDING",), "Construction"))
    group_code = (
        F.when(segment == "MACHINERY", F.lit(" govt"))
        .when(segment == "BUILDING", F.lit("Govt. "))
        .when(segment == "FURNITURE", F.lit("private"))
        .when(segment == "HOUSEHOLD", F.lit("Trust"))
    )
    status_code = F.when(segment == "MACHINERY", F.lit(" y ")).when(segment == "BUILDING", F.lit("n"))
    return t("customer").select(
        "c_custkey",
        rules.decode(F.concat(F.lit(" "), F.lower(segment)), sector, "NA").alias("sector"),
        rules.gender(raw.coded(segment, raw.GENDER_CODES, None)).alias("gender"),
        rules.claim_status(status_code).alias("status"),
        rules.group_type(group_code).alias("grp_type"),
    )


def safe_decimal(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.lit("NaN")).otherwise(
        F.concat(F.format_number("o_totalprice", 2), F.lit("5"))
    )
    return t("orders").select("o_orderkey", rules.safe_decimal(text).alias("amount"))


def whole_number(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), quantity, F.lit(".75 ")))
        .when(F.col("l_returnflag") == "R", F.concat(quantity, F.lit("x")))
        .otherwise(quantity)
    )
    number = rules.whole_number(text).alias("quantity")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", number)


def strict_date(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date").cast("string")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("1924-13-40")).when(
        F.col("o_orderpriority") == "5-LOW", F.lit("2000-1-2")
    )
    return t("orders").select("o_orderkey", rules.strict_date(text.otherwise(day)).alias("day"))


def duplicate_audit(t: Tables) -> DataFrame:
    return duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


def dedupe_composite(t: Tables) -> DataFrame:
    lines = t("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return one_row_per_key(lines, ["l_orderkey", "l_linenumber"])


def dedupe_single(t: Tables) -> DataFrame:
    orders = t("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return one_row_per_key(orders, ["o_custkey"])


def part_supplier_pairs(t: Tables) -> DataFrame:
    pairs = t("lineitem").select(F.col("l_partkey").alias("subgrp_id"), F.col("l_suppkey").alias("grp_id"))
    return one_row_per_key(pairs, ["subgrp_id", "grp_id"])


def alloc_weights(t: Tables) -> DataFrame:
    return allocation_weights(part_supplier_pairs(t))


def alloc_weights_fixed_point(t: Tables) -> DataFrame:
    return allocation_weights(part_supplier_pairs(t), weight_scale=7)


# --- use cases on the test tables as they are ------------------------------------------------


def uc01(t: Tables) -> DataFrame:
    return usecases.claims_per_disease(t("orders").select(F.col("o_orderpriority").alias("disease_name")))


def uc02(t: Tables) -> DataFrame:
    subscribers = t("orders").select(
        F.col("o_orderkey").alias("sub_id"),
        F.col("o_orderstatus").alias("first_name"),
        F.col("o_orderpriority").alias("last_name"),
        F.col("o_orderdate").cast("date").alias("birth_date"),
        F.col("o_custkey").alias("subgrp_id"),
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderstatus").alias("elig_ind"),
    )
    return usecases.young_subscribers(subscribers, ORDERS_AS_OF, years=3)


def uc03(t: Tables) -> DataFrame:
    groups = t("supplier").select(F.col("s_suppkey").alias("grp_id"), F.col("s_name").alias("grp_name"))
    bridge = t("lineitem").select(F.col("l_partkey").alias("subgrp_id"), F.col("l_suppkey").alias("grp_id"))
    return usecases.subgroups_per_group(groups, bridge)


def uc04(t: Tables) -> DataFrame:
    hospitals = t("nation").select(F.col("n_nationkey").alias("hospital_id"), F.col("n_name").alias("hospital_name"))
    patients = t("customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_nationkey").alias("hospital_id"))
    return usecases.patients_per_hospital(hospitals, patients)


def uc05(t: Tables) -> DataFrame:
    known = F.when(F.col("l_partkey") != 0, F.col("l_partkey"))
    subscribers = t("lineitem").select(known.alias("subgrp_id"))
    small = t("part").filter(F.col("p_size") < 25)
    subgroups = small.select(F.col("p_partkey").alias("subgrp_id"), F.col("p_name").alias("subgrp_name"))
    return usecases.subscriptions_per_subgroup(subscribers, subgroups)


def uc06(t: Tables) -> DataFrame:
    return usecases.rejected_claims(t("orders").select(F.col("o_orderstatus").alias("claim_or_rejected")), status="F")


def uc07(t: Tables) -> DataFrame:
    claims = t("orders").select(F.col("o_custkey").alias("patient_id"))
    located = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    patients = located.select(F.col("c_custkey").alias("patient_id"), F.col("n_name").alias("city"))
    return usecases.claims_per_city(claims, patients, unique_keys=True)


def nation_bridge(t: Tables) -> DataFrame:
    return t("supplier").select(F.col("s_nationkey").alias("subgrp_id"), F.col("s_suppkey").alias("grp_id"))


def uc08(t: Tables, weight_scale: int | None = None) -> DataFrame:
    subscribers = t("customer").select(F.col("c_nationkey").alias("subgrp_id"))
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    located = t("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    groups = located.select(F.col("s_suppkey").alias("grp_id"), F.col("r_name").alias("grp_type"))
    return usecases.policy_type_preference(subscribers, nation_bridge(t), groups, weight_scale)


def uc09(t: Tables) -> DataFrame:
    subscribers = t("lineitem").select(F.col("l_partkey").alias("subgrp_id"))
    subgroups = t("part").select(F.col("p_partkey").alias("subgrp_id"), F.col("p_retailprice").alias("monthly_premium"))
    return usecases.average_premium(subscribers, subgroups)


def _supplier_groups(t: Tables) -> DataFrame:
    return t("supplier").select(F.col("s_suppkey").alias("grp_id"), F.col("s_name").alias("grp_name"))


def _order_claims(t: Tables, subscriber: str) -> DataFrame:
    return t("orders").select(
        F.col(subscriber).alias("sub_id"),
        F.col("o_orderstatus").alias("claim_or_rejected"),
        F.col("o_totalprice").alias("claim_amount"),
    )


def uc10(t: Tables, weight_scale: int | None = None) -> DataFrame:
    """Customers insured by nation; the premium of a nation is its largest account balance."""
    subscribers = t("customer").select(F.col("c_custkey").alias("sub_id"), F.col("c_nationkey").alias("subgrp_id"))
    premiums = t("customer").groupBy(F.col("c_nationkey").alias("subgrp_id"))
    subgroups = premiums.agg(F.max("c_acctbal").alias("monthly_premium"))
    claims = _order_claims(t, "o_custkey")
    tables = _supplier_groups(t), nation_bridge(t), subscribers, subgroups, claims
    return usecases.group_profitability(*tables, status="O", weight_scale=weight_scale, unique_keys=True)


def uc10_wide(t: Tables) -> DataFrame:
    """Order lines insured by part, parts shared by suppliers: a large bridge, and orders with many lines."""
    subscribers = t("lineitem").select(F.col("l_orderkey").alias("sub_id"), F.col("l_partkey").alias("subgrp_id"))
    subgroups = t("part").select(F.col("p_partkey").alias("subgrp_id"), F.col("p_retailprice").alias("monthly_premium"))
    claims = _order_claims(t, "o_orderkey")
    return usecases.group_profitability(
        _supplier_groups(t), part_supplier_pairs(t), subscribers, subgroups, claims, status="O"
    )


def uc11(t: Tables) -> DataFrame:
    birth = F.make_date(F.lit(PARTS_AS_OF.year) - F.col("p_size"), F.lit(6), F.lit(30))
    patients = t("part").select(
        F.col("p_partkey").alias("patient_id"),
        F.col("p_name").alias("patient_name"),
        F.col("p_type").alias("patient_gender"),
        birth.alias("patient_birth_date"),
        F.col("p_name").alias("disease_name"),
        F.col("p_brand").alias("city"),
        F.col("p_brand").alias("hospital_id"),
    )
    return usecases.minor_cancer_patients(patients, PARTS_AS_OF, text="widget")


def uc12(t: Tables) -> DataFrame:
    charges = t("orders").select(
        F.col("o_custkey").alias("patient_id"),
        "o_orderkey",
        F.col("o_orderstatus").alias("cashless_flag"),
        F.col("o_totalprice").alias("total_charges"),
    )
    patients = t("customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("patient_name"))
    found = usecases.cashless_high_charges(charges, flag="F", patients=patients)
    return found.select(F.col("o_orderkey").alias("patient_id"), "patient_name", "cashless_flag", "total_charges")


def uc13(t: Tables) -> DataFrame:
    shipped = t("lineitem").select(
        F.col("l_partkey").alias("patient_id"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("procedure_date"),
    )
    birth = F.make_date(F.lit(SHIPPED_AS_OF.year) - F.col("p_size"), F.lit(6), F.lit(30))
    parts = t("part").select(
        F.col("p_partkey").alias("patient_id"),
        F.col("p_type").alias("patient_gender"),
        birth.alias("patient_birth_date"),
        F.col("p_name").alias("procedure_name"),
    )
    found = usecases.recent_knee_surgery(shipped, SHIPPED_AS_OF, text="widget", gender="PROMO", patients=parts)
    return found.select(
        F.col("l_orderkey").alias("patient_id"),
        *("l_linenumber", "patient_gender", "patient_birth_date", "procedure_name", "procedure_date"),
    )


# --- the cleansing job over derived raw tables ------------------------------------------------


def raw_tables(t: Tables) -> dict[str, DataFrame]:
    return {name: make(t) for name, make in raw.RAW.items()}


def _cleaner(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: clean(raw.RAW[name](t), TABLES[name])


def null_token_cleaner(t: Tables) -> DataFrame:
    return clean(raw.claims(t), CLAIMS, null_tokens=("NaN",))


def job_null_report(t: Tables) -> DataFrame:
    return null_report({name: normalise(df) for name, df in raw_tables(t).items()})


def job_duplicate_report(t: Tables) -> DataFrame:
    staged = {name: normalise(df) for name, df in raw_tables(t).items()}
    return duplicate_report(staged, {name: spec.raw_keys for name, spec in TABLES.items()})


def job_duplicate_report_cleaned(t: Tables) -> DataFrame:
    ruled = {name: apply_rules(normalise(df), TABLES[name]) for name, df in raw_tables(t).items()}
    return duplicate_report(ruled, {name: spec.keys for name, spec in TABLES.items()})


def job_answer(name: str) -> Callable[[Tables], DataFrame]:
    """A use case over the cleaned tables it reads."""
    used = usecases.USE_CASES[name].tables
    return lambda t: answer(name, {table: _cleaner(table)(t) for table in used}, as_of=JOB_AS_OF, unique_keys=True)


JOB_ANSWERS = [name for name in usecases.USE_CASES if name[:4] not in ("uc12", "uc13")]


# --- sources and sinks, by way of the shared scratch folder -----------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer blanks, quotes, commas, line feeds and carriage returns through the delimited layer."""
    label = F.concat(F.lit('  "'), F.col("c_name"), F.lit('", '), F.lower("c_mktsegment"), F.lit(" "))
    remark = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("a, b"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("one\ntwo\r\n"), F.col("c_name"), F.lit("\rthree\n")))
        .otherwise(F.lit(" x"))
    )
    path = scratch_folder(spark)
    table = loader(spark, sf_dir)("customer").select("c_custkey", label.alias("label"), remark.alias("remark"))
    export_csv(table, path)
    return read_export(spark, path).select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "label", "remark")


def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    export_json_lines(normalise(raw.claims(loader(spark, sf_dir))), path)
    return comparable(clean(read_raw(spark, CLAIMS, path, "lines"), CLAIMS))


def _write_claims_array(spark: SparkSession, sf_dir: str, separator: str) -> str:
    """One bracketed array per file of the claims, fields in another order. Returns the folder."""
    path = scratch_folder(spark)
    claims = raw.claims(loader(spark, sf_dir))
    line = F.struct(*sorted(claims.columns))
    objects = claims.select(F.to_json(line).alias("object"), F.spark_partition_id().alias("file"))
    numbered = objects.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("object")))
    last = F.max("place").over(Window.partitionBy("file"))
    opening = F.when(F.col("place") == 1, F.lit("[")).otherwise(F.lit(separator))
    closing = F.when(F.col("place") == last, F.lit("]")).otherwise(F.lit(""))
    texts = numbered.select("file", "place", F.concat(opening, "object", closing).alias("value"))
    texts.sortWithinPartitions("file", "place").select("file", "value").write.partitionBy("file").text(path)
    return path


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default reader over bracketed arrays."""
    path = _write_claims_array(spark, sf_dir, ",")
    return comparable(clean(read_raw(spark, CLAIMS, f"{path}/*"), CLAIMS))


def json_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same arrays read by many tasks each."""
    path = _write_claims_array(spark, sf_dir, " , ")
    return comparable(clean(read_raw(spark, CLAIMS, f"{path}/*", "split"), CLAIMS))


def typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean claims as delimited text with null texts, loaded by name into their types."""
    path = scratch_folder(spark)
    claims = clean(raw.claims(loader(spark, sf_dir)), CLAIMS)
    kind = F.when(F.col("disease_name") == "2-high", F.lit("NULL")).when(
        F.col("disease_name") == "3-medium", F.lit("null")
    )
    text = claims.withColumn("claim_type", kind.otherwise(F.col("claim_type"))).select(*reversed(claims.columns))
    export_csv(text, path)
    core = scratch_folder(spark)
    write_table(conform(read_export(spark, path), CLAIMS.schema, text_input=True), core)
    return comparable(spark.read.parquet(core))


def staged_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that lies in the folder with its rows; the parts of a table count for it, an empty file with 0."""
    # what lies directly in the folder: the first name behind its own in the path
    inside = F.regexp_extract("path", rf"/\Q{sf_dir.strip('/').rsplit('/', 1)[-1]}\E/([^/]+)", 1)
    return inventory(spark, sf_dir).groupBy(inside.alias("file")).agg(F.sum("rows").alias("rows"))


def dedupe_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of repeated keys stored first, then only their rows compared."""
    keys = ["l_orderkey", "l_suppkey"]
    lines = loader(spark, sf_dir)("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    path = scratch_folder(spark)
    write_table(duplicate_keys(lines, keys, "lineitem"), path)
    return comparable(one_row_per_audited_key(lines, keys, spark.read.parquet(path)))


def allocation_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights as a lazy view, read by SQL."""
    job.register_allocation_view({"group_subgroup_bridge": nation_bridge(loader(spark, sf_dir))})
    return spark.sql("SELECT subgrp_id, grp_id, allocation_weight FROM v_subgroup_group_alloc")


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_folder(spark)
    write_table(df, path)
    return spark.read.parquet(path)


def output_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readback.view("va03", _stored_answer(spark, sf_dir, "va03", uc03))


_answers: dict[tuple[str, str, str], DataFrame] = {}


def _stored_answer(spark: SparkSession, sf_dir: str, name: str, make: Callable[[Tables], DataFrame]) -> DataFrame:
    """A use case's answer as a table that all read-backs of the session share."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _answers:
        _answers[key] = _stored(spark, make(loader(spark, sf_dir)))
    return _answers[key]


def stored_view(name: str, make: Callable[[Tables], DataFrame]) -> Query:
    """A validation read of the stored answer."""
    return lambda spark, sf_dir: comparable(readback.view(name, _stored_answer(spark, sf_dir, name, make)))


def va_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_stored_answer(spark, sf_dir, "va01", uc01), ("-total_claims", "disease_name"), 3)


def _run_job(spark: SparkSession, sf_dir: str, **options) -> Layout:
    """The raw tables as files, then the whole job."""
    layout = Layout(scratch_folder(spark))
    for name, df in raw_tables(loader(spark, sf_dir)).items():
        spec = TABLES[name]
        (export_json_lines if spec.is_json else export_csv)(df, layout.raw(spec.file))
    return job.run(spark, layout, as_of=JOB_AS_OF, json_layout="lines", **options)


def full_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to output tables on disk, then the read-back of the profitability table."""
    return comparable(readback.read_back(spark, _run_job(spark, sf_dir), "va10"))


def row_text(df: DataFrame, table: str) -> DataFrame:
    """Every row of a table as one text, nulls as a dash."""
    cells = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("-")) for name in sorted(df.columns)]
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *cells).alias("row_text"))


def full_job_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the job writes, by way of the delimited clean layer: answers, null counts, repeated keys."""
    layout = _run_job(spark, sf_dir, csv=True)
    read = spark.read.parquet
    parts = [row_text(read(layout.output(name)), name) for name in JOB_ANSWERS]
    for name, spec in TABLES.items():
        nulls = read(layout.null_report(name)).unpivot(
            "dataset_name", [named(column) for column in spec.raw_columns], "column_name", "null_count"
        )
        parts.append(row_text(nulls, "null_report"))
        keys = F.to_json(F.struct(*(named(key).alias(key.strip()) for key in spec.raw_keys)))
        repeated = read(layout.duplicate_report(name)).select("dataset_name", keys.alias("duplicate_key"), "count")
        parts.append(row_text(repeated, "duplicate_report"))
    return functools.reduce(DataFrame.unionByName, parts)


# --- registry ---------------------------------------------------------------------------------

OPERATORS = {
    "blank_to_null_profile": blank_to_null_profile,
    "initcap_trim": initcap_trim,
    "decode_category": decode_category,
    "safe_decimal": safe_decimal,
    "whole_number": whole_number,
    "strict_date": strict_date,
    "duplicate_audit": duplicate_audit,
    "dedupe_composite": dedupe_composite,
    "dedupe_single": dedupe_single,
    "alloc_weights": alloc_weights,
    "alloc_weights_fixed_point": alloc_weights_fixed_point,
    "uc01_group_count": uc01,
    "uc02_age_filter": uc02,
    "uc03_distinct_per_group": uc03,
    "uc04_distinct_members": uc04,
    "uc05_left_count": uc05,
    "uc06_filtered_count": uc06,
    "uc07_city_count": uc07,
    "uc08_weighted_preference": uc08,
    "uc08_weighted_seven_digits": lambda t: uc08(t, weight_scale=7),
    "uc09_avg_premium": uc09,
    "uc10_profitability": uc10,
    "uc10_profitability_seven_digits": lambda t: uc10(t, weight_scale=7),
    "uc10_profitability_wide": uc10_wide,
    "uc11_text_and_age": uc11,
    "uc12_flag_and_amount": uc12,
    "uc13_recent_procedure": uc13,
    **{f"clean_{name}": _cleaner(name) for name in raw.RAW},
    "clean_claims_null_tokens": null_token_cleaner,
    "job_null_report": job_null_report,
    "job_duplicate_report": job_duplicate_report,
    "job_duplicate_report_cleaned": job_duplicate_report_cleaned,
    **{f"job_{name}": job_answer(name) for name in JOB_ANSWERS},
}

VIEWS = {
    "va01": uc01,
    "va02": uc02,
    "va03": uc03,
    "va04": uc04,
    "va05": uc05,
    "va06": uc06,
    "va07": uc07,
    "va08": uc08,
    "va09": uc09,
    "va10": uc10,
    "va11": uc11,
}

FILE_QUERIES: dict[str, Query] = {
    "va_top_k": va_top_k,
    **{name: stored_view(name, make) for name, make in VIEWS.items()},
    "csv_round_trip": csv_round_trip,
    "json_lines_scan": json_lines_scan,
    "json_array_scan": json_array_scan,
    "json_split_scan": json_split_scan,
    "typed_load": typed_load,
    "dedupe_audited": dedupe_audited,
    "allocation_view": allocation_view,
    "staged_inventory": staged_inventory,
    "output_read_back": output_read_back,
    "full_job": full_job,
    "full_job_tables": full_job_tables,
}


def _over_tables(make: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(make(loader(spark, sf_dir)))


def all_queries() -> dict[str, Query]:
    return {name: _over_tables(make) for name, make in OPERATORS.items()} | FILE_QUERIES
