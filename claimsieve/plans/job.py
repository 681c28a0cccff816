"""The full run: raw files -> stage -> reports and clean tables -> core -> outputs.

Raw text is parsed once and staged as Parquet; the reports and the cleaner read the staged columns
they need. A run writes a version of its own and publishes it when all tables stand, so a failed run
changes nothing that readers see and is simply started again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.functions.ages import AsOf, fixed_day
from claimsieve.functions.rules import named
from claimsieve.operators.allocation import allocation_weights
from claimsieve.operators.dedupe import one_row_per_audited_key
from claimsieve.operators.quality import duplicate_keys, null_profile
from claimsieve.operators.typed import conform
from claimsieve.plans.cleansing import apply_rules, normalise
from claimsieve.plans.sizing import SHUFFLE_TARGET, SPLIT_TARGET, sized_tasks
from claimsieve.plans.usecases import USE_CASES, answer
from claimsieve.sinks import snapshots
from claimsieve.sinks.writers import export_csv, register_views, write_table
from claimsieve.sources.layout import Layout
from claimsieve.sources import quarantine
from claimsieve.sources.readers import read_export, read_raw, read_raw_checked
from claimsieve.sources.specs import TABLES, TableSpec

CONCURRENT_WRITES = 4


@dataclass(frozen=True)
class Damage:
    """What becomes of damaged rows: how many a table may have (null: any number), and whether ragged CSV rows are only
    reported or taken out of the data as well."""

    limit: int | None = None
    set_aside: bool = False


def _run_all(steps: Iterable[Callable[[], None]]) -> None:
    """Independent writes side by side, so that small tables fill the tail of large ones."""
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def stage_table(
    spark: SparkSession,
    layout: Layout,
    spec: TableSpec,
    json_layout: str,
    null_tokens: Sequence[str],
    damage: Damage | None = None,
) -> DataFrame:
    """Parse one raw table, blank to null, and keep it as Parquet under its raw column names.

    With `damage`, damaged rows are stored with their text beside the good ones, and written to the quarantine from
    there: the source is parsed once. JSON records that do not parse give no row; ragged CSV rows give one, filled or
    cut, unless they are to be set aside too.
    """
    path = layout.raw(spec.file)
    if damage is None:
        write_table(normalise(read_raw(spark, spec, path, json_layout), null_tokens), layout.stage(spec.name))
        return spark.read.schema(spec.raw_schema).parquet(layout.stage(spec.name))
    rows = read_raw_checked(spark, spec, path, json_layout)
    # the text of a damaged row stays as it was delivered, blanks and all
    checked = normalise(rows, null_tokens, untouched=quarantine.CHECKS)
    write_table(checked, layout.stage(spec.name))
    staged = spark.read.schema(checked.schema).parquet(layout.stage(spec.name))
    write_table(quarantine.damaged(staged), layout.quarantine(spec.name))
    quarantine.refuse_beyond(spark.read.parquet(layout.quarantine(spec.name)), spec.name, damage.limit)
    kept = staged.filter(F.col(quarantine.RECORD).isNull()) if spec.is_json or damage.set_aside else staged
    return kept.select(*(named(column) for column in spec.raw_columns))


def audit_keys(staged: DataFrame, spec: TableSpec, mode: str = "raw") -> DataFrame:
    """DQ-02 on the keys as delivered (`raw`) or as the de-duplication sees them (`cleaned`)."""
    if mode == "raw":
        return duplicate_keys(staged, spec.raw_keys, spec.name)
    return duplicate_keys(apply_rules(staged, spec), spec.keys, spec.name)


def cleanse(
    spark: SparkSession,
    layout: Layout,
    json_layout: str = "array",
    null_tokens: Sequence[str] = (),
    csv_export: bool = False,
    damage: Damage | None = None,
) -> None:
    """Raw files to null reports, duplicate reports and clean tables.

    The audit of cleaned keys is stored first. It shuffles keys only, and tells the cleaner which
    rows need comparing at all.
    """

    def table_job(spec: TableSpec) -> None:
        staged = stage_table(spark, layout, spec, json_layout, null_tokens, damage)
        write_table(null_profile(staged, spec.name), layout.null_report(spec.name))
        write_table(audit_keys(staged, spec), layout.duplicate_report(spec.name))
        write_table(audit_keys(staged, spec, "cleaned"), layout.key_audit(spec.name))
        repeated = spark.read.parquet(layout.key_audit(spec.name))
        clean = one_row_per_audited_key(apply_rules(staged, spec), spec.keys, repeated)
        (export_csv if csv_export else write_table)(clean, layout.clean(spec.name))

    _run_all([lambda spec=spec: table_job(spec) for spec in TABLES.values()])


def clean_tables(spark: SparkSession, layout: Layout, csv: bool = False) -> dict[str, DataFrame]:
    """The clean folders as typed tables, matched by name. Lazy: nothing is copied."""
    tables = {}
    for name, spec in TABLES.items():
        path = layout.clean(name)
        source = read_export(spark, path) if csv else spark.read.schema(spec.schema).parquet(path)
        tables[name] = conform(source, spec.schema, text_input=csv)
    return tables


def open_core(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The core tables straight from the Parquet clean layer, which has their types already."""
    return clean_tables(spark, layout)


def load_core(spark: SparkSession, layout: Layout, csv: bool = False) -> dict[str, DataFrame]:
    """SNK-02 / 03: full reload of the core tables from the clean folders."""
    tables = clean_tables(spark, layout, csv)
    _run_all([lambda name=name, df=df: write_table(df, layout.core(name)) for name, df in tables.items()])
    return {name: spark.read.schema(df.schema).parquet(layout.core(name)) for name, df in tables.items()}


def register_allocation_view(core: Mapping[str, DataFrame], weight_scale: int | None = None) -> None:
    """SNK-05: the subgroup-to-group weights for SQL users; computed when read."""
    weights = allocation_weights(core["group_subgroup_bridge"], weight_scale)
    register_views({"v_subgroup_group_alloc": weights})


def write_outputs(
    core: Mapping[str, DataFrame], layout: Layout, as_of: AsOf = None, weight_scale: int | None = None
) -> None:
    """SNK-04: one table per use case. The cleaners have made the keys of all core tables unique."""

    def output_job(name: str) -> None:
        result = answer(name, dict(core), as_of=as_of, weight_scale=weight_scale, unique_keys=True)
        write_table(result, layout.output(name))

    _run_all([lambda name=name: output_job(name) for name in USE_CASES])


def run(
    spark: SparkSession,
    layout: Layout,
    as_of: AsOf = None,
    json_layout: str = "array",
    weight_scale: int | None = None,
    csv: bool = False,
    copy_core: bool = False,
    shuffle_target: int = SHUFFLE_TARGET,
    split_target: int = SPLIT_TARGET,
    damage: Damage | None = None,
) -> Layout:
    """Everything, from the raw folder to the output tables. Returns the folders of the published version.

    Readers see the former version until the last table is written, and all of the new one from then on; the views of
    the session follow. A CSV clean layer is loaded into typed core tables. A Parquet one is typed already and read in place, unless
    `copy_core` asks for a second copy. `damage` turns on the quarantine of damaged rows; without it, JSON that does not
    parse stops the job and ragged CSV rows are filled or cut. The targets are bytes per shuffle partition and per input split; the session's
    settings are as before when the job ends.
    """
    fresh = snapshots.begin(layout)
    with sized_tasks(spark, layout.raw(""), shuffle_target, split_target):
        cleanse(spark, fresh, json_layout=json_layout, csv_export=csv, damage=damage)
        core = load_core(spark, fresh, csv) if csv or copy_core else open_core(spark, fresh)
        write_outputs(core, fresh, fixed_day(spark, as_of), weight_scale)
    snapshots.publish(spark, fresh)
    register_views(core)
    register_allocation_view(core, weight_scale)
    snapshots.remove_old(spark, layout)
    return fresh
