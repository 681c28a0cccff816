"""spark-submit entry: `python -m claimsieve --base <folder> [options]`."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from claimsieve.plans.job import run
from claimsieve.sources.layout import Layout
from claimsieve.sources.readers import JSON_READERS


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("claimsieve", description="Cleanse raw claims data and build the output tables.")
    parser.add_argument("--base", required=True, help="folder that holds raw/ and receives the other layers")
    parser.add_argument("--as-of", type=datetime.date.fromisoformat, help="reference day for ages; today by default")
    parser.add_argument("--json-layout", choices=sorted(JSON_READERS), default="array")
    parser.add_argument("--weight-scale", type=int, help="digits of fixed-point allocation weights; exact by default")
    parser.add_argument("--csv", action="store_true", help="write the clean layer as CSV instead of Parquet")
    parser.add_argument("--copy-core", action="store_true", help="copy a Parquet clean layer into core tables")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("claimsieve").getOrCreate()
    run(
        spark,
        Layout(options.base),
        as_of=options.as_of,
        json_layout=options.json_layout,
        weight_scale=options.weight_scale,
        csv=options.csv,
        copy_core=options.copy_core,
    )


if __name__ == "__main__":
    main()
