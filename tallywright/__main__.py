"""Run the whole batch: raw CSV extract in, model, reports and star schema out.

    spark-submit --py-files tallywright.zip run.py   # or: python -m tallywright
        --raw FOLDER --out FOLDER --as-of YYYY-MM-DD [--csv]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tallywright.plans.reports import publish_reports, publish_star, validate_and_clean
from tallywright.sources.files import load_model, read_raw_tables


def run(spark: SparkSession, raw: str, out: str, as_of: dt.date, csv: bool = False) -> None:
    cleaned = validate_and_clean(read_raw_tables(spark, raw), f"{out}/quality", csv=csv)
    model = load_model(cleaned, f"{out}/model")
    reports = publish_reports(model, as_of, f"{out}/reports", csv=csv)
    publish_star(model, reports, f"{out}/star", as_of)


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallywright", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder with the nine CSV files")
    parser.add_argument("--out", required=True, help="folder for all results")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    parser.add_argument("--csv", action="store_true", help="also write reports as CSV")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tallywright").getOrCreate()
    run(spark, args.raw, args.out, args.as_of, args.csv)


if __name__ == "__main__":
    main()
