"""Batch runs: validate and clean an extract, and publish every standing report.

A report that others build on is written first and read back, so each costly
frame is computed once however many reports use it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallywright.model import Tables
from tallywright.operators import (
    billing, cleaning, collections, leakage, quality, realization, receivables, reconciliation, star,
)
from tallywright.session import ensure_checkpoint_dir
from tallywright.sources import files


@dataclass(frozen=True)
class Publisher:
    """Writes frames below one folder as Parquet (read back for reuse) and, if asked, CSV."""

    folder: str
    csv: bool = False

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        files.write_result(df, path)
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        if self.csv:
            files.write_csv(written, f"{self.folder}/csv/{name}")
        return written


def validate_and_clean(
    raw: Tables,
    folder: str,
    orders: Mapping[str, Sequence[str]] | None = None,
    earliest: str = quality.EARLIEST_DATE,
    latest: str = quality.LATEST_DATE,
    csv: bool = False,
) -> dict[str, DataFrame]:
    """Quality findings and cross-table exceptions of the raw tables, then the cleaned tables."""
    out = Publisher(folder, csv)
    found = quality.findings(raw, None, earliest, latest)
    columns = getattr(raw, "column_findings", None)
    out.put("quality_findings", found if columns is None else found.unionByName(columns))
    out.put("missing_invoices", quality.x_missing_invoices(raw))
    out.put("duplicate_payments", quality.x_duplicate_payments(raw))
    out.put("unmatched_payments", quality.x_unmatched_payments(raw))
    out.put("orphan_payments", quality.x_orphan_payments(raw))
    out.put("invoices_without_payment", quality.x_invoices_without_payment(raw))
    out.put("amount_mismatches", quality.x_amount_mismatches(raw))
    cleaned, stats = cleaning.clean_and_count(raw, lambda name, df: out.put(f"cleaned/{name}", df), orders)
    out.put("cleaning_stats", stats)
    return cleaned


def publish_reports(
    tables: Tables, as_of: dt.date, folder: str, csv: bool = False
) -> dict[str, DataFrame]:
    """The nineteen standing results and the KPI summary as JSON."""
    out = Publisher(folder, csv)
    done: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        done[name] = out.put(name, df)
        return done[name]

    months = put("billing_analysis", billing.billing_merchant_month(tables))
    ensure_checkpoint_dir(months.sparkSession)
    grains = realization.realization_grains(tables).checkpoint()
    for grain, name in (("overall", "overall"), ("month", "by_month"), ("merchant", "by_merchant")):
        put(f"revenue_realization_{name}", realization.realization_of(grains, grain))

    put("reconciliation_payments", reconciliation.reconcile_payments(tables))
    invoices = put("reconciliation_invoices", reconciliation.reconcile_invoices(tables))
    missing = put(
        "reconciliation_missing_invoices", reconciliation.reconcile_missing_invoices(tables)
    )
    put("reconciliation_summary", reconciliation.reconciliation_summary(invoices, missing))

    events = leakage.leakage_events(tables, months, as_of)
    put("revenue_leakage", leakage.leakage_table(events, as_of))

    aging = put("ar_aging", receivables.ar_aging(tables, as_of))
    put("ar_aging_summary", receivables.aging_summary(aging))
    put("dso_by_month", receivables.dso_monthly(tables))
    put("dso_by_merchant", receivables.dso_by(tables, "merchant_id", as_of))
    put("dso_by_segment", receivables.dso_by(tables, "merchant_segment", as_of))

    put(
        "collection_channel_effectiveness",
        collections.channel_effectiveness(tables["collection_activity"]),
    )
    put("collection_segment_effectiveness", collections.segment_effectiveness(tables))
    behavior = put("payment_behavior", collections.payment_behavior(tables, as_of))
    put("payment_behavior_summary", collections.payer_segment_summary(behavior))
    put("collection_priority_queue", collections.collection_queue(tables, aging, behavior))

    summary = collections.collections_summary(tables, as_of)
    files.write_json_summary(summary, f"{folder}/collections_summary.json")
    return done


def publish_star(tables: Tables, reports: Tables, folder: str, as_of: dt.date) -> None:
    """The star schema, its pass-through facts taken from the published reports."""
    files.export_star(
        {
            "dim_merchant": star.dim_merchant(tables),
            "dim_date": star.dim_date(star.fact_calendar(tables, as_of)),
            "fact_invoices": star.fact_invoices(tables),
            "fact_payments": reports["reconciliation_payments"],
            "fact_collection_activity": star.fact_collection_activity(tables),
            "fact_leakage": reports["revenue_leakage"],
            "fact_ar_aging": reports["ar_aging"],
        },
        folder,
    )
