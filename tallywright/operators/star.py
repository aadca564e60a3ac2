"""Star schema: two dimensions and five facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_label
from tallywright.functions.numeric import money
from tallywright.model import TABLES, Tables
from tallywright.operators.billing import billing_status
from tallywright.operators.leakage import leakage_events, leakage_table
from tallywright.operators.receivables import ar_aging
from tallywright.operators.reconciliation import reconcile_payments

DIM_MERCHANT = (
    "merchant_id", "merchant_name", "industry", "merchant_segment", "city", "state", "country",
    "onboarding_date", "account_manager", "pricing_plan", "agreed_fee_percent",
    "monthly_subscription_fee", "payment_terms_days", "merchant_status",
)
FACT_ACTIVITY = (
    "collection_id", "merchant_id", "invoice_id", "activity_date", "activity_type",
    "contact_channel", "collector", "outcome", "promised_payment_date", "promised_amount",
)


def _typed(df: DataFrame, table: str, columns: tuple[str, ...]) -> list[Column]:
    """The listed columns; one the input lacks is NULL of its declared type."""
    declared = TABLES[table].schema
    return [
        F.col(c) if c in df.columns else F.lit(None).cast(declared[c].dataType).alias(c)
        for c in columns
    ]


def dim_merchant(tables: Tables) -> DataFrame:
    return tables["merchants"].select(*_typed(tables["merchants"], "merchants", DIM_MERCHANT))


def dim_date(days: DataFrame) -> DataFrame:
    """One row per day of ``days(first_day, last_day)``, a single-row frame."""
    day = F.col("date")
    return days.select(
        F.explode(F.sequence("first_day", "last_day")).alias("date")
    ).select(
        "date",
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        month_label(day).alias("year_month"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        (day == F.last_day(day)).alias("is_month_end"),
    )


def fact_calendar(tables: Tables, as_of: dt.date) -> DataFrame:
    """Whole years around every date of the five facts; leakage is dated ``as_of``."""
    spans = [
        tables[name].agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))
        for name, columns in CALENDAR_DATES.items() for column in columns
    ]
    span = tables["invoices"].sparkSession.createDataFrame([(as_of, as_of)], "first_day date, last_day date")
    for other in spans:
        span = span.unionByName(other)
    first, last = F.year(F.min("first_day")), F.year(F.max("last_day"))
    return span.agg(
        F.make_date(first, F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(last, F.lit(12), F.lit(31)).alias("last_day"),
    )


def fact_invoices(tables: Tables) -> DataFrame:
    return billing_status(tables["invoices"], tables["contracts"]).select(
        "invoice_id", "merchant_id", "billing_period_start", "invoice_date", "due_date",
        "total_invoice_amount", "expected_fee", "billed_fee", "invoice_status", "payment_status",
        money(F.col("revenue_difference")).alias("revenue_difference"), "billing_status",
    )


def fact_payments(tables: Tables) -> DataFrame:
    return reconcile_payments(tables)


def fact_collection_activity(tables: Tables) -> DataFrame:
    activity = tables["collection_activity"]
    return activity.select(*_typed(activity, "collection_activity", FACT_ACTIVITY))


def star(tables: Tables, billing: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """All seven frames by name."""
    return {
        "dim_merchant": dim_merchant(tables),
        "dim_date": dim_date(fact_calendar(tables, as_of)),
        "fact_invoices": fact_invoices(tables),
        "fact_payments": fact_payments(tables),
        "fact_collection_activity": fact_collection_activity(tables),
        "fact_leakage": leakage_table(leakage_events(tables, billing, as_of), as_of),
        "fact_ar_aging": ar_aging(tables, as_of),
    }


CALENDAR_DATES = {
    "invoices": ("billing_period_start", "invoice_date", "due_date"),
    "payments": ("payment_date", "settlement_date"),
    "collection_activity": ("activity_date", "promised_payment_date"),
}

# Date that places a fact row in a month, for partitioned files.
FACT_DATES = {
    "fact_invoices": "invoice_date",
    "fact_payments": "payment_date",
    "fact_collection_activity": "activity_date",
    "fact_leakage": "detection_date",
    "fact_ar_aging": "invoice_date",
}
