"""BI measures over the star schema, by any merchant attribute or by month.

A measure is a quotient or sum of additive parts.  Parts from several facts are
tagged into one union, reduced to merchant and month, and only then joined to
the merchant dimension.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_label, month_start
from tallywright.functions.numeric import (
    count_where, money, percent, ratio, round_dp, sum_where, zero,
)
from tallywright.model import Tables
from tallywright.operators import star
from tallywright.operators.billing import billing_merchant_month
from tallywright.operators.leakage import leakage_events, realized
from tallywright.operators.ledger import successful
from tallywright.operators.receivables import WINDOW_DAYS, ar_aging

c = F.col
Part = tuple[DataFrame, str, Column, Column | None]  # fact, date column, numerator, denominator


def _last_days(date: Column, as_of: dt.date, days: int) -> Column:
    """The ``days`` calendar days that end on ``as_of``."""
    return (date > F.lit(as_of - dt.timedelta(days=days))) & (date <= F.lit(as_of))


def _parts(tables: Tables, name: str, as_of: dt.date) -> tuple[list[Part], str]:
    """Additive parts of a measure and how to combine them."""
    nothing = money(F.lit(0))
    invoices, payments = tables["invoices"], tables["payments"]
    if name in ("m_billed", "m_expected"):
        fee = c("billed_fee" if name == "m_billed" else "expected_fee")
        return [(invoices, "invoice_date", fee, nothing)], "sum"
    if name == "m_collected":
        return [(successful(payments), "payment_date", c("payment_amount"), nothing)], "sum"
    if name == "m_total_ar":
        return [(ar_aging(tables, as_of), "invoice_date", c("outstanding_amount"), nothing)], "sum"
    if name == "m_realization":
        return [
            (successful(payments), "payment_date", c("payment_amount"), nothing),
            (invoices, "invoice_date", nothing, c("billed_fee")),
        ], "percent"
    if name == "m_billing_accuracy":
        facts = star.fact_invoices(tables)
        correct = F.when(c("billing_status") == "Correct", c("expected_fee")).otherwise(nothing)
        return [(facts, "invoice_date", correct, c("expected_fee"))], "percent"
    if name == "m_ar90_share":
        old = F.when(c("aging_bucket") == "90+ days", c("outstanding_amount")).otherwise(nothing)
        return [(ar_aging(tables, as_of), "invoice_date", old, c("outstanding_amount"))], "percent"
    if name == "m_dso_t90":
        recent = invoices.where(_last_days(c("invoice_date"), as_of, WINDOW_DAYS))
        return [
            (ar_aging(tables, as_of), "invoice_date", c("outstanding_amount"), nothing),
            (recent, "invoice_date", nothing, c("billed_fee")),
        ], "days"
    if name == "m_collection_rate":
        billed = invoices.where(_last_days(c("invoice_date"), as_of, WINDOW_DAYS))
        cash = successful(payments).where(_last_days(c("payment_date"), as_of, WINDOW_DAYS))
        return [
            (cash, "payment_date", c("payment_amount"), nothing),
            (billed, "invoice_date", nothing, c("billed_fee")),
        ], "percent"
    if name in ("m_leakage_total", "m_leakage_outstanding"):
        events = realized(leakage_events(tables, billing_merchant_month(tables), as_of))
        if name == "m_leakage_outstanding":
            events = events.where(c("status") == "Outstanding")
        events = events.withColumn("detection_date", F.lit(as_of))
        return [(events, "detection_date", c("leakage_amount"), nothing)], "sum"
    if name == "m_recon_rate":
        matched = F.when(c("reconciliation_status") == "MATCHED", F.lit(1)).otherwise(F.lit(0))
        return [(star.fact_payments(tables), "payment_date", matched, F.lit(1))], "percent"
    raise ValueError(f"unknown measure: {name}")


TRAILING = ("m_dso_t90", "m_collection_rate")
MEASURES = (
    "m_billed", "m_expected", "m_collected", "m_total_ar",
    "m_realization", "m_billing_accuracy", "m_ar90_share", "m_dso_t90", "m_collection_rate",
    "m_leakage_total", "m_leakage_outstanding", "m_recon_rate",
)


def measure(tables: Tables, name: str, by: Sequence[str], as_of: dt.date) -> DataFrame:
    """``by`` lists merchant attributes and/or ``year_month``; empty means one total row.

    Trailing measures look back from ``as_of`` and have no value of earlier months; ask for
    them once per period end instead.
    """
    if name in TRAILING and "year_month" in by:
        raise ValueError(f"{name} looks back from its as-of date; it cannot be cut by year_month")
    parts, kind = _parts(tables, name, as_of)
    rows = None
    for fact, date, numerator, denominator in parts:
        part = fact.select(
            "merchant_id", month_label(c(date)).alias("year_month"),
            money(zero(money(numerator))).alias("num"), money(zero(money(denominator))).alias("den"),
        )
        rows = part if rows is None else rows.unionByName(part)
    attributes = [a for a in by if a not in ("merchant_id", "year_month")]
    kept = ["merchant_id"] if attributes or "merchant_id" in by else []
    kept += ["year_month"] if "year_month" in by else []
    sums = [F.sum("num").alias("num"), F.sum("den").alias("den")]
    totals = rows.groupBy(*kept).agg(*sums)
    if attributes:
        dim = star.dim_merchant(tables).select("merchant_id", *attributes)
        totals = totals.join(dim, "merchant_id", "left").groupBy(*by).agg(*sums)
    value = {
        "percent": percent(c("num"), c("den")),
        "days": round_dp(ratio(c("num"), c("den")) * F.lit(float(WINDOW_DAYS)), 1),
        "sum": c("num"),
    }[kind]
    return totals.select(*by, value.alias(name))


def growth_mom(tables: Tables) -> DataFrame:
    """Billed revenue against the previous calendar month, NULL when that has none."""
    monthly = tables["invoices"].groupBy(month_start(c("invoice_date")).alias("_month")).agg(
        F.sum("billed_fee").alias("billed_revenue")
    )
    prior = monthly.select(
        F.add_months("_month", 1).alias("_month"), c("billed_revenue").alias("prior_revenue")
    )
    growth = percent(c("billed_revenue") - c("prior_revenue"), c("prior_revenue"))
    return monthly.join(prior, "_month", "left").orderBy("_month").select(
        month_label(c("_month")).alias("year_month"), "billed_revenue", "prior_revenue",
        growth.alias("m_growth_mom"),
    )


def billed_vs_collected(tables: Tables) -> DataFrame:
    """Both by their own month; a month with either side appears."""
    none = money(F.lit(None))
    billed = tables["invoices"].select(
        month_label(c("invoice_date")).alias("year_month"), c("billed_fee").alias("billed"),
        none.alias("collected"),
    )
    cash = successful(tables["payments"]).select(
        month_label(c("payment_date")).alias("year_month"), none.alias("billed"),
        c("payment_amount").alias("collected"),
    )
    return billed.unionByName(cash).groupBy("year_month").agg(
        zero(F.sum("billed")).alias("billed_revenue"),
        zero(F.sum("collected")).alias("collected_revenue"),
    ).orderBy("year_month")


def _by_merchant(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy("merchant_id").agg(F.sum(value).alias(value))


def revenue_by_segment(tables: Tables) -> DataFrame:
    segments = tables["merchants"].select("merchant_id", "merchant_segment")
    return (
        _by_merchant(tables["invoices"], "billed_fee").join(segments, "merchant_id")
        .groupBy("merchant_segment").agg(F.sum("billed_fee").alias("billed_revenue"))
        .orderBy(F.desc("billed_revenue"), "merchant_segment")
    )


def top_merchants(tables: Tables, top: int = 10) -> DataFrame:
    names = tables["merchants"].select("merchant_id", "merchant_name")
    return (
        _by_merchant(tables["invoices"], "billed_fee").join(names, "merchant_id")
        .select("merchant_id", "merchant_name", c("billed_fee").alias("billed_revenue"))
        .orderBy(F.desc("billed_revenue"), "merchant_id").limit(top)
    )


def expected_vs_billed(tables: Tables) -> DataFrame:
    return tables["invoices"].groupBy(month_label(c("invoice_date")).alias("year_month")).agg(
        F.sum("expected_fee").alias("expected_revenue"),
        F.sum("billed_fee").alias("billed_revenue"),
    ).orderBy("year_month")


def leakage_by_type(events: DataFrame) -> DataFrame:
    """All types, advisory ones included."""
    return events.groupBy("leakage_type").agg(
        F.sum("leakage_amount").alias("leakage_amount")
    ).orderBy(F.desc("leakage_amount"), "leakage_type")


def leakage_top(events: DataFrame, merchants: DataFrame, top: int = 15) -> DataFrame:
    names = merchants.select("merchant_id", "merchant_name")
    return (
        _by_merchant(realized(events), "leakage_amount").join(names, "merchant_id")
        .select("merchant_id", "merchant_name", "leakage_amount")
        .orderBy(F.desc("leakage_amount"), "merchant_id").limit(top)
    )


def billing_status_counts(billing: DataFrame) -> DataFrame:
    return billing.groupBy("billing_status").agg(
        F.count(F.lit(1)).alias("merchant_months")
    ).orderBy("billing_status")


def merchant_invoice_detail(tables: Tables, merchant: Column) -> DataFrame:
    """Invoices of the merchants that satisfy the condition."""
    return star.fact_invoices(tables).where(merchant)


def ar_bucket_by_segment(aging: DataFrame) -> DataFrame:
    """Segment by bucket, 0 where nothing is open."""
    per_merchant = aging.groupBy("merchant_segment")
    from_bucket = {
        "Current": "current_ar", "1-30 days": "days_1_30", "31-60 days": "days_31_60",
        "61-90 days": "days_61_90", "90+ days": "days_90_plus",
    }
    return per_merchant.agg(*[
        sum_where(c("aging_bucket") == bucket, c("outstanding_amount")).alias(name)
        for bucket, name in from_bucket.items()
    ])


def success_by_channel_segment(tables: Tables) -> DataFrame:
    received = count_where(c("outcome") == "Payment Received")
    per_merchant = (
        tables["collection_activity"].where(c("contact_channel").isNotNull())
        .groupBy("merchant_id", "contact_channel")
        .agg(F.count("outcome").alias("n"), received.alias("r"))
    )
    segments = tables["merchants"].select("merchant_id", "merchant_segment")
    return (
        per_merchant.join(segments, "merchant_id")
        .groupBy("contact_channel", "merchant_segment")
        .agg(
            F.sum("n").alias("total_activities"),
            F.sum("r").alias("payments_received"),
            percent(F.sum("r"), F.sum("n")).alias("success_rate_percent"),
        )
    )


def recon_status_counts(payments: DataFrame) -> DataFrame:
    return payments.groupBy("reconciliation_status").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("payment_amount").alias("payment_amount"),
    ).orderBy("reconciliation_status")


def mismatch_types(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Exceptions by kind: overpaid invoices, all others on payments."""
    kinds = ("DUPLICATE", "TIMING_MISMATCH", "ORPHAN", "UNMATCHED")
    status = "reconciliation_status"
    found = payments.where(c(status).isin(*kinds)).select(status).unionByName(
        invoices.where(c(status) == "AMOUNT_MISMATCH").select(status)
    )
    return found.groupBy(status).agg(F.count(F.lit(1)).alias("item_count")).orderBy(status)


def leakage_trend(events: DataFrame, as_of: dt.date) -> DataFrame:
    """Realized leakage by month of detection, which is the as-of date of each load."""
    return realized(events).groupBy(month_label(F.lit(as_of)).alias("year_month")).agg(
        F.count(F.lit(1)).alias("leakage_count"), F.sum("leakage_amount").alias("leakage_amount")
    )


def top_control_failures(payments: DataFrame, top: int | None = None) -> DataFrame:
    """Unmatched or duplicate payments, highest value first; all of them unless ``top`` is given."""
    ranked = (
        payments.where(c("reconciliation_status").isin("UNMATCHED", "DUPLICATE"))
        .select("payment_id", "invoice_id", "merchant_id", "payment_amount", "reconciliation_status")
        .orderBy(F.desc("payment_amount"), "payment_id")
    )
    return ranked if top is None else ranked.limit(top)

