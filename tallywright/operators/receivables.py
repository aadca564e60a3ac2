"""Receivables: aging of open invoices and days sales outstanding."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import labels
from tallywright.functions.dates import days_between, month_label, trailing
from tallywright.functions.numeric import dbl, percent, ratio, round_dp, sum_where, zero
from tallywright.functions.relational import label_spine, overall
from tallywright.model import Tables
from tallywright.operators.ledger import not_void, settled_invoices

OPEN_FROM = "0.01"  # fixed value: smallest balance that counts as open
WINDOW_DAYS = 90


def is_open(amount: Column) -> Column:
    return amount > F.lit(OPEN_FROM).cast("decimal(18,2)")


def ar_aging(tables: Tables, as_of: dt.date) -> DataFrame:
    """Open invoices with days overdue, aging bucket, risk and merchant attributes.

    Merchants pack so well in files that Spark's estimate of them is low, so they are never
    broadcast: both sides meet in a shuffle.
    """
    merchants = tables["merchants"].select("merchant_id", "merchant_name", "merchant_segment")
    overdue = F.col("days_overdue")
    return (
        settled_invoices(tables, not_void(tables["invoices"]))
        .withColumnRenamed("balance", "outstanding_amount")
        .where(is_open(F.col("outstanding_amount")))
        .withColumn("days_overdue", days_between(F.lit(as_of), F.col("due_date")))
        .withColumn("aging_bucket", labels.aging_bucket(overdue))
        .withColumn("risk_category", labels.ar_risk(F.col("outstanding_amount"), overdue))
        .join(merchants.hint("merge"), "merchant_id", "left")
        .select(
            "merchant_id", "merchant_name", "merchant_segment", "invoice_id", "invoice_date",
            "due_date", "total_invoice_amount", "total_paid", "total_credited",
            "outstanding_amount", "days_overdue", "aging_bucket", "risk_category",
        )
    )


def aging_summary(aging: DataFrame) -> DataFrame:
    """Per bucket in age order; a bucket without invoices stays as a NULL row."""
    per_bucket = aging.groupBy("aging_bucket").agg(
        F.count("invoice_id").alias("invoice_count"),
        F.sum("outstanding_amount").alias("total_outstanding"),
    )
    total = overall(F.col("total_outstanding"))
    return (
        label_spine(aging, "aging_bucket", labels.AGING_LABELS)
        .join(per_bucket, "aging_bucket", "left")
        .orderBy("label_order")
        .select(
            "aging_bucket", "invoice_count", "total_outstanding",
            percent(F.col("total_outstanding"), total).alias("percent_of_total_ar"),
        )
    )


def ar_cumulative(aging: DataFrame) -> DataFrame:
    """Current, overdue and the cumulative 30+, 60+ and 90+ balances."""
    age, amount = F.col("days_overdue"), F.col("outstanding_amount")
    return aging.agg(
        sum_where(age <= 0, amount).alias("current_ar"),
        sum_where(age > 0, amount).alias("overdue_ar"),
        sum_where(age > 30, amount).alias("ar_30_plus"),
        sum_where(age > 60, amount).alias("ar_60_plus"),
        sum_where(age > 90, amount).alias("ar_90_plus"),
        zero(F.sum(amount)).alias("total_ar"),
    )


def _dso(ar: Column, sales: Column, days: Column | int) -> Column:
    factor = days if isinstance(days, Column) else F.lit(float(days))
    return round_dp(ratio(ar, sales) * dbl(factor), 1)


def dso_overall(tables: Tables, as_of: dt.date, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Receivables dated up to ``as_of`` over trailing sales; Void counts as sales only."""
    held = (F.col("invoice_status") != "Void") & (F.col("invoice_date") <= F.lit(as_of))
    sold = trailing(F.col("invoice_date"), as_of, window_days)
    totals = settled_invoices(tables).agg(
        sum_where(held, F.col("balance")).alias("total_ar"),
        sum_where(sold, F.col("billed_fee")).alias("trailing_credit_sales"),
    )
    return totals.select(
        zero(F.col("total_ar")).alias("total_ar"),
        zero(F.col("trailing_credit_sales")).alias("trailing_credit_sales"),
        _dso(F.col("total_ar"), F.col("trailing_credit_sales"), window_days).alias("dso_days"),
    )


def dso_monthly(tables: Tables) -> DataFrame:
    """Per invoice month: sales, what is still open of that month, DSO over its days."""
    month = F.trunc("invoice_date", "MM")
    monthly = (
        settled_invoices(tables, not_void(tables["invoices"]))
        .groupBy(month.alias("_month"))
        .agg(F.sum("billed_fee").alias("credit_sales"), F.sum("balance").alias("month_end_ar"))
    )
    days = F.dayofmonth(F.last_day("_month"))
    return monthly.orderBy("_month").select(
        month_label(F.col("_month")).alias("month"), "credit_sales", "month_end_ar",
        _dso(F.col("month_end_ar"), F.col("credit_sales"), days).alias("dso_days"),
    )


def dso_by(
    tables: Tables, group: str, as_of: dt.date, window_days: int = WINDOW_DAYS
) -> DataFrame:
    """DSO per ``merchant_id`` or any merchant attribute.

    Invoices are reduced to one row per merchant before they meet the merchant
    table, so a dominant merchant does not travel row by row.
    """
    sold = trailing(F.col("invoice_date"), as_of, window_days)
    per_merchant = (
        settled_invoices(tables, not_void(tables["invoices"]))
        .groupBy("merchant_id")
        .agg(
            F.sum("balance").alias("total_ar"),
            sum_where(sold, F.col("billed_fee")).alias("trailing_credit_sales"),
        )
    )
    attributes = ["merchant_id"] if group == "merchant_id" else ["merchant_id", group]
    grouped = per_merchant.join(tables["merchants"].select(*attributes), "merchant_id")
    if group != "merchant_id":
        grouped = (
            grouped.where(F.col(group).isNotNull())
            .groupBy(group)
            .agg(
                F.sum("total_ar").alias("total_ar"),
                F.sum("trailing_credit_sales").alias("trailing_credit_sales"),
            )
        )
    dso = _dso(F.col("total_ar"), F.col("trailing_credit_sales"), window_days)
    return grouped.select(
        group, zero(F.col("total_ar")).alias("total_ar"), "trailing_credit_sales",
        dso.alias("dso_days"),
    ).orderBy(F.desc_nulls_last("dso_days"), group)
