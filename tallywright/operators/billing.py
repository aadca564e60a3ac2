"""Billing validation: contract-rate revenue against billed revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_label
from tallywright.functions.numeric import count_where, money, percent, sum_where
from tallywright.model import Tables
from tallywright.operators.ledger import uninvoiced_months

TRANSITION_DAYS = 45  # fixed value: how long after a contract start an error counts as pricing
TOLERANCE = "0.01"
ERROR_STATUSES = ("Missing Invoice", "Overbilled", "Pricing Mismatch", "Underbilled")


def within_tolerance(difference: Column) -> Column:
    """True also for an unknown difference."""
    return F.coalesce(F.abs(difference) <= F.lit(TOLERANCE).cast("decimal(18,2)"), F.lit(True))


def with_transition_flag(invoices: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add ``near_transition``: the latest contract start on or before the period start is at
    most 45 days before it.

    The latest start is the closest one, so the test is whether *any* start lies
    in that window.  Each merchant's distinct start days (one per calendar day
    at most) are looked up with one equi-join; no rows are paired by range.
    Spark's estimate of the lists is low, and a broadcast of them would grow with the merchants
    on the driver, so both sides meet in a shuffle.
    """
    starts = contracts.where(F.col("effective_from").isNotNull()).groupBy("merchant_id").agg(
        F.collect_set("effective_from").alias("_starts")
    )
    period = F.col("billing_period_start")
    recent = F.exists(
        "_starts", lambda s: (s <= period) & (s >= F.date_sub(period, TRANSITION_DAYS))
    )
    return (
        invoices.join(starts.hint("merge"), "merchant_id", "left")
        .withColumn("near_transition", F.coalesce(recent, F.lit(False)))
        .drop("_starts")
    )


def near_contract_transition(invoices: DataFrame, contracts: DataFrame) -> DataFrame:
    """The invoices issued just after a contract start."""
    return with_transition_flag(invoices, contracts).where("near_transition").select(
        "invoice_id", "merchant_id", "billing_period_start"
    )


def billing_status(invoices: DataFrame, contracts: DataFrame) -> DataFrame:
    difference = F.col("revenue_difference")
    status = (
        F.when(within_tolerance(difference), "Correct")
        .when(F.col("near_transition"), "Pricing Mismatch")
        .when(difference < 0, "Underbilled")
        .otherwise("Overbilled")
    )
    return (
        with_transition_flag(invoices, contracts)
        .withColumn("revenue_difference", money(F.col("billed_fee") - F.col("expected_fee")))
        .withColumn("variance_percent", percent(difference, F.col("expected_fee")))
        .withColumn("billing_status", status)
    )


def billing_missing_months(tables: Tables) -> DataFrame:
    return uninvoiced_months(tables["transactions"], tables["invoices"], exact_start=True).select(
        "merchant_id", F.col("month").alias("billing_period_start"), "gross_transaction_value",
        "expected_revenue",
    )


def billing_merchant_month(tables: Tables) -> DataFrame:
    """Every invoice with its status, and a row for every merchant-month never invoiced."""
    invoices = tables["invoices"]
    invoiced = billing_status(invoices, tables["contracts"]).select(
        "merchant_id",
        month_label(F.col("billing_period_start")).alias("billing_period"),
        "invoice_id",
        F.col("expected_fee").alias("expected_revenue"),
        F.col("billed_fee").alias("actual_billed_revenue"),
        "revenue_difference", "variance_percent", "billing_status",
    )
    expected = money(F.col("expected_revenue"))
    missing = billing_missing_months(tables).select(
        "merchant_id",
        month_label(F.col("billing_period_start")).alias("billing_period"),
        F.lit(None).cast(invoices.schema["invoice_id"].dataType).alias("invoice_id"),
        expected.alias("expected_revenue"),
        money(F.lit(0)).alias("actual_billed_revenue"),
        money(-expected).alias("revenue_difference"),
        F.lit(-100.0).alias("variance_percent"),
        F.lit("Missing Invoice").alias("billing_status"),
    )
    return invoiced.unionByName(missing)


def billing_status_summary(billing: DataFrame) -> DataFrame:
    """Count per status and the shortfall of underbilled and mispriced invoices."""
    short = F.col("billing_status").isin("Underbilled", "Pricing Mismatch")
    return billing.groupBy("billing_status").agg(
        F.count(F.lit(1)).alias("merchant_months"),
        sum_where(short, -F.col("revenue_difference")).alias("leakage_amount"),
    )


def _errors_by_merchant(billing: DataFrame) -> DataFrame:
    return billing.where(F.col("billing_status") != "Correct").groupBy("merchant_id")


def billing_errors_by_segment(billing: DataFrame, merchants: DataFrame) -> DataFrame:
    """Segment by error status, 0 where a combination does not occur."""
    counts = _errors_by_merchant(billing).agg(*[
        count_where(F.col("billing_status") == s).alias(s) for s in ERROR_STATUSES
    ])
    return (
        counts.join(merchants.select("merchant_id", "merchant_segment"), "merchant_id")
        .where(F.col("merchant_segment").isNotNull())
        .groupBy("merchant_segment")
        .agg(*[F.sum(s).alias(s.lower().replace(" ", "_")) for s in ERROR_STATUSES])
    )


def billing_accuracy_count(billing: DataFrame) -> DataFrame:
    correct = count_where(F.col("billing_status") == "Correct")
    return billing.agg(
        correct.alias("correct_count"),
        F.count(F.lit(1)).alias("merchant_months"),
        percent(correct, F.count(F.lit(1))).alias("billing_accuracy_percent"),
    )


def billing_repeat_offenders(billing: DataFrame, top: int = 10) -> DataFrame:
    return (
        _errors_by_merchant(billing)
        .agg(F.count(F.lit(1)).alias("error_count"))
        .orderBy(F.desc("error_count"), "merchant_id")
        .limit(top)
    )
