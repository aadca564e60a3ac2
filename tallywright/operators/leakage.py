"""Revenue leakage: money owed but not collected, and two advisory reviews."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import labels
from tallywright.functions.dates import month_label
from tallywright.functions.numeric import (
    dbl, money, ratio, round_dp, sum_where, zero,
)
from tallywright.functions.relational import label_spine, number_rows
from tallywright.model import Tables
from tallywright.operators.ledger import SUCCESS, not_void

# Leakage types in report order; the last two before "Failed Payment" are advisory.
UNDERBILLING = "Underbilling"
PRICING = "Pricing Mismatch"
MISSING = "Missing Invoice"
REFUND_FEE = "Refund Fee Retention (Policy Review)"
RATE = "Rate Discrepancy"
FAILED = "Failed Payment"
TYPE_ORDER = (UNDERBILLING, PRICING, MISSING, REFUND_FEE, RATE, FAILED)
ADVISORY = (RATE, REFUND_FEE)
RECOVERY_LABELS = ("Recovered", "Recoverable", "Outstanding")
# Thresholds of the advisory reviews.
CREDIT_COVERAGE = "0.5"
MIN_RETAINED_FEE = 1
RATE_GAP = 0.05


def recovery_status(credit_notes: DataFrame) -> DataFrame:
    """Best credit note per invoice: Applied before Issued before Pending."""
    rank = labels.lookup(F.col("status"), {"Applied": 0, "Issued": 1, "Pending": 2}, None)
    return (
        credit_notes.where(F.col("invoice_id").isNotNull())
        .groupBy("invoice_id")
        .agg(F.min(rank.cast("int")).alias("_best"))
        .where(F.col("_best").isNotNull())
        .select(
            "invoice_id",
            F.when(F.col("_best") == 0, "Recovered").otherwise("Recoverable").alias("status"),
        )
    )


def credit_recovery_status(invoices: DataFrame, credit_notes: DataFrame) -> DataFrame:
    return invoices.select("invoice_id", "merchant_id").join(
        recovery_status(credit_notes), "invoice_id", "left"
    ).withColumn("status", F.coalesce("status", F.lit("Outstanding")))


def _event(
    leakage_type: Column, expected: Column, actual: Column, amount: Column, status: Column,
    *, invoice_id: Column, transaction_id: Column, period: Column,
) -> list[Column]:
    amount = money(amount)
    return [
        F.col("merchant_id"),
        transaction_id.alias("transaction_id"),
        invoice_id.alias("invoice_id"),
        period.alias("billing_period"),
        leakage_type.alias("leakage_type"),
        money(expected).alias("expected_amount"),
        money(actual).alias("actual_amount"),
        amount.alias("leakage_amount"),
        labels.leakage_severity(amount).alias("severity"),
        status.alias("status"),
    ]


def _null_of(df: DataFrame, column: str) -> Column:
    return F.lit(None).cast(df.schema[column].dataType)


def leakage_billing(tables: Tables, billing: DataFrame) -> DataFrame:
    """Underbilled invoices, and mispriced ones that fell short."""
    difference = F.col("revenue_difference")
    short = billing.where(
        (F.col("billing_status") == "Underbilled")
        | ((F.col("billing_status") == "Pricing Mismatch") & (difference < 0))
    ).join(recovery_status(tables["credit_notes"]), "invoice_id", "left")
    return short.select(*_event(
        F.when(F.col("billing_status") == "Underbilled", UNDERBILLING).otherwise(PRICING),
        F.col("expected_revenue"), F.col("actual_billed_revenue"), -difference,
        F.coalesce("status", F.lit("Outstanding")),
        invoice_id=F.col("invoice_id"),
        transaction_id=_null_of(tables["transactions"], "transaction_id"),
        period=F.col("billing_period"),
    ))


def leakage_missing_invoice(tables: Tables, billing: DataFrame) -> DataFrame:
    expected = F.col("expected_revenue")
    return billing.where(F.col("billing_status") == "Missing Invoice").select(*_event(
        F.lit(MISSING), expected, F.lit(0), expected, F.lit("Outstanding"),
        invoice_id=F.col("invoice_id"),
        transaction_id=_null_of(tables["transactions"], "transaction_id"),
        period=F.col("billing_period"),
    ))


def leakage_refund_fee(tables: Tables) -> DataFrame:
    """Fees kept on refunded volume where credits cover less than half of them.

    All credit notes count, whatever their status, and Void invoices take part.
    """
    fee_rate = ratio(F.col("expected_platform_fee"), F.col("transaction_amount"))
    kept = money(round_dp(dbl(F.col("refund_amount")) * fee_rate, 2))
    refunded = (
        tables["transactions"]
        .where(
            (F.col("refund_amount") > 0)
            & (F.col("payment_status") == SUCCESS)
            & F.col("merchant_id").isNotNull()
        )
        .groupBy("merchant_id", month_label(F.col("transaction_date")).alias("billing_period"))
        .agg(zero(F.sum(kept)).alias("fee"))
    )
    credits = (
        tables["credit_notes"].groupBy("invoice_id").agg(F.sum("credit_amount").alias("credited"))
    )
    invoices = (
        tables["invoices"]
        .select(
            "invoice_id", "merchant_id",
            month_label(F.col("billing_period_start")).alias("billing_period"),
        )
        .join(credits, "invoice_id", "left")
    )
    fee, credited = F.col("fee"), F.col("credited")
    return (
        refunded.join(invoices, ["merchant_id", "billing_period"], "left")
        .withColumn("credited", zero(credited))
        .where(credited < fee * F.lit(CREDIT_COVERAGE).cast("decimal(2,1)"))
        .where(fee - credited > MIN_RETAINED_FEE)
        .select(*_event(
            F.lit(REFUND_FEE), F.lit(0), fee, fee - credited, F.lit("Under Review"),
            invoice_id=F.col("invoice_id"),
            transaction_id=_null_of(tables["transactions"], "transaction_id"),
            period=F.col("billing_period"),
        ))
    )


def leakage_rate_discrepancy(tables: Tables) -> DataFrame:
    """Transactions whose applied rate differs from the rate their expected fee implies."""
    amount, fee = F.col("transaction_amount"), F.col("expected_platform_fee")
    applied_rate = F.col("transaction_fee_percent")
    implied = F.try_divide(F.lit(100.0) * dbl(fee), dbl(amount))
    charged = money(amount * applied_rate * F.lit("0.01").cast("decimal(3,2)"))
    return (
        tables["transactions"]
        .where(F.col("payment_status") == SUCCESS)
        .where(F.abs(dbl(applied_rate) - implied) > RATE_GAP)
        .select(*_event(
            F.lit(RATE), fee, charged, F.abs(money(fee) - charged), F.lit("Recovered"),
            invoice_id=_null_of(tables["invoices"], "invoice_id"),
            transaction_id=F.col("transaction_id"),
            period=month_label(F.col("transaction_date")),
        ))
    )


def leakage_failed_payment(tables: Tables, as_of: dt.date) -> DataFrame:
    """Overdue invoices with failed attempts only."""
    status = F.col("payment_status")
    failed_only = (
        tables["payments"]
        .where(F.col("invoice_id").isNotNull())
        .groupBy("invoice_id")
        .agg(
            F.bool_or(F.coalesce(status == "Failed", F.lit(False))).alias("failed"),
            F.bool_or(F.coalesce(status == SUCCESS, F.lit(False))).alias("paid"),
        )
        .where(F.col("failed") & ~F.col("paid"))
    )
    total = F.col("total_invoice_amount")
    return (
        not_void(tables["invoices"])
        .where(F.col("due_date") < F.lit(as_of))
        .join(failed_only, "invoice_id", "left_semi")
        .select(*_event(
            F.lit(FAILED), total, F.lit(0), total, F.lit("Outstanding"),
            invoice_id=F.col("invoice_id"),
            transaction_id=_null_of(tables["transactions"], "transaction_id"),
            period=F.lit(None).cast("string"),
        ))
    )


def leakage_events(tables: Tables, billing: DataFrame, as_of: dt.date) -> DataFrame:
    """All findings of the five builders, not numbered."""
    return (
        leakage_billing(tables, billing)
        .unionByName(leakage_missing_invoice(tables, billing))
        .unionByName(leakage_refund_fee(tables))
        .unionByName(leakage_rate_discrepancy(tables))
        .unionByName(leakage_failed_payment(tables, as_of))
    )


def leakage_table(events: DataFrame, as_of: dt.date) -> DataFrame:
    """Findings with sequential ids, ordered by type, merchant, period and document."""
    position = labels.lookup(
        F.col("leakage_type"), {t: n for n, t in enumerate(TYPE_ORDER)}, len(TYPE_ORDER)
    )
    order = [position.asc(), *[
        F.asc_nulls_first(c)
        for c in ("merchant_id", "billing_period", "invoice_id", "transaction_id")
    ]]
    return number_rows(events, "_n", order).select(
        F.format_string("LKG%07d", "_n").alias("leakage_id"),
        "merchant_id", "transaction_id", "invoice_id", "leakage_type", "expected_amount",
        "actual_amount", "leakage_amount", F.lit(as_of).alias("detection_date"), "severity",
        "status",
    )


def realized(events: DataFrame) -> DataFrame:
    return events.where(~F.col("leakage_type").isin(*ADVISORY))


def leakage_by(events: DataFrame, column: str) -> DataFrame:
    """Realized leakage by type, status or severity."""
    return realized(events).where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("leakage_amount").alias("leakage_count"),
        F.sum("leakage_amount").alias("leakage_amount"),
    ).orderBy(column)


def leakage_totals(events: DataFrame) -> DataFrame:
    amount = F.col("leakage_amount")
    return realized(events).agg(
        zero(F.sum(amount)).alias("total_leakage"),
        *[
            sum_where(F.col("status") == s, amount).alias(s.lower())
            for s in RECOVERY_LABELS
        ],
    )


def leakage_advisory_totals(events: DataFrame, billing: DataFrame) -> DataFrame:
    """Advisory findings, and the overbilled invoices left out of the leakage total."""
    advisory = events.where(F.col("leakage_type").isin(*ADVISORY)).select(
        F.col("leakage_type").alias("advisory_item"), F.col("leakage_amount")
    )
    overbilled = billing.where(
        (F.col("billing_status") == "Pricing Mismatch") & (F.col("revenue_difference") > 0)
    ).select(
        F.lit("Overbilled Pricing Mismatch").alias("advisory_item"),
        F.col("revenue_difference").alias("leakage_amount"),
    )
    return advisory.unionByName(overbilled).groupBy("advisory_item").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("leakage_amount").alias("notional_amount")
    ).orderBy("advisory_item")


def leakage_top_merchants(events: DataFrame, top: int = 10) -> DataFrame:
    return (
        realized(events).groupBy("merchant_id")
        .agg(F.sum("leakage_amount").alias("leakage_amount"))
        .orderBy(F.desc("leakage_amount"), "merchant_id")
        .limit(top)
    )


def leakage_severity_counts(events: DataFrame) -> DataFrame:
    """Count per severity in fixed order; a severity without events stays as NULL."""
    counts = realized(events).groupBy("severity").agg(F.count(F.lit(1)).alias("leakage_count"))
    return (
        label_spine(events, "severity", labels.SEVERITY_LABELS)
        .join(counts, "severity", "left")
        .orderBy("label_order")
        .select("severity", "leakage_count")
    )


def leakage_status_ordered(events: DataFrame) -> DataFrame:
    sums = realized(events).groupBy("status").agg(F.sum("leakage_amount").alias("leakage_amount"))
    return (
        label_spine(events, "status", RECOVERY_LABELS)
        .join(sums, "status", "left")
        .orderBy("label_order")
        .select("status", "leakage_amount")
    )

