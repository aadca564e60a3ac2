"""Reconciliation of payments and invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_label
from tallywright.functions.numeric import money, percent, zero
from tallywright.functions.relational import overall
from tallywright.model import Tables
from tallywright.operators.ledger import SUCCESS, applied, uninvoiced_months

TOLERANCE = 1  # fixed value: money units an invoice may be off and still match


def repeated_payments(payments: DataFrame) -> DataFrame:
    """(invoice, amount) pairs paid successfully more than once."""
    return (
        applied(payments)
        .groupBy("invoice_id", "payment_amount")
        .agg(F.count(F.lit(1)).alias("payment_count"))
        .where(F.col("payment_count") > 1)
    )


def _settled_early() -> Column:
    return F.coalesce(F.col("settlement_date") < F.col("payment_date"), F.lit(False))


def reconcile_payments(tables: Tables) -> DataFrame:
    """Status per payment.

    Payments that need no lookup (not successful, or naming no invoice) skip the
    joins, so a mass of NULL invoice ids never lands in one partition.
    """
    payments = tables["payments"]
    success = F.col("payment_status").eqNullSafe(SUCCESS)
    known = tables["invoices"].select("invoice_id", F.lit(True).alias("_known")).distinct()
    repeated = repeated_payments(payments).select(
        "invoice_id", "payment_amount", F.lit(True).alias("_repeated")
    )
    status = (
        F.when(F.col("_known").isNull(), "UNMATCHED")
        .when(F.col("_repeated").isNotNull(), "DUPLICATE")
        .when(_settled_early(), "TIMING_MISMATCH")
        .otherwise("MATCHED")
    )
    looked_up = (
        applied(payments)
        .join(known, "invoice_id", "left")
        .join(repeated, ["invoice_id", "payment_amount"], "left")
        .withColumn("reconciliation_status", status)
    )
    orphans = payments.where(success & F.col("invoice_id").isNull()).withColumn(
        "reconciliation_status", F.lit("ORPHAN")
    )
    other = payments.where(~success).withColumn(
        "reconciliation_status",
        F.concat(F.lit("NOT_APPLICABLE_"), F.upper("payment_status")),
    )
    columns = (
        "payment_id", "invoice_id", "merchant_id", "payment_date", "payment_amount",
        "payment_status", "reconciliation_status",
    )
    return (
        looked_up.select(*columns)
        .unionByName(orphans.select(*columns))
        .unionByName(other.select(*columns))
    )


def reconcile_invoices(tables: Tables) -> DataFrame:
    """Status per invoice, the most urgent finding first.

    Payments collapse to (invoice, amount) and then to invoice: repeats show up
    as a count above 1 in the first step and no window over payments is needed.
    """
    per_amount = (
        applied(tables["payments"])
        .groupBy("invoice_id", "payment_amount")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("payment_amount").alias("paid"),
            F.bool_or(_settled_early()).alias("early"),
        )
    )
    per_invoice = per_amount.groupBy("invoice_id").agg(
        F.sum("paid").alias("total_paid"),
        F.sum("n").alias("payment_count"),
        F.bool_or(F.col("n") > 1).alias("has_repeat"),
        F.bool_or("early").alias("has_early"),
    )
    variance = F.col("variance")
    status = (
        F.when(F.col("invoice_status") == "Void", "VOID")
        .when(F.col("payment_count") == 0, "MISSING_PAYMENT")
        .when(F.col("has_repeat"), "DUPLICATE")
        .when(variance > TOLERANCE, "AMOUNT_MISMATCH")
        .when(F.col("has_early"), "TIMING_MISMATCH")
        .when(variance < -TOLERANCE, "PARTIAL")
        .otherwise("MATCHED")
    )
    return (
        tables["invoices"]
        .join(per_invoice, "invoice_id", "left")
        .withColumns({
            "total_paid": zero(F.col("total_paid")),
            "payment_count": F.coalesce("payment_count", F.lit(0).cast("bigint")),
        })
        .withColumn("variance", money(F.col("total_paid") - F.col("total_invoice_amount")))
        .withColumn("reconciliation_status", status)
        .select(
            "invoice_id", "merchant_id", "total_invoice_amount", "total_paid", "payment_count",
            "variance", "reconciliation_status",
        )
    )


def reconcile_missing_invoices(tables: Tables) -> DataFrame:
    return uninvoiced_months(tables["transactions"], tables["invoices"]).select(
        "merchant_id",
        month_label(F.col("month")).alias("billing_period"),
        "transaction_count", "gross_transaction_value",
        F.lit("MISSING_INVOICE").alias("reconciliation_status"),
    )


def reconciliation_summary(invoice_status: DataFrame, missing: DataFrame) -> DataFrame:
    """Count and share per status; the rate counts MATCHED over everything listed."""
    status = "reconciliation_status"
    counts = (
        invoice_status.select(status)
        .unionByName(missing.select(status))
        .groupBy(status)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    total = overall(F.col("count"))
    matched = overall(F.when(F.col(status) == "MATCHED", F.col("count")).otherwise(0))
    return counts.select(
        status, "count",
        percent(F.col("count"), total).alias("percent_of_total"),
        percent(matched, total).alias("reconciliation_rate_percent"),
    ).orderBy(F.desc("count"), status)
