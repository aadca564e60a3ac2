"""Per-invoice settlement totals shared by all receivables operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_start
from tallywright.functions.numeric import money, zero
from tallywright.model import Tables

SUCCESS = "Success"
COUNTED_CREDITS = ("Issued", "Applied")  # fixed values: credit notes that reduce a balance


def successful(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("payment_status") == SUCCESS)


def applied(payments: DataFrame) -> DataFrame:
    """Successful payments that name an invoice."""
    return successful(payments).where(F.col("invoice_id").isNotNull())


def counted_credits(credit_notes: DataFrame) -> DataFrame:
    return credit_notes.where(F.col("status").isin(*COUNTED_CREDITS))


def not_void(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("invoice_status") != "Void")


def paid_by_invoice(payments: DataFrame) -> DataFrame:
    return applied(payments).groupBy("invoice_id").agg(
        F.sum("payment_amount").alias("total_paid"),
        F.count(F.lit(1)).alias("payment_count"),
    )


def credited_by_invoice(credit_notes: DataFrame) -> DataFrame:
    return (
        counted_credits(credit_notes)
        .groupBy("invoice_id")
        .agg(F.sum("credit_amount").alias("total_credited"))
    )


def payment_dates(payments: DataFrame) -> DataFrame:
    return applied(payments).groupBy("invoice_id").agg(
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
    )


def settlements(tables: Tables) -> DataFrame:
    """Payments and credit notes rolled up by invoice in one aggregate.

    Tagging both sources into one union costs a single shuffle of partial sums
    instead of one per source; unused measures are pruned by the optimizer.
    """
    paid = applied(tables["payments"]).select(
        "invoice_id",
        F.col("payment_amount").alias("paid"),
        F.lit(None).cast("decimal(18,2)").alias("credited"),
        "payment_date",
    )
    credited = (
        counted_credits(tables["credit_notes"])
        .where(F.col("invoice_id").isNotNull())
        .select(
            "invoice_id",
            F.lit(None).cast("decimal(18,2)").alias("paid"),
            F.col("credit_amount").alias("credited"),
            F.lit(None).cast("date").alias("payment_date"),
        )
    )
    return paid.unionByName(credited).groupBy("invoice_id").agg(
        F.sum("paid").alias("total_paid"),
        F.sum("credited").alias("total_credited"),
        F.max("payment_date").alias("last_payment_date"),
    )


def balance() -> Column:
    return money(F.col("total_invoice_amount") - F.col("total_paid") - F.col("total_credited"))


def settled_invoices(tables: Tables, invoices: DataFrame | None = None) -> DataFrame:
    """Invoices with total paid, total credited and the remaining balance."""
    base = tables["invoices"] if invoices is None else invoices
    return (
        base.join(settlements(tables), "invoice_id", "left")
        .withColumns({
            "total_paid": zero(F.col("total_paid")),
            "total_credited": zero(F.col("total_credited")),
        })
        .withColumn("balance", balance())
    )


def paid_invoices(tables: Tables, invoices: DataFrame | None = None) -> DataFrame:
    """Invoices with payments only: credit notes are not netted here."""
    base = tables["invoices"] if invoices is None else invoices
    return base.join(paid_by_invoice(tables["payments"]), "invoice_id", "left").withColumns({
        "total_paid": zero(F.col("total_paid")),
        "payment_count": F.coalesce("payment_count", F.lit(0).cast("bigint")),
    })


def open_balance(tables: Tables) -> DataFrame:
    return settled_invoices(tables, not_void(tables["invoices"])).select(
        "invoice_id", "merchant_id", "total_invoice_amount", "total_paid", "total_credited",
        F.col("balance").alias("outstanding_amount"),
    )


def transaction_months(transactions: DataFrame) -> DataFrame:
    """Successful volume by merchant and calendar month."""
    return (
        transactions.where((F.col("payment_status") == SUCCESS) & F.col("merchant_id").isNotNull())
        .groupBy("merchant_id", month_start(F.col("transaction_date")).alias("month"))
        .agg(
            F.count("transaction_amount").alias("transaction_count"),
            F.sum("transaction_amount").alias("gross_transaction_value"),
            F.sum("expected_platform_fee").alias("expected_revenue"),
        )
        .where(F.col("month").isNotNull())
    )


def uninvoiced_months(
    transactions: DataFrame, invoices: DataFrame, *, exact_start: bool = False
) -> DataFrame:
    """Merchant-months with successful transactions and no invoice.

    ``exact_start`` asks for an invoice whose period starts on the first of the
    month; otherwise any invoice period starting within the month counts.
    """
    start = F.col("billing_period_start")
    billed = invoices.select(
        "merchant_id", (start if exact_start else month_start(start)).alias("month")
    ).distinct()
    if "expected_platform_fee" not in transactions.columns:
        transactions = transactions.withColumn(
            "expected_platform_fee", F.lit(None).cast("decimal(18,2)")
        )
    return transaction_months(transactions).join(billed, ["merchant_id", "month"], "left_anti")
