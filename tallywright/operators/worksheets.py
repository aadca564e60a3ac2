"""The spreadsheet model's formulas as frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import labels
from tallywright.functions.dates import days_between, month_label
from tallywright.functions.numeric import count_where, money, percent, zero
from tallywright.functions.relational import label_spine
from tallywright.model import Tables
from tallywright.operators.billing import within_tolerance
from tallywright.operators.ledger import paid_invoices
from tallywright.operators.reconciliation import TOLERANCE

NOT_FOUND = "Not found"
PAID_BUCKET = "Excluded (paid)"
# Merchants per segment and transactions of the sample workbook.
SAMPLE_SIZES = {"Enterprise": 4, "Mid-Market": 8, "SMB": 14, "Long-tail": 14}
SAMPLE_SEED = 42
c = F.col


def _with_name(df: DataFrame, tables: Tables) -> DataFrame:
    names = tables["merchants"].select("merchant_id", "merchant_name")
    return df.join(names, "merchant_id", "left").withColumn(
        "merchant_name", F.coalesce("merchant_name", F.lit(NOT_FOUND))
    )


def invoice_validation(tables: Tables) -> DataFrame:
    """Three-way status; the variance is 0 when nothing was expected."""
    difference = c("revenue_difference")
    status = (
        F.when(within_tolerance(difference), "Correct")
        .when(difference < 0, "Underbilled")
        .otherwise("Overbilled")
    )
    variance = F.when(c("expected_fee") == 0, F.lit(0.0)).otherwise(
        percent(difference, c("expected_fee"))
    )
    return (
        _with_name(tables["invoices"], tables)
        .withColumn("revenue_difference", money(c("billed_fee") - c("expected_fee")))
        .select(
            "invoice_id", "merchant_id", "merchant_name", "expected_fee", "billed_fee",
            "revenue_difference", variance.alias("variance_percent"),
            status.alias("billing_status"),
        )
    )


def aging_sheet(tables: Tables, as_of: dt.date) -> DataFrame:
    """Every invoice, Void too; never negative; settled ones in their own bucket."""
    outstanding = F.greatest(money(F.lit(0)), money(c("total_invoice_amount") - c("total_paid")))
    bucket = F.when(c("outstanding_amount") == 0, PAID_BUCKET).otherwise(
        labels.aging_bucket(c("days_overdue"))
    )
    return (
        _with_name(paid_invoices(tables), tables)
        .withColumn("outstanding_amount", outstanding)
        .withColumn("days_overdue", days_between(F.lit(as_of), c("due_date")))
        .select(
            "invoice_id", "merchant_id", "merchant_name", "due_date", "total_invoice_amount",
            "total_paid", "outstanding_amount", "days_overdue", bucket.alias("aging_bucket"),
        )
    )


def aging_sheet_summary(sheet: DataFrame) -> DataFrame:
    per_bucket = sheet.groupBy("aging_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("outstanding_amount").alias("amount")
    )
    return (
        label_spine(sheet, "aging_bucket", labels.AGING_LABELS)
        .join(per_bucket, "aging_bucket", "left")
        .orderBy("label_order")
        .select(
            "aging_bucket",
            F.coalesce("n", F.lit(0)).alias("invoice_count"),
            zero(c("amount")).alias("total_outstanding"),
        )
    )


def reconciliation_sheet(tables: Tables) -> DataFrame:
    variance = money(c("total_paid") - c("total_invoice_amount"))
    status = (
        F.when(c("total_paid") == 0, "MISSING_PAYMENT")
        .when(F.abs(c("variance")) <= TOLERANCE, "MATCHED")
        .when(c("variance") > TOLERANCE, "AMOUNT_MISMATCH")
        .otherwise("PARTIAL")
    )
    return paid_invoices(tables).withColumn("variance", variance).select(
        "invoice_id", "merchant_id", "total_invoice_amount", "total_paid", "variance",
        status.alias("reconciliation_status"),
    )


def channel_sheet(tables: Tables) -> DataFrame:
    """Counts every activity of a channel, with or without an outcome."""
    total = F.count(F.lit(1))
    received = count_where(c("outcome") == "Payment Received")
    rate = F.when(total == 0, F.lit(0.0)).otherwise(percent(received, total))
    return (
        tables["collection_activity"].where(c("contact_channel").isNotNull())
        .groupBy("contact_channel")
        .agg(
            total.alias("total_activities"), received.alias("payments_received"),
            rate.alias("success_rate_percent"),
        )
        .orderBy("contact_channel")
    )


def monthly_mis(tables: Tables) -> DataFrame:
    expected, billed = F.sum("expected_fee"), F.sum("billed_fee")
    return tables["invoices"].groupBy(
        month_label(c("billing_period_start")).alias("billing_month")
    ).agg(
        F.count(F.lit(1)).alias("invoice_count"),
        zero(expected).alias("expected_revenue"),
        zero(billed).alias("billed_revenue"),
        (zero(billed) - zero(expected)).alias("revenue_variance"),
    ).orderBy("billing_month")


def kpi_dashboard(tables: Tables) -> DataFrame:
    """Nine headline figures as rows, from one row per source table."""
    correct = within_tolerance(c("billed_fee") - c("expected_fee"))
    open_amount = F.greatest(
        money(F.lit(0)), money(c("total_invoice_amount") - c("total_paid"))
    )
    invoices = paid_invoices(tables).agg(
        zero(F.sum("expected_fee")).alias("expected"),
        zero(F.sum("billed_fee")).alias("billed"),
        zero(F.sum(open_amount)).alias("open_ar"),
        count_where(correct).alias("correct"),
        F.count("invoice_id").alias("n"),
    )
    paid = F.col("payment_status") == "Success"
    payments = tables["payments"].agg(F.struct(
        zero(F.sum(F.when(paid, c("payment_amount")))).alias("collected"),
        F.count("payment_id").alias("n"),
    )).scalar()
    merchants = tables["merchants"].agg(F.count("merchant_id")).scalar()
    totals = invoices.withColumns({"_payments": payments, "_merchants": merchants})
    collected = c("_payments.collected")
    kpis = (
        ("Total Expected Revenue", c("expected")),
        ("Total Billed Revenue", c("billed")),
        ("Billing Accuracy %", percent(c("correct"), c("n"))),
        ("Total Collected (Payments, Success)", collected),
        ("Revenue Realization %", percent(collected, c("billed"))),
        ("Total Outstanding AR", c("open_ar")),
        ("Invoices Analyzed", c("n")),
        ("Payments Analyzed", c("_payments.n")),
        ("Merchants in Sample", c("_merchants")),
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("kpi"), value.cast("double").alias("value"))
        for name, value in kpis
    ])
    return totals.select(F.inline(rows))


def _shuffle_key(key: str, seed: int) -> Column:
    """Order that depends on the key and seed only, not on row placement."""
    return F.md5(F.concat(c(key).cast("string"), F.lit(f"-{seed}")))


def stratified_sample(
    merchants: DataFrame, sizes: Mapping[str, int] = SAMPLE_SIZES, seed: int = SAMPLE_SEED
) -> DataFrame:
    """Up to the given number of merchants per segment.

    The rank filter is a group limit: each task keeps only its own first rows of
    a segment before the shuffle.
    """
    largest = max(sizes.values())
    rank = F.row_number().over(
        Window.partitionBy("merchant_segment").orderBy(
            _shuffle_key("merchant_id", seed), "merchant_id"
        )
    )
    return (
        merchants.where(c("merchant_segment").isin(*sizes))
        .withColumn("_rank", rank)
        .where(c("_rank") <= largest)
        .where(c("_rank") <= labels.lookup(c("merchant_segment"), dict(sizes), 0))
        .drop("_rank")
    )


def sample_tables(
    tables: Tables,
    sizes: Mapping[str, int] = SAMPLE_SIZES,
    seed: int = SAMPLE_SEED,
    transactions: int | None = None,
) -> dict[str, DataFrame]:
    """The sampled merchants and all rows of the other tables that belong to them.

    ``transactions`` asks for that many of the transactions only, in an order by key and seed.
    """
    merchants = stratified_sample(tables["merchants"], sizes, seed)
    ids = merchants.select("merchant_id")
    invoices = tables["invoices"].join(ids, "merchant_id", "left_semi")
    sold = tables["transactions"].join(ids, "merchant_id", "left_semi")
    if transactions is not None:
        sold = sold.orderBy(_shuffle_key("transaction_id", seed), "transaction_id").limit(transactions)
    return {
        "merchants": merchants,
        "invoices": invoices,
        "payments": tables["payments"].join(
            invoices.select("invoice_id"), "invoice_id", "left_semi"
        ),
        "collection_activity": tables["collection_activity"].join(
            ids, "merchant_id", "left_semi"
        ),
        "transactions": sold,
    }


def sample_overview(sample: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per sampled table and an amount to check them by."""
    amounts = {
        "invoices": "total_invoice_amount", "payments": "payment_amount",
        "transactions": "transaction_amount",
    }
    frames = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            zero(F.sum(amounts[name])).cast("double").alias("amount")
            if name in amounts else F.lit(None).cast("double").alias("amount"),
        )
        for name, df in sample.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out

