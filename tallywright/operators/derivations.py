"""Billing steps that derive model rows: rates, invoices, settlement status, contracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.numeric import money, zero
from tallywright.functions.relational import as_of_value
from tallywright.model import Tables
from tallywright.operators.ledger import paid_by_invoice

# Default rate without a contract, tax rate, days from month end to invoice,
# age below which an invoice is a draft, and the paid share that counts as paid in full.
DEFAULT_RATE = "2.5"
TAX_RATE = "0.18"
INVOICE_LAG_DAYS = 2
DRAFT_DAYS = 3
PAID_SHARE = "0.995"
c = F.col


def asof_contract_rate(transactions: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contract rate in force on the transaction date and the fee it implies."""
    rates = contracts.select(
        "merchant_id", "effective_from", c("transaction_fee_percent").alias("_rate")
    )
    priced = as_of_value(
        transactions.where(c("merchant_id").isNotNull()), rates, key="merchant_id",
        fact_date="transaction_date", history_date="effective_from", values=["_rate"],
    )
    rate = F.coalesce(c("_rate"), F.lit(DEFAULT_RATE).cast("decimal(9,4)")).cast("decimal(9,4)")
    return priced.select(
        "transaction_id", "merchant_id", "transaction_date", "transaction_amount",
        rate.alias("contract_fee_percent"),
        money(c("transaction_amount") * rate * F.lit("0.01").cast("decimal(3,2)")).alias(
            "expected_fee"
        ),
    )


def rate_invoices(tables: Tables, as_of: dt.date) -> DataFrame:
    """One invoice per merchant-month from expected fees of all payment statuses."""
    start = c("billing_period_start")
    months = (
        tables["transactions"].where(c("merchant_id").isNotNull())
        .groupBy("merchant_id", F.trunc("transaction_date", "MM").alias("billing_period_start"))
        .agg(money(F.sum("expected_platform_fee")).alias("expected_fee"))
    )
    discounts = tables["contracts"].select(
        "merchant_id", "effective_from", c("discount_percent").alias("_discount")
    )
    terms = tables["merchants"].select("merchant_id", "payment_terms_days")
    percent_off = zero(c("_discount")).cast("decimal(9,4)")
    fee = c("expected_fee")
    cent = F.lit("0.01").cast("decimal(3,2)")
    return (
        as_of_value(
            months, discounts, key="merchant_id", fact_date="billing_period_start",
            history_date="effective_from", values=["_discount"],
        )
        .join(terms, "merchant_id")
        .withColumn("invoice_date", F.date_add(F.last_day(start), INVOICE_LAG_DAYS))
        .withColumn("discount", money(fee * percent_off * cent))
        .withColumn("taxable_amount", money(fee - c("discount")))
        .withColumn("tax_amount", money(c("taxable_amount") * F.lit(TAX_RATE).cast("decimal(3,2)")))
        .select(
            "merchant_id", "billing_period_start", F.last_day(start).alias("billing_period_end"),
            "invoice_date",
            F.date_add("invoice_date", c("payment_terms_days")).alias("due_date"),
            fee.alias("subtotal"), "discount", "taxable_amount", "tax_amount",
            money(c("taxable_amount") + c("tax_amount")).alias("total_invoice_amount"),
            F.when(F.datediff(F.lit(as_of), "invoice_date") < DRAFT_DAYS, "Draft")
            .otherwise("Issued").alias("invoice_status"),
        )
    )


def invoice_settlement_status(tables: Tables, as_of: dt.date) -> DataFrame:
    """Payment status from the paid share, and the invoice status that follows."""
    paid = paid_by_invoice(tables["payments"]).select("invoice_id", "total_paid")
    total = c("total_invoice_amount")
    enough = total * F.lit(PAID_SHARE).cast("decimal(4,3)")
    in_full = F.when(total > 0, c("total_paid") >= enough).when(total < 0, c("total_paid") <= enough)
    payment_status = (
        F.when(in_full, "Paid").when(c("total_paid") > 0, "Partially Paid").otherwise("Unpaid")
    )
    status = c("invoice_status")
    is_paid = c("settled_payment_status") == "Paid"
    settled = (
        F.when(is_paid & status.isin("Issued", "Overdue"), "Paid")
        .when(~is_paid & (c("due_date") < F.lit(as_of)) & (status == "Issued"), "Overdue")
        .otherwise(status)
    )
    return (
        tables["invoices"].join(paid, "invoice_id", "left")
        .withColumn("total_paid", zero(c("total_paid")))
        .withColumn("settled_payment_status", payment_status)
        .withColumn("settled_invoice_status", settled)
        .select(
            "invoice_id", "merchant_id", "due_date", "total_invoice_amount", "total_paid",
            "settled_payment_status", "settled_invoice_status",
        )
    )


def chase_candidates(settled: DataFrame) -> DataFrame:
    """Invoices a collector should chase: overdue, or paid in part."""
    return settled.where(
        (c("settled_invoice_status") == "Overdue") | (c("settled_payment_status") == "Partially Paid")
    ).select("invoice_id", "merchant_id", "settled_invoice_status", "settled_payment_status")


def contract_intervals(tables: Tables) -> DataFrame:
    """End of each contract (the merchant's next start day) and its status.

    The next start is found among the distinct start days of a merchant, at most
    one per calendar day; an open last contract ends with the merchant relation.
    """
    contracts, merchants = tables["contracts"], tables["merchants"]
    following = F.lead("effective_from").over(
        Window.partitionBy("merchant_id").orderBy("effective_from")
    )
    starts = contracts.select("merchant_id", "effective_from").distinct().withColumn(
        "_next", following
    )
    end = c("contract_end_date") if "contract_end_date" in merchants.columns else F.lit(None)
    relation = merchants.select(
        "merchant_id", "merchant_status", end.cast("date").alias("_relation_end")
    )
    active = c("merchant_status") == "Active"
    return (
        contracts.join(starts, ["merchant_id", "effective_from"])
        .join(relation, "merchant_id", "left")
        .select(
            "contract_id", "merchant_id", "effective_from",
            F.coalesce("_next", F.when(~active, c("_relation_end"))).alias("effective_to"),
            F.when(c("_next").isNotNull(), "Superseded")
            .when(c("merchant_status") == "Churned", "Terminated")
            .otherwise("Active").alias("contract_status"),
        )
    )


def refund_events(transactions: DataFrame) -> DataFrame:
    return transactions.where(c("refund_amount") > 0).select(
        "transaction_id", "merchant_id", "transaction_date", "refund_amount"
    )
