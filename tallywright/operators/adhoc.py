"""The 28 analyst questions over the finance model, by number.

Each answer is built from the shared per-invoice totals; facts are reduced to
one row per invoice, merchant or month before they are joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions import labels
from tallywright.functions.dates import days_between, month_label, trailing
from tallywright.functions.numeric import (
    count_where, dbl, money, percent, ratio, round_dp, sum_where, zero,
)
from tallywright.functions.relational import salted_lookup
from tallywright.model import Tables
from tallywright.operators.ledger import (
    applied, counted_credits, not_void, open_balance, paid_invoices, payment_dates, successful,
    uninvoiced_months,
)
from tallywright.operators.receivables import is_open
from tallywright.operators.reconciliation import TOLERANCE, repeated_payments

SALTS = 16
RECEIVED = "Payment Received"
c = F.col


def _billing_month() -> Column:
    return month_label(c("invoice_date")).alias("billing_month")


def monthly_billed(tables: Tables) -> DataFrame:
    return tables["invoices"].groupBy(_billing_month()).agg(
        F.count(F.lit(1)).alias("invoice_count"),
        F.sum("billed_fee").alias("billed_revenue"),
        F.sum("expected_fee").alias("expected_revenue"),
    ).orderBy("billing_month")


def monthly_growth(tables: Tables) -> DataFrame:
    """Against the previous month that has invoices; the window holds one row per month."""
    monthly = tables["invoices"].groupBy(_billing_month()).agg(F.sum("billed_fee").alias("revenue"))
    prior = F.lag("revenue").over(Window.orderBy("billing_month"))
    return monthly.select(
        "billing_month", "revenue", prior.alias("prior_month_revenue"),
        percent(c("revenue") - prior, prior).alias("growth_percent"),
    ).orderBy("billing_month")


def _billed_by_merchant(tables: Tables) -> DataFrame:
    return tables["invoices"].groupBy("merchant_id").agg(
        F.sum("billed_fee").alias("billed"),
        F.count("billed_fee").alias("billed_count"),
        F.count(F.lit(1)).alias("invoice_count"),
        F.sum("invoice_error_flag").alias("errors"),
    )


def _segments(tables: Tables) -> DataFrame:
    return tables["merchants"].select("merchant_id", "merchant_segment")


def top_merchants(tables: Tables, top: int = 20) -> DataFrame:
    names = tables["merchants"].select("merchant_id", "merchant_name", "merchant_segment")
    return (
        _billed_by_merchant(tables).join(names, "merchant_id")
        .select(
            "merchant_id", "merchant_name", "merchant_segment",
            c("billed").alias("total_billed_revenue"), "invoice_count",
        )
        .orderBy(F.desc("total_billed_revenue"), "merchant_id")
        .limit(top)
    )


def outstanding_invoices(tables: Tables) -> DataFrame:
    return open_balance(tables).where(is_open(c("outstanding_amount"))).orderBy(
        F.desc("outstanding_amount"), "invoice_id"
    )


def _unpaid(tables: Tables, as_of: dt.date) -> DataFrame:
    """Open invoices by payments alone (credit notes not netted)."""
    return (
        paid_invoices(tables, not_void(tables["invoices"]))
        .withColumn("outstanding_amount", money(c("total_invoice_amount") - c("total_paid")))
        .where(is_open(c("outstanding_amount")))
        .withColumn("days_overdue", days_between(F.lit(as_of), c("due_date")))
    )


def aging_buckets(tables: Tables, as_of: dt.date) -> DataFrame:
    return (
        _unpaid(tables, as_of)
        .groupBy(labels.aging_bucket(c("days_overdue")).alias("aging_bucket"))
        .agg(
            F.count(F.lit(1)).alias("invoice_count"),
            F.sum("outstanding_amount").alias("total_outstanding"),
            F.min("days_overdue").alias("_youngest"),
        )
        .orderBy("_youngest")
        .drop("_youngest")
    )


def dso(tables: Tables, as_of: dt.date, days: int = 90) -> DataFrame:
    open_amount = c("total_invoice_amount") - c("total_paid")
    totals = paid_invoices(tables).agg(
        F.sum(F.when(c("invoice_status") != "Void", open_amount)).alias("total_ar"),
        F.sum(F.when(trailing(c("invoice_date"), as_of, days), c("billed_fee"))).alias("sales"),
    )
    return totals.select(
        "total_ar", c("sales").alias("trailing_90d_credit_sales"),
        round_dp(ratio(c("total_ar"), c("sales")) * F.lit(float(days)), 1).alias("dso_days"),
    )


def overdue_invoices(tables: Tables, as_of: dt.date) -> DataFrame:
    return _unpaid(tables, as_of).where(c("due_date") < F.lit(as_of)).select(
        "invoice_id", "merchant_id", "due_date", "outstanding_amount", "days_overdue"
    ).orderBy(F.desc("days_overdue"), "invoice_id")


def _cash_by_month(tables: Tables) -> DataFrame:
    return successful(tables["payments"]).groupBy(
        month_label(c("payment_date")).alias("month")
    ).agg(F.sum("payment_amount").alias("collected_revenue"))


def _billed_by_month(tables: Tables) -> DataFrame:
    return tables["invoices"].groupBy(month_label(c("invoice_date")).alias("month")).agg(
        F.sum("expected_fee").alias("expected_revenue"),
        F.sum("billed_fee").alias("billed_revenue"),
    )


def monthly_collection_rate(tables: Tables) -> DataFrame:
    collected = zero(c("collected_revenue"))
    return _billed_by_month(tables).join(_cash_by_month(tables), "month", "left").select(
        "month", "billed_revenue", collected.alias("collected_revenue"),
        percent(collected, c("billed_revenue")).alias("collection_rate_percent"),
    ).orderBy("month")


def payment_delay_by_merchant(tables: Tables) -> DataFrame:
    delay = days_between(c("first_payment_date"), c("due_date"))
    timed = tables["invoices"].join(payment_dates(tables["payments"]), "invoice_id").select(
        "merchant_id", delay.alias("delay")
    )
    count = F.count(F.lit(1))
    return timed.groupBy("merchant_id").agg(
        count.alias("paid_invoice_count"),
        round_dp(ratio(F.sum("delay"), F.count("delay")), 1).alias("avg_payment_delay_days"),
        percent(count_where(c("delay") <= 0), count, 1).alias("on_time_payment_percent"),
        F.max("delay").alias("max_delay_days"),
    ).orderBy(F.desc("avg_payment_delay_days"), "merchant_id")


def underbilled_by_merchant(tables: Tables) -> DataFrame:
    gap = F.sum(c("expected_fee") - c("billed_fee"))
    return (
        tables["invoices"]
        .where((c("invoice_error_flag") == 1) & (c("billed_fee") < c("expected_fee")))
        .groupBy("merchant_id")
        .agg(F.count(F.lit(1)).alias("underbilled_invoice_count"), gap.alias("total_leakage_amount"))
        .where(c("total_leakage_amount") > 0)
        .orderBy(F.desc("total_leakage_amount"), "merchant_id")
    )


def error_rate_by_segment(tables: Tables) -> DataFrame:
    return (
        _billed_by_merchant(tables).join(_segments(tables), "merchant_id")
        .groupBy("merchant_segment")
        .agg(
            F.sum("invoice_count").alias("total_invoices"),
            F.sum("errors").alias("error_count"),
            percent(F.sum("errors"), F.sum("invoice_count")).alias("error_rate_percent"),
        )
        .orderBy(F.desc("error_rate_percent"), "merchant_segment")
    )


def misbilled_detail(tables: Tables, *, under: bool) -> DataFrame:
    expected, billed = c("expected_fee"), c("billed_fee")
    gap, name = (expected - billed, "underbilled_amount") if under else (
        billed - expected, "overbilled_amount"
    )
    return (
        tables["invoices"].where((c("invoice_error_flag") == 1) & (gap > 0))
        .select("invoice_id", "merchant_id", "invoice_date", expected, billed, gap.alias(name))
        .orderBy(F.desc(name), "invoice_id")
    )


def reconciliation_status(tables: Tables) -> DataFrame:
    paid, total = c("total_paid"), c("total_invoice_amount")
    status = (
        F.when(c("payment_count") == 0, "MISSING_PAYMENT")
        .when(F.abs(paid - total) <= TOLERANCE, "MATCHED")
        .when(paid < total, "PARTIAL")
        .otherwise("AMOUNT_MISMATCH")
    )
    return paid_invoices(tables, not_void(tables["invoices"])).select(
        "invoice_id", "merchant_id", "total_invoice_amount", "total_paid", "payment_count",
        status.alias("reconciliation_status"),
    ).orderBy("reconciliation_status", "invoice_id")


def duplicate_payments(tables: Tables) -> DataFrame:
    """Every payment of a repeated (invoice, amount) pair, with the pair's count.

    Payments are dealt by pair and salt, so one pair's repeats never meet in one task.
    """
    keys = ["invoice_id", "payment_amount"]
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = repeated_payments(tables["payments"]).withColumn("_salt", F.explode(salts))
    members = applied(tables["payments"]).select(
        *keys, "payment_id", F.pmod(F.xxhash64("payment_id"), F.lit(SALTS)).cast("int").alias("_salt")
    )
    return (
        members.join(repeated, [*keys, "_salt"])
        .select(*keys, "payment_count", "payment_id")
        .orderBy(F.desc("payment_count"), *keys, "payment_id")
    )


def missing_invoice_months(tables: Tables) -> DataFrame:
    return uninvoiced_months(tables["transactions"], tables["invoices"]).select(
        "merchant_id", month_label(c("month")).alias("txn_month")
    ).orderBy("merchant_id", "txn_month")


def invoices_without_payment(tables: Tables) -> DataFrame:
    paid = applied(tables["payments"]).select("invoice_id").distinct()
    return not_void(tables["invoices"]).join(paid, "invoice_id", "left_anti").select(
        "invoice_id", "merchant_id", "invoice_date", "due_date", "total_invoice_amount"
    ).orderBy("due_date", "invoice_id")


def segment_summary(tables: Tables) -> DataFrame:
    """One row per merchant reaches the join, so counting merchants needs no distinct."""
    return (
        _billed_by_merchant(tables).join(_segments(tables), "merchant_id")
        .groupBy("merchant_segment")
        .agg(
            F.count(F.lit(1)).alias("merchant_count"),
            F.sum("billed").alias("total_billed_revenue"),
            round_dp(ratio(F.sum("billed"), F.sum("billed_count")), 2).alias("avg_invoice_value"),
        )
        .orderBy(F.desc("total_billed_revenue"), "merchant_segment")
    )


def merchant_net_revenue(tables: Tables) -> DataFrame:
    """Billed less processed refunds and counted credits, for merchants with invoices."""
    none = money(F.lit(None))

    def part(df: DataFrame, **given: Column) -> DataFrame:
        names = ("billed", "refunded", "credited")
        return df.select("merchant_id", *[
            money(given[n]).alias(n) if n in given else none.alias(n) for n in names
        ], F.lit("billed" in given).alias("is_invoice"))

    rows = (
        part(tables["invoices"], billed=c("billed_fee"))
        .unionByName(part(
            tables["refunds"].where(c("refund_status") == "Processed"), refunded=c("refund_amount")
        ))
        .unionByName(part(counted_credits(tables["credit_notes"]), credited=c("credit_amount")))
    )
    totals = rows.groupBy("merchant_id").agg(
        F.sum("billed").alias("billed"),
        zero(F.sum("refunded")).alias("refunded"),
        zero(F.sum("credited")).alias("credited"),
        F.bool_or("is_invoice").alias("invoiced"),
    )
    return totals.where("invoiced").select(
        "merchant_id", c("billed").alias("total_billed_revenue"),
        c("refunded").alias("total_refunds"), c("credited").alias("total_credit_notes"),
        (c("billed") - c("refunded") - c("credited")).alias("net_revenue"),
    ).orderBy(F.desc("net_revenue"), "merchant_id")


def _payment_delays(tables: Tables) -> DataFrame:
    """Delay totals per merchant over all successful payments.

    Payments are reduced to (invoice, day) counts before they meet invoices.
    """
    paid_days = applied(tables["payments"]).groupBy("invoice_id", "payment_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    delay = days_between(c("payment_date"), c("due_date"))
    return (
        tables["invoices"].select("invoice_id", "merchant_id", "due_date")
        .join(paid_days, "invoice_id")
        .groupBy("merchant_id")
        .agg(
            F.sum(delay * c("n")).alias("delay_sum"),
            F.sum(F.when(delay.isNotNull(), c("n"))).alias("delay_count"),
            F.sum("n").alias("payment_count"),
            F.max(delay).alias("max_delay"),
        )
    )


def priority_list(tables: Tables, as_of: dt.date, top: int = 50) -> DataFrame:
    overdue = _unpaid(tables, as_of).where(c("due_date") < F.lit(as_of)).select(
        "invoice_id", "merchant_id", "outstanding_amount", "days_overdue"
    )
    history = _payment_delays(tables).select(
        "merchant_id", ratio(c("delay_sum"), c("delay_count")).alias("avg_delay")
    )
    peaks = overdue.agg(F.struct(F.max("outstanding_amount").alias("amount"),
                                 F.max("days_overdue").alias("days"))).scalar()
    slowest = history.agg(F.max("avg_delay")).scalar()
    hundred = F.lit(100.0)
    amount_score = F.try_divide(hundred * dbl(c("outstanding_amount")), dbl(peaks["amount"]))
    age_score = F.try_divide(hundred * dbl(c("days_overdue")), dbl(peaks["days"]))
    history_score = F.try_divide(hundred * F.coalesce(c("avg_delay"), F.lit(0.0)), slowest)
    score = round_dp(
        F.lit(0.4) * amount_score + F.lit(0.3) * age_score + F.lit(0.2) * history_score
        + F.lit(0.1) * F.lit(50.0),
        1,
    )
    return overdue.join(history, "merchant_id", "left").select(
        "invoice_id", "merchant_id", "outstanding_amount", "days_overdue",
        score.alias("priority_score"),
    ).orderBy(F.desc("priority_score"), "invoice_id").limit(top)


def monthly_variance(tables: Tables) -> DataFrame:
    variance = c("billed_revenue") - c("expected_revenue")
    return _billed_by_month(tables).join(_cash_by_month(tables), "month", "left").select(
        "month", "expected_revenue", "billed_revenue", variance.alias("billing_variance"),
        percent(variance, c("expected_revenue")).alias("billing_variance_percent"),
        zero(c("collected_revenue")).alias("collected_revenue"),
    ).orderBy("month")


def revenue_concentration(tables: Tables, top: int = 10) -> DataFrame:
    revenue = _billed_by_merchant(tables).select("merchant_id", "billed")
    largest = revenue.orderBy(F.desc_nulls_last("billed"), "merchant_id").limit(top)
    total = tables["invoices"].agg(F.sum("billed_fee")).scalar()
    return largest.agg(F.sum("billed").alias("top_10_revenue")).select(
        "top_10_revenue", total.alias("total_revenue"),
        percent(c("top_10_revenue"), total).alias("top_10_share_percent"),
    )


def delay_by_segment(tables: Tables) -> DataFrame:
    return (
        _payment_delays(tables).join(_segments(tables), "merchant_id")
        .groupBy("merchant_segment")
        .agg(
            F.sum("payment_count").alias("payment_count"),
            round_dp(ratio(F.sum("delay_sum"), F.sum("delay_count")), 1).alias("avg_delay_days"),
            F.max("max_delay").alias("max_delay_days"),
        )
        .orderBy(F.desc("avg_delay_days"), "merchant_segment")
    )


def high_risk_accounts(
    tables: Tables, as_of: dt.date, min_overdue: int = 5000, min_delay: int = 15
) -> DataFrame:
    late = c("due_date") < F.lit(as_of)
    overdue = paid_invoices(tables, not_void(tables["invoices"])).groupBy("merchant_id").agg(
        sum_where(late, c("total_invoice_amount") - c("total_paid")).alias("overdue_ar")
    )
    delay = F.coalesce(ratio(c("delay_sum"), c("delay_count")), F.lit(0.0))
    names = tables["merchants"].select("merchant_id", "merchant_name", "merchant_segment")
    return (
        overdue.where(c("overdue_ar") > min_overdue)
        .join(_payment_delays(tables), "merchant_id", "left")
        .where(delay > min_delay)
        .join(names, "merchant_id")
        .select(
            "merchant_id", "merchant_name", "merchant_segment", "overdue_ar",
            round_dp(delay, 1).alias("avg_payment_delay_days"),
        )
        .orderBy(F.desc("overdue_ar"), "merchant_id")
    )


def yield_by_activity(tables: Tables) -> DataFrame:
    received = count_where(c("outcome") == RECEIVED)
    return tables["collection_activity"].groupBy("activity_type").agg(
        F.count(F.lit(1)).alias("activity_count"),
        received.alias("resulted_in_payment"),
        percent(received, F.count(F.lit(1))).alias("recovery_effectiveness_percent"),
    ).orderBy(F.desc("recovery_effectiveness_percent"), "activity_type")


def promise_fulfilment(tables: Tables) -> DataFrame:
    """By activity type and outcome, unlike ``promise_to_pay`` which looks at payments."""
    kept = count_where(c("outcome") == RECEIVED)
    return tables["collection_activity"].where(c("activity_type") == "Payment Promise").agg(
        F.count(F.lit(1)).alias("promises_made"),
        kept.alias("promises_kept"),
        percent(kept, F.count(F.lit(1))).alias("fulfillment_rate_percent"),
    )


def dispute_summary(tables: Tables) -> DataFrame:
    resolved = count_where(c("resolution_status") == "Resolved")
    return tables["disputes"].groupBy("dispute_type").agg(
        F.count(F.lit(1)).alias("dispute_count"),
        F.sum("disputed_amount").alias("total_disputed_amount"),
        resolved.alias("resolved_count"),
        percent(resolved, F.count(F.lit(1))).alias("resolution_rate_percent"),
    ).orderBy(F.desc("total_disputed_amount"), "dispute_type")


def refund_rate_by_industry(tables: Tables) -> DataFrame:
    """All transaction statuses; amounts and distinct ids take separate aggregates.

    Amounts collapse to merchants before the join.  Ids meet their merchant's industry in
    a salted join; distinct ones need a shuffle by id.  Both are even, however large one
    merchant or industry is.
    """
    industries = tables["merchants"].select("merchant_id", "industry")
    amounts = (
        tables["transactions"].groupBy("merchant_id")
        .agg(F.sum("transaction_amount").alias("amount"), F.sum("refund_amount").alias("refund"))
        .join(industries, "merchant_id")
        .groupBy("industry")
        .agg(F.sum("amount").alias("amount"), F.sum("refund").alias("refund"))
    )
    named = tables["transactions"].where(c("transaction_id").isNotNull()).select("transaction_id", "merchant_id")
    ids = (
        salted_lookup(named, industries, "merchant_id", "transaction_id")
        .groupBy("industry")
        .agg(F.countDistinct("transaction_id").alias("transaction_count"))
    )
    return amounts.join(ids, "industry").select(
        "industry", "transaction_count", c("amount").alias("gross_transaction_value"),
        c("refund").alias("total_refunded"),
        percent(c("refund"), c("amount")).alias("refund_rate_percent"),
    ).orderBy(F.desc("refund_rate_percent"), "industry")
