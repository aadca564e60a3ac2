"""Collections: cash rates, promises, channels, payer behaviour and the work queue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import labels
from tallywright.functions.dates import days_between, trailing
from tallywright.functions.numeric import (
    count_where, dbl, money, percent, ratio, round_dp, zero,
)
from tallywright.functions.relational import number_rows
from tallywright.model import Tables
from tallywright.operators.ledger import (
    not_void, paid_invoices, payment_dates, settlements, successful,
)
from tallywright.operators.ledger import balance as remaining
from tallywright.operators.receivables import WINDOW_DAYS, dso_overall

RECEIVED = "Payment Received"
PROMISED = "Promise to Pay"

# Weights of the priority score and the age that scores full risk.
AMOUNT_WEIGHT, AGE_WEIGHT, BEHAVIOUR_WEIGHT, CUSTOMER_WEIGHT = 0.40, 0.30, 0.20, 0.10
FULL_RISK_DAYS = 120


def collection_rate(
    tables: Tables, as_of: dt.date, window_days: int = WINDOW_DAYS
) -> DataFrame:
    """Cash received over invoiced totals in the trailing window, in one tagged aggregate."""
    nothing = money(F.lit(0))
    billed = not_void(tables["invoices"]).where(
        trailing(F.col("invoice_date"), as_of, window_days)
    ).select(zero(F.col("total_invoice_amount")).alias("billed"), nothing.alias("collected"))
    collected = successful(tables["payments"]).where(
        trailing(F.col("payment_date"), as_of, window_days)
    ).select(nothing.alias("billed"), zero(F.col("payment_amount")).alias("collected"))
    totals = billed.unionByName(collected).agg(
        zero(F.sum("billed")).alias("billed"), zero(F.sum("collected")).alias("collected")
    )
    return totals.select(
        F.lit(as_of - dt.timedelta(days=window_days)).alias("period_start"),
        F.lit(as_of).alias("period_end"),
        F.col("billed").alias("billed_revenue"),
        F.col("collected").alias("collected_revenue"),
        percent(F.col("collected"), F.col("billed")).alias("collection_rate_percent"),
    )


def recovery_rate(tables: Tables) -> DataFrame:
    """Of the invoices that were chased, the share of their total that was paid."""
    activity = tables["collection_activity"].where(F.col("invoice_id").isNotNull())
    chased = activity.select("invoice_id").distinct()
    invoices = not_void(tables["invoices"]).join(chased, "invoice_id", "left_semi")
    total = F.col("total_invoice_amount")
    owed, recovered = F.sum(total), F.sum(F.least(F.col("total_paid"), total))
    return paid_invoices(tables, invoices).agg(
        F.count(F.lit(1)).alias("invoices_chased"),
        zero(owed).alias("amount_owed_at_contact"),
        zero(recovered).alias("amount_recovered"),
        percent(recovered, owed).alias("recovery_rate_percent"),
    )


def average_collection_time(tables: Tables) -> DataFrame:
    paid = not_void(tables["invoices"]).where(F.col("payment_status") == "Paid")
    days = days_between(F.col("last_payment_date"), F.col("due_date"))
    timed = paid.join(payment_dates(tables["payments"]), "invoice_id").select(days.alias("days"))
    return timed.agg(
        F.count(F.lit(1)).alias("paid_invoices_measured"),
        round_dp(ratio(F.sum("days"), F.count("days")), 1).alias("avg_collection_days"),
        round_dp(F.median("days"), 1).alias("median_collection_days"),
    )


def promise_to_pay(tables: Tables) -> DataFrame:
    """Share of activities that are promises, and of dated promises that were kept.

    A promise is kept when any successful payment on its invoice is dated on or
    before the promised date, which is a test of the earliest payment alone.
    """
    promised = F.col("outcome").eqNullSafe(PROMISED)
    dated = promised & F.col("invoice_id").isNotNull() & F.col("promised_payment_date").isNotNull()
    activity = tables["collection_activity"].select(
        "invoice_id", "outcome", "promised_payment_date"
    )
    earliest = payment_dates(tables["payments"]).select("invoice_id", "first_payment_date")
    kept = F.coalesce(F.col("first_payment_date") <= F.col("promised_payment_date"), F.lit(False))
    # only dated promises need the lookup
    checked = activity.where(dated).join(earliest, "invoice_id", "left").select(
        F.lit(True).alias("promise"), F.lit(True).alias("dated"), kept.alias("kept")
    )
    rest = activity.where(~dated).select(
        promised.alias("promise"), F.lit(False).alias("dated"), F.lit(False).alias("kept")
    )
    total = F.count(F.lit(1))
    return checked.unionByName(rest).agg(
        total.alias("total_collection_activities"),
        count_where(F.col("dated")).alias("promises_made"),
        percent(count_where(F.col("promise")), total).alias("promise_to_pay_rate_percent"),
        count_where(F.col("kept")).alias("promises_fulfilled"),
        percent(count_where(F.col("kept")), count_where(F.col("dated"))).alias(
            "promise_fulfillment_rate_percent"
        ),
    )


def _effectiveness(activities: Column, received: Column) -> list[Column]:
    return [
        activities.alias("total_activities"),
        received.alias("payments_received"),
        percent(received, activities).alias("success_rate_percent"),
    ]


def channel_effectiveness(activity: DataFrame) -> DataFrame:
    return (
        activity.where(F.col("contact_channel").isNotNull())
        .groupBy("contact_channel")
        .agg(*_effectiveness(F.count("outcome"), count_where(F.col("outcome") == RECEIVED)))
        .orderBy(F.desc_nulls_last("success_rate_percent"), "contact_channel")
    )


def segment_effectiveness(tables: Tables) -> DataFrame:
    per_merchant = tables["collection_activity"].groupBy("merchant_id").agg(
        F.count("outcome").alias("n"), count_where(F.col("outcome") == RECEIVED).alias("r")
    )
    return (
        per_merchant.join(tables["merchants"].select("merchant_id", "merchant_segment"), "merchant_id")
        .where(F.col("merchant_segment").isNotNull())
        .groupBy("merchant_segment")
        .agg(*_effectiveness(F.sum("n"), F.sum("r")))
        .orderBy(F.desc_nulls_last("success_rate_percent"), "merchant_segment")
    )


def payment_behavior(tables: Tables, as_of: dt.date) -> DataFrame:
    """How each merchant pays, from one aggregate over its invoices.

    The exact median keeps a count per distinct delay, so its state grows with
    the number of different day values and not with the invoices of a merchant.
    """
    invoices = (
        not_void(tables["invoices"])
        .join(settlements(tables), "invoice_id", "left")
        .withColumns({
            "total_paid": zero(F.col("total_paid")),
            "total_credited": zero(F.col("total_credited")),
        })
    )
    paid = F.col("payment_status") == "Paid"
    delay = F.when(paid, days_between(F.col("last_payment_date"), F.col("due_date")))
    overdue = ~F.coalesce(paid, F.lit(False)) & (F.col("due_date") < F.lit(as_of))
    stats = invoices.withColumn("delay", delay).where(F.col("merchant_id").isNotNull()).groupBy(
        "merchant_id"
    ).agg(
        F.count(F.lit(1)).alias("total_invoice_count"),
        ratio(F.sum("total_invoice_amount"), F.count("total_invoice_amount")).alias("avg_value"),
        F.sum(F.greatest(remaining(), money(F.lit(0)))).alias("outstanding_balance"),
        ratio(F.sum("delay"), F.count("delay")).alias("avg_delay"),
        F.median("delay").alias("median_delay"),
        F.max("delay").alias("max_payment_delay_days"),
        percent(count_where(F.col("delay") <= 0), count_where(paid)).alias("on_time_percent"),
        count_where(overdue).alias("overdue_invoice_count"),
    )
    merchants = tables["merchants"].select("merchant_id", "merchant_name", "merchant_segment")
    count, late = F.col("total_invoice_count"), F.col("overdue_invoice_count")
    return stats.join(merchants, "merchant_id", "left").select(
        "merchant_id", "merchant_name", "merchant_segment", "total_invoice_count",
        round_dp(F.col("avg_value"), 2).alias("avg_invoice_value"),
        "outstanding_balance",
        round_dp(F.col("avg_delay"), 1).alias("avg_payment_delay_days"),
        round_dp(F.col("median_delay"), 1).alias("median_payment_delay_days"),
        "max_payment_delay_days",
        "on_time_percent",
        round_dp(F.lit(100.0) - F.col("on_time_percent"), 2).alias("late_percent"),
        "overdue_invoice_count",
        percent(count - late, count).alias("collection_success_rate_percent"),
        labels.payer_segment(F.col("avg_delay"), F.col("on_time_percent")).alias("payer_segment"),
    )


def payer_segment_summary(behavior: DataFrame) -> DataFrame:
    """Per payer segment in fixed order; absent segments are left out."""
    delay = F.col("avg_payment_delay_days").cast("decimal(18,1)")
    position = labels.lookup(
        F.col("payer_segment"), {s: n for n, s in enumerate(labels.PAYER_SEGMENTS)}, None
    )
    return (
        behavior.groupBy("payer_segment")
        .agg(
            F.count("merchant_id").alias("merchant_count"),
            F.sum("outstanding_balance").alias("total_outstanding"),
            round_dp(ratio(F.sum(delay), F.count(delay)), 1).alias("avg_delay_days"),
        )
        .orderBy(position)
    )


def payer_segment_counts(behavior: DataFrame) -> DataFrame:
    return payer_segment_summary(behavior).select("payer_segment", "merchant_count")


def scored_invoices(tables: Tables, aging: DataFrame, behavior: DataFrame) -> DataFrame:
    """Overdue invoices with priority score, tier and action, in no order."""
    overdue = aging.where(F.col("days_overdue") > 0)
    largest = overdue.agg(F.max("outstanding_amount")).scalar()
    # one row per merchant on both sides before the invoices come in
    customer = behavior.select("merchant_id", "payer_segment").join(
        tables["merchants"].select("merchant_id", "merchant_status"), "merchant_id", "full"
    )
    hundred = F.lit(100.0)
    amount_risk = F.least(
        hundred, F.try_divide(hundred * dbl(F.col("outstanding_amount")), dbl(largest))
    )
    age_risk = F.least(
        hundred, hundred * dbl(F.col("days_overdue")) / F.lit(float(FULL_RISK_DAYS))
    )
    behaviour_risk = labels.lookup(
        F.col("payer_segment"), labels.PAYER_RISK, labels.UNKNOWN_RISK
    )
    customer_risk = labels.lookup(
        F.col("merchant_status"), labels.STATUS_RISK, labels.UNKNOWN_RISK
    )
    score = round_dp(
        F.lit(AMOUNT_WEIGHT) * amount_risk
        + F.lit(AGE_WEIGHT) * age_risk
        + F.lit(BEHAVIOUR_WEIGHT) * dbl(behaviour_risk)
        + F.lit(CUSTOMER_WEIGHT) * dbl(customer_risk),
        1,
    )
    return (
        overdue.join(customer, "merchant_id", "left")
        .withColumn("payer_segment", F.coalesce("payer_segment", F.lit("Insufficient Data")))
        .withColumn("priority_score", score)
        .withColumn("priority_tier", labels.priority_tier(F.col("priority_score")))
        .withColumn(
            "recommended_action", labels.lookup(F.col("priority_tier"), labels.TIER_ACTIONS, None)
        )
        .select(
            "merchant_id", "merchant_name", "merchant_segment", "invoice_id",
            "outstanding_amount", "days_overdue", "aging_bucket", "payer_segment",
            "priority_score", "priority_tier", "recommended_action",
        )
    )


def collection_queue(tables: Tables, aging: DataFrame, behavior: DataFrame) -> DataFrame:
    """Overdue invoices ranked by priority score; ties by balance, then invoice id."""
    scored = scored_invoices(tables, aging, behavior)
    order = [F.desc("priority_score"), F.desc("outstanding_amount"), F.asc("invoice_id")]
    ranked = number_rows(scored, "priority_rank", order)
    return ranked.select("priority_rank", *scored.columns)


def collections_summary(tables: Tables, as_of: dt.date) -> DataFrame:
    """The five headline figures as one row of structs."""
    parts = {
        "collection_rate": collection_rate(tables, as_of),
        "recovery_rate": recovery_rate(tables),
        "average_collection_time": average_collection_time(tables),
        "promise_to_pay": promise_to_pay(tables),
        "dso_overall": dso_overall(tables, as_of),
    }
    first, *rest = parts
    one_row = parts[first].select(F.struct("*").alias(first))
    return one_row.select(first, *[
        parts[name].select(F.struct("*").alias(name)).scalar().alias(name) for name in rest
    ])

