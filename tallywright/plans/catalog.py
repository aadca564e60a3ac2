"""Named results over a bound finance model."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_label
from tallywright.functions.labels import aging_bucket, ar_risk, bin_right_closed
from tallywright.functions.numeric import money, sum_of_keys
from tallywright.model import TABLES
from tallywright.operators import (
    adhoc, billing, cleaning, collections, derivations, leakage, ledger, measures, quality,
    realization, receivables, reconciliation, star, worksheets,
)
from tallywright.session import work_folder
from tallywright.sources import files
from tallywright.sources.binding import RAW_ORDERS, BoundModel

Result = Callable[[BoundModel], DataFrame]

# Plausible date range of the bound test tables.
EARLIEST, LATEST = "1990-01-01", "2000-12-31"

_runs = itertools.count()


def _billing(m: BoundModel) -> DataFrame:
    return billing.billing_merchant_month(m)


def _events(m: BoundModel) -> DataFrame:
    return leakage.leakage_events(m, _billing(m), m.as_of)


def _aging(m: BoundModel) -> DataFrame:
    return receivables.ar_aging(m, m.as_of)


def _behavior(m: BoundModel) -> DataFrame:
    return collections.payment_behavior(m, m.as_of)


def _queue(m: BoundModel) -> DataFrame:
    return collections.collection_queue(m, _aging(m), _behavior(m))


def _flat_summary(m: BoundModel) -> DataFrame:
    summary = collections.collections_summary(m, m.as_of)
    return summary.select(*[
        F.col(f"{group.name}.{field.name}").alias(f"{group.name}_{field.name}")
        for group in summary.schema.fields
        for field in group.dataType.fields
    ])


def _folder(m: BoundModel, name: str) -> str:
    """A fresh folder for one run of a sink."""
    return f"{work_folder(m.spark)}/sinks/{name}-{next(_runs)}"


def _scan_csv(m: BoundModel) -> DataFrame:
    """Payments written in two ways: as declared, and with their columns in another order beside
    a note that holds line breaks, quotes and commas."""
    path = _folder(m, "scan_csv")
    columns = ["payment_id", "invoice_id", "merchant_id", "payment_date", "payment_amount",
               "payment_status", "settlement_date"]
    payments = m["payments"].select(*columns)
    odd = F.col("payment_id") % 2 != 0
    note = F.concat(F.lit('paid, "in part"\nsee '), F.col("payment_id"), F.lit("\r\n"))
    files.write_csv(payments.where(~odd), f"{path}/declared")
    files.write_csv(payments.where(odd).select(note.alias("note"), *reversed(columns)), f"{path}/shuffled")
    unreadable = F.col(files.CORRUPT).isNotNull()
    return files.scan_csv(m.spark, path, payments.schema).select(
        *columns, unreadable.alias("is_corrupt")
    )


def _scan_table(m: BoundModel) -> DataFrame:
    return files.scan_table(
        m.spark, f"{m.folder}/orders.parquet", ["o_orderkey", "o_custkey"],
        F.col("o_totalprice") > 100000,
    )


def _write_csv(m: BoundModel) -> DataFrame:
    path = _folder(m, "write_csv")
    result = reconciliation.reconcile_invoices(m)
    files.write_csv(result, path)
    # numbers and status labels hold no line breaks
    return files.scan_csv(m.spark, path, result.schema, quoted_breaks=False).drop(files.CORRUPT)


def _write_json_summary(m: BoundModel) -> DataFrame:
    path = _folder(m, "write_json_summary")
    summary = collections.collections_summary(m, m.as_of)
    files.write_json_summary(summary, path)
    again = m.spark.read.schema(summary.schema).json(path)
    return again.select(
        F.col("dso_overall.total_ar").alias("total_ar"),
        F.col("dso_overall.dso_days").alias("dso_days"),
        F.col("collection_rate.collection_rate_percent").alias("collection_rate_percent"),
        F.col("recovery_rate.invoices_chased").alias("invoices_chased"),
        F.col("promise_to_pay.promises_fulfilled").alias("promises_fulfilled"),
    )


#: A measure per table that a loaded model is compared by, beside its keys.
CONTENTS = {
    "merchants": "payment_terms_days", "contracts": "transaction_fee_percent",
    "transactions": "transaction_amount", "invoices": "total_invoice_amount",
    "payments": "payment_amount", "refunds": "refund_amount", "credit_notes": "credit_amount",
    "collection_activity": "promised_amount", "disputes": "disputed_amount",
}


def _sound(m: BoundModel) -> dict[str, DataFrame]:
    """The model without the payments on invoices that do not exist, which no load accepts."""
    known = m["invoices"].select("invoice_id")
    placed = m["payments"].where(F.col("invoice_id").isNotNull()).join(known, "invoice_id", "left_semi")
    payments = placed.unionByName(m["payments"].where(F.col("invoice_id").isNull()))
    return {**{name: m[name] for name in TABLES}, "payments": payments}


def _load_model(m: BoundModel) -> DataFrame:
    """Loaded under the gate, then read back from what was published."""
    folder = _folder(m, "load_model")
    files.load_model(_sound(m), folder)
    loaded = files.read_model(m.spark, folder)
    return quality.union_all(
        loaded[name].agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            sum_of_keys(F.col(TABLES[name].key)).alias("key_total"), money(F.sum(measure)).alias("measure_total"),
        )
        for name, measure in CONTENTS.items()
    )


def _cleaning_stats(m: BoundModel) -> DataFrame:
    """Counted while the cleaned tables are written."""
    folder = _folder(m, "cleaned")

    def put(name: str, df: DataFrame) -> DataFrame:
        files.write_result(df, f"{folder}/{name}")
        return m.spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return cleaning.clean_and_count(m.raw(), put, RAW_ORDERS)[1]


#: What is summed of the exported facts.
FACT_MEASURES = {
    "fact_invoices": "total_invoice_amount", "fact_payments": "payment_amount",
    "fact_collection_activity": "promised_amount", "fact_leakage": "leakage_amount",
    "fact_ar_aging": "outstanding_amount",
}


def _export_star(m: BoundModel) -> DataFrame:
    """Exported whole, then two months once more; rows and sums by table and month."""
    path = _folder(m, "export_star")
    m["transactions"]  # written before the invoices, which then add up what is there
    frames = star.star(m, _billing(m), m.as_of)
    files.export_star(frames, path)
    files.export_star(frames, path, months=("1997-03", f"{m.as_of:%Y-%m}"))
    parts = []
    for name in frames:
        table = m.spark.read.parquet(f"{path}/{name}")
        fact = name in FACT_MEASURES
        month = F.col("year_month").cast("string") if fact else F.lit(None).cast("string")
        total = money(F.sum(FACT_MEASURES[name])) if fact else F.lit(None).cast("decimal(18,2)")
        parts.append(
            table.groupBy(month.alias("year_month")).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), total.alias("total")
            )
        )
    return quality.union_all(parts)


def _with_discounts(m: BoundModel) -> dict[str, DataFrame]:
    step = F.lit("2.5").cast("decimal(9,4)")
    contracts = m["contracts"].withColumn(
        "discount_percent", ((F.col("contract_id") % 4) * step).cast("decimal(9,4)")
    )
    return {**m, "contracts": contracts}


def _with_profiles(m: BoundModel) -> dict[str, DataFrame]:
    """Descriptive columns the bound tables lack, so the star dimensions are full."""
    merchant = F.col("merchant_id")
    rate = F.lit("1.50").cast("decimal(9,4)") + (merchant % 5) * F.lit("0.40").cast("decimal(9,4)")
    merchants = m["merchants"].withColumns({
        "city": F.concat(F.lit("City "), merchant % 10),
        "onboarding_date": F.date_add(F.lit("1994-01-01").cast("date"), (merchant % 300).cast("int")),
        "account_manager": F.concat(F.lit("Manager "), merchant % 7),
        "pricing_plan": F.when(F.col("merchant_segment") == "Enterprise", "Custom").otherwise(
            "Standard"
        ),
        "agreed_fee_percent": rate.cast("decimal(9,4)"),
        "monthly_subscription_fee": money((merchant % 4) * 100),
    })
    activity = m["collection_activity"].withColumn(
        "collector", F.concat(F.lit("Agent "), F.col("collection_id") % 9)
    )
    return {**m, "merchants": merchants, "collection_activity": activity}


def _one_invoiced_merchant(m: BoundModel) -> DataFrame:
    """Drill-through to the merchant with the largest billed revenue."""
    largest = measures.top_merchants(m, 1).select("merchant_id").scalar()
    return measures.merchant_invoice_detail(m, F.col("merchant_id") == largest)


RESULTS: dict[str, Result] = {
    # shared blocks
    "paid_by_invoice": lambda m: ledger.paid_by_invoice(m["payments"]),
    "credited_by_invoice": lambda m: ledger.credited_by_invoice(m["credit_notes"]),
    "open_balance": ledger.open_balance,
    "last_first_payment": lambda m: ledger.payment_dates(m["payments"]),
    "uninvoiced_months": lambda m: ledger.uninvoiced_months(m["transactions"], m["invoices"])
    .withColumn("month", month_label(F.col("month"))),
    "bin_right_closed": lambda m: m["invoices"].select(
        "invoice_id",
        bin_right_closed(
            F.col("billed_fee"), ((100, "small"), (1000, "medium"), (5000, "large")), "huge"
        ).alias("size_class"),
    ),
    # sources and sinks
    "scan_csv": _scan_csv,
    "scan_table": _scan_table,
    "write_csv": _write_csv,
    "write_json_summary": _write_json_summary,
    "load_model": _load_model,
    "export_star": _export_star,
    # data quality
    "dq_missing": lambda m: quality.dq_missing(m.raw()),
    "dq_dup_ids": lambda m: quality.dq_dup_ids(m.raw()),
    "dq_dup_rows": lambda m: quality.dq_dup_rows(m.raw()),
    "dq_invalid_dates": lambda m: quality.dq_invalid_dates(m.raw(), EARLIEST, LATEST),
    "dq_date_order": lambda m: quality.dq_date_order(m.raw()),
    "dq_negative": lambda m: quality.dq_negative(m.raw()),
    "dq_range": lambda m: quality.union_all([
        quality.dq_range(_with_steep_rates(m)), quality.dq_range(m.raw()),
    ]),
    "dq_domain": lambda m: quality.dq_domain({**m.raw(), "transactions": m["transactions"]}),
    "dq_referential": lambda m: quality.dq_referential(m.raw()),
    "dq_findings": lambda m: quality.findings(m.raw(), None, EARLIEST, LATEST),
    "dq_missing_cells": lambda m: quality.dq_missing_cells(m.raw()),
    "dq_dup_pk_extra": lambda m: quality.dq_dup_pk_extra(m.raw()),
    "dq_fk_spot": lambda m: quality.dq_fk_spot(m.raw()),
    "table_profile": lambda m: quality.table_profile(m.raw()),
    "category_mix": quality.category_mix,
    # cleaning, constraints, cross-table checks
    "clean_transactions": lambda m: cleaning.clean_transactions(
        m.raw()["transactions"], RAW_ORDERS["transactions"]
    ),
    "clean_invoices": lambda m: cleaning.clean_invoices(
        m.raw()["invoices"], RAW_ORDERS["invoices"]
    ).drop("midx", "k"),
    "clean_payments": lambda m: cleaning.clean_payments(
        m.raw()["payments"], RAW_ORDERS["payments"]
    ),
    "clean_credit_notes": lambda m: cleaning.clean_credit_notes(
        m.raw()["credit_notes"], RAW_ORDERS["credit_notes"]
    ),
    "clean_refunds": lambda m: cleaning.clean_all(m.raw(), RAW_ORDERS)["refunds"],
    "dedupe_pk": lambda m: cleaning.dedupe_pk(
        m.raw()["payments"], "payment_id", RAW_ORDERS["payments"]
    ),
    "cleaning_stats": _cleaning_stats,
    "constraint_violations": lambda m: quality.constraint_violations(m.raw()),
    "x_missing_invoices": quality.x_missing_invoices,
    "x_duplicate_payments": quality.x_duplicate_payments,
    "x_unmatched_payments": quality.x_unmatched_payments,
    "x_orphan_payments": quality.x_orphan_payments,
    "x_invoices_without_payment": quality.x_invoices_without_payment,
    "x_amount_mismatches": quality.x_amount_mismatches,
    # billing
    "near_contract_transition": lambda m: billing.near_contract_transition(
        m["invoices"], m["contracts"]
    ),
    "billing_status": lambda m: billing.billing_status(m["invoices"], m["contracts"]).select(
        "invoice_id", "merchant_id", "revenue_difference", "variance_percent", "billing_status"
    ),
    "billing_missing_months": billing.billing_missing_months,
    "billing_merchant_month": _billing,
    "billing_status_summary": lambda m: billing.billing_status_summary(_billing(m)),
    "billing_errors_by_segment": lambda m: billing.billing_errors_by_segment(
        _billing(m), m["merchants"]
    ),
    "billing_accuracy_count": lambda m: billing.billing_accuracy_count(_billing(m)),
    "billing_repeat_offenders": lambda m: billing.billing_repeat_offenders(_billing(m)),
    # realization
    "realization_month": lambda m: realization.revenue_realization(m, "month"),
    "realization_merchant": lambda m: realization.revenue_realization(m, "merchant"),
    "realization_overall": lambda m: realization.revenue_realization(m, "overall"),
    "realization_grains": realization.realization_grains,
    "m_funnel": lambda m: realization.funnel(realization.revenue_realization(m, "overall")),
    # reconciliation
    "recon_payments": reconciliation.reconcile_payments,
    "recon_invoices": reconciliation.reconcile_invoices,
    "recon_missing_invoices": reconciliation.reconcile_missing_invoices,
    "recon_summary": lambda m: reconciliation.reconciliation_summary(
        reconciliation.reconcile_invoices(m), reconciliation.reconcile_missing_invoices(m)
    ),
    # leakage
    "leakage_severity": lambda m: _events(m).select(
        "leakage_type", "merchant_id", "invoice_id", "transaction_id", "leakage_amount", "severity"
    ),
    "credit_recovery_status": lambda m: leakage.credit_recovery_status(
        m["invoices"], m["credit_notes"]
    ),
    "leakage_billing": lambda m: leakage.leakage_billing(m, _billing(m)),
    "leakage_missing_invoice": lambda m: leakage.leakage_missing_invoice(m, _billing(m)),
    "leakage_refund_fee": leakage.leakage_refund_fee,
    "leakage_rate_discrepancy": leakage.leakage_rate_discrepancy,
    "leakage_failed_payment": lambda m: leakage.leakage_failed_payment(m, m.as_of),
    "leakage_table": lambda m: leakage.leakage_table(_events(m), m.as_of),
    "leakage_by_type": lambda m: leakage.leakage_by(_events(m), "leakage_type"),
    "leakage_by_status": lambda m: leakage.leakage_by(_events(m), "status"),
    "leakage_by_severity": lambda m: leakage.leakage_by(_events(m), "severity"),
    "leakage_totals": lambda m: leakage.leakage_totals(_events(m)),
    "leakage_advisory_totals": lambda m: leakage.leakage_advisory_totals(_events(m), _billing(m)),
    "leakage_top_merchants": lambda m: leakage.leakage_top_merchants(_events(m)),
    "leakage_severity_counts": lambda m: leakage.leakage_severity_counts(_events(m)),
    "leakage_status_ordered": lambda m: leakage.leakage_status_ordered(_events(m)),
    # receivables
    "ar_aging": _aging,
    "aging_bucket": lambda m: m["invoices"].select(
        "invoice_id",
        aging_bucket(F.datediff(F.lit(m.as_of), F.col("due_date"))).alias("aging_bucket"),
    ),
    "ar_risk": lambda m: m["invoices"].select(
        "invoice_id",
        ar_risk(
            F.col("total_invoice_amount"), F.datediff(F.lit(m.as_of), F.col("due_date"))
        ).alias("risk_category"),
    ),
    "aging_summary": lambda m: receivables.aging_summary(_aging(m)),
    "ar_cumulative": lambda m: receivables.ar_cumulative(_aging(m)),
    "dso_overall": lambda m: receivables.dso_overall(m, m.as_of),
    "dso_monthly": receivables.dso_monthly,
    "dso_by_merchant": lambda m: receivables.dso_by(m, "merchant_id", m.as_of),
    "dso_by_segment": lambda m: receivables.dso_by(m, "merchant_segment", m.as_of),
    # collections
    "collection_rate": lambda m: collections.collection_rate(m, m.as_of),
    "recovery_rate": collections.recovery_rate,
    "avg_collection_time": collections.average_collection_time,
    "promise_to_pay": collections.promise_to_pay,
    "channel_effectiveness": lambda m: collections.channel_effectiveness(m["collection_activity"]),
    "segment_effectiveness": collections.segment_effectiveness,
    "payment_behavior": _behavior,
    "payer_segment": lambda m: _behavior(m).select("merchant_id", "payer_segment"),
    "payer_segment_summary": lambda m: collections.payer_segment_summary(_behavior(m)),
    "payer_segment_counts": lambda m: collections.payer_segment_counts(_behavior(m)),
    "collection_queue": _queue,
    "priority_tier": lambda m: collections.scored_invoices(m, _aging(m), _behavior(m)).groupBy("priority_tier", "recommended_action").agg(
        F.count(F.lit(1)).alias("invoice_count")
    ),
    "collections_summary": _flat_summary,
    # analyst questions
    "sql_01": adhoc.monthly_billed,
    "sql_02": adhoc.monthly_growth,
    "sql_03": adhoc.top_merchants,
    "sql_04": adhoc.outstanding_invoices,
    "sql_05": lambda m: adhoc.aging_buckets(m, m.as_of),
    "sql_06": lambda m: adhoc.dso(m, m.as_of),
    "sql_07": lambda m: adhoc.overdue_invoices(m, m.as_of),
    "sql_08": adhoc.monthly_collection_rate,
    "sql_09": adhoc.payment_delay_by_merchant,
    "sql_10": adhoc.underbilled_by_merchant,
    "sql_11": adhoc.error_rate_by_segment,
    "sql_12": lambda m: adhoc.misbilled_detail(m, under=True),
    "sql_13": lambda m: adhoc.misbilled_detail(m, under=False),
    "sql_14": adhoc.reconciliation_status,
    "sql_15": adhoc.duplicate_payments,
    "sql_16": adhoc.missing_invoice_months,
    "sql_17": adhoc.invoices_without_payment,
    "sql_18": adhoc.segment_summary,
    "sql_19": adhoc.merchant_net_revenue,
    "sql_20": lambda m: adhoc.priority_list(m, m.as_of),
    "sql_21": adhoc.monthly_variance,
    "sql_22": adhoc.revenue_concentration,
    "sql_23": adhoc.delay_by_segment,
    "sql_24": lambda m: adhoc.high_risk_accounts(m, m.as_of),
    "sql_25": adhoc.yield_by_activity,
    "sql_26": adhoc.promise_fulfilment,
    "sql_27": adhoc.dispute_summary,
    "sql_28": adhoc.refund_rate_by_industry,
    # star schema and measures
    "dim_merchant": lambda m: star.dim_merchant(_with_profiles(m)),
    "dim_date": lambda m: star.dim_date(star.fact_calendar(m, m.as_of)),
    "fact_invoices": star.fact_invoices,
    "fact_payments": star.fact_payments,
    "fact_collection_activity": lambda m: star.fact_collection_activity(_with_profiles(m)),
    "fact_leakage": lambda m: leakage.leakage_table(_events(m), m.as_of),
    "fact_ar_aging": _aging,
    **{
        name: (lambda m, name=name: measures.measure(m, name, ["merchant_segment"], m.as_of))
        for name in measures.MEASURES
    },
    "m_realization_by_month": lambda m: measures.measure(
        m, "m_realization", ["year_month"], m.as_of
    ),
    "m_recon_rate_total": lambda m: measures.measure(m, "m_recon_rate", [], m.as_of),
    "m_growth_mom": measures.growth_mom,
    "m_billed_vs_collected": measures.billed_vs_collected,
    "m_revenue_by_segment": measures.revenue_by_segment,
    "m_top10_merchants": measures.top_merchants,
    "m_expected_vs_billed": measures.expected_vs_billed,
    "m_leakage_by_type": lambda m: measures.leakage_by_type(_events(m)),
    "m_leakage_top15": lambda m: measures.leakage_top(_events(m), m["merchants"]),
    "m_billing_status_counts": lambda m: measures.billing_status_counts(_billing(m)),
    "m_merchant_invoice_detail": _one_invoiced_merchant,
    "m_ar_bucket_by_segment": lambda m: measures.ar_bucket_by_segment(_aging(m)),
    "m_dso_trend": receivables.dso_monthly,
    "m_queue": lambda m: _queue(m).select(
        "priority_rank", "merchant_name", "outstanding_amount", "days_overdue", "priority_tier"
    ),
    "m_success_by_channel_segment": measures.success_by_channel_segment,
    "m_recon_status_counts": lambda m: measures.recon_status_counts(star.fact_payments(m)),
    "m_mismatch_types": lambda m: measures.mismatch_types(
        star.fact_payments(m), reconciliation.reconcile_invoices(m)
    ),
    "m_leakage_trend": lambda m: measures.leakage_trend(_events(m), m.as_of),
    "m_top_control_failures": lambda m: measures.top_control_failures(star.fact_payments(m)),
    # spreadsheet model
    "xl_invoice_validation": worksheets.invoice_validation,
    "xl_ar_aging": lambda m: worksheets.aging_sheet(m, m.as_of),
    "xl_ar_aging_summary": lambda m: worksheets.aging_sheet_summary(
        worksheets.aging_sheet(m, m.as_of)
    ),
    "xl_reconciliation": worksheets.reconciliation_sheet,
    "xl_channel_effectiveness": worksheets.channel_sheet,
    "xl_monthly_mis": worksheets.monthly_mis,
    "xl_kpi_dashboard": worksheets.kpi_dashboard,
    "stratified_sample": lambda m: worksheets.stratified_sample(m["merchants"]).select(
        "merchant_id", "merchant_name", "merchant_segment"
    ),
    "stratified_sample_tables": lambda m: worksheets.sample_overview(worksheets.sample_tables(m)),
    # derivations
    "asof_contract_rate": lambda m: derivations.asof_contract_rate(
        m["raw_transactions"], m["contracts"]
    ),
    "rate_invoices": lambda m: derivations.rate_invoices(_with_discounts(m), m.as_of),
    "invoice_settlement_status": lambda m: derivations.invoice_settlement_status(m, m.as_of),
    "chase_candidates": lambda m: derivations.chase_candidates(
        derivations.invoice_settlement_status(m, m.as_of)
    ),
    "contract_intervals": derivations.contract_intervals,
    "refund_events": lambda m: derivations.refund_events(m["transactions"]),
}


def _with_steep_rates(m: BoundModel) -> dict[str, DataFrame]:
    """Contracts and priced transactions with rates stretched past the plausible range."""
    rate = money(F.col("transaction_fee_percent") * 5)
    return {
        name: m[name].withColumn("transaction_fee_percent", rate)
        for name in ("contracts", "transactions")
    }
