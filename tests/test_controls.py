"""Billing, reconciliation, leakage and realization on the controls ledger."""

from __future__ import annotations

import pytest

from tallywright.operators import billing, leakage, realization, reconciliation
from tests.conftest import CONTROLS_AS_OF as AS_OF
from tests.conftest import by_key


@pytest.fixture(scope="module")
def months(controls):
    return billing.billing_merchant_month(controls)


@pytest.fixture(scope="module")
def findings(controls, months):
    return leakage.leakage_table(leakage.leakage_events(controls, months, AS_OF), AS_OF).collect()


@pytest.mark.parametrize("invoice, status, difference", [
    ("fair", "Correct", 0),
    ("low", "Underbilled", -9),
    ("lag", "Pricing Mismatch", -20),
    ("day45", "Pricing Mismatch", 7),  # 45 days after a contract start
    ("day46", "Underbilled", -11),  # 46 days after
    ("blank", "Correct", None),  # unknown difference is not an error
])
def test_billing_status(months, invoice, status, difference):
    row = by_key(months, "invoice_id")[invoice]
    assert row.billing_status == status
    assert (None if row.revenue_difference is None else float(row.revenue_difference)) == difference


def test_month_without_invoice(months):
    [row] = months.where("billing_status = 'Missing Invoice'").collect()
    assert (row.merchant_id, row.billing_period, row.invoice_id) == ("oak", "2023-11", None)
    assert float(row.expected_revenue) == 72  # the pending sale does not count
    assert row.variance_percent == -100


def test_errors_by_segment_fills_zero(controls, months):
    rows = by_key(
        billing.billing_errors_by_segment(months, controls["merchants"]), "merchant_segment"
    )
    assert rows["Long-tail"].missing_invoice == 0
    assert (rows["Long-tail"].pricing_mismatch, rows["Mid-Market"].pricing_mismatch) == (1, 1)


@pytest.mark.parametrize("invoice, status", [
    ("whole", "MATCHED"), ("bounced", "MISSING_PAYMENT"), ("double", "DUPLICATE"),
    ("much", "AMOUNT_MISMATCH"), ("before", "TIMING_MISMATCH"), ("some", "PARTIAL"), ("gone", "VOID"),
])
def test_invoice_reconciliation(controls, invoice, status):
    rows = by_key(reconciliation.reconcile_invoices(controls), "invoice_id")
    assert rows[invoice].reconciliation_status == status


@pytest.mark.parametrize("payment, status", [
    ("whole-1", "MATCHED"), ("stray-1", "ORPHAN"), ("stray-2", "ORPHAN"),
    ("wrong-1", "UNMATCHED"), ("double-1", "DUPLICATE"), ("double-2", "DUPLICATE"),
    ("before-1", "TIMING_MISMATCH"), ("much-1", "MATCHED"), ("bounced-1", "NOT_APPLICABLE_FAILED"),
])
def test_payment_reconciliation(controls, payment, status):
    rows = by_key(reconciliation.reconcile_payments(controls), "payment_id")
    assert len(rows) == controls["payments"].count()
    assert rows[payment].reconciliation_status == status


def test_reconciliation_summary(controls):
    rows = by_key(
        reconciliation.reconciliation_summary(
            reconciliation.reconcile_invoices(controls),
            reconciliation.reconcile_missing_invoices(controls),
        ),
        "reconciliation_status",
    )
    assert set(rows) == {
        "MATCHED", "MISSING_PAYMENT", "DUPLICATE", "AMOUNT_MISMATCH", "TIMING_MISMATCH", "PARTIAL",
        "VOID", "MISSING_INVOICE",
    }
    assert sum(r.percent_of_total for r in rows.values()) == pytest.approx(100, abs=0.05)
    rate = rows["MATCHED"].reconciliation_rate_percent
    assert 0 <= rate <= 100 and rate == rows["MATCHED"].percent_of_total


def test_leakage_types_and_ids(findings):
    assert {r.leakage_type for r in findings} == set(leakage.TYPE_ORDER)
    assert len({r.leakage_id for r in findings}) == len(findings)
    assert sorted(r.leakage_id for r in findings)[0] == "LKG0000001"


def test_applied_credit_wins_over_pending(findings):
    [row] = [r for r in findings if r.invoice_id == "low"]
    assert (row.leakage_type, float(row.leakage_amount), row.status) == (
        "Underbilling", 9, "Recovered"
    )


def test_pending_credit_is_recoverable_and_none_is_outstanding(findings):
    status = {r.invoice_id: r.status for r in findings if r.leakage_type in ("Underbilling", "Pricing Mismatch")}
    assert status["day46"] == "Recoverable"
    assert status["lag"] == "Outstanding"
    assert "day45" not in status  # overbilled


def test_missing_invoice_and_failed_payment(findings):
    [missing] = [r for r in findings if r.leakage_type == "Missing Invoice"]
    assert (missing.merchant_id, float(missing.leakage_amount)) == ("oak", 72)
    failed = [r for r in findings if r.leakage_type == "Failed Payment"]
    assert [r.invoice_id for r in failed] == ["bounced"]  # the other one is not due yet


def test_advisory_findings(findings):
    [rate] = [r for r in findings if r.leakage_type == "Rate Discrepancy"]
    assert (rate.transaction_id, float(rate.leakage_amount)) == ("s3", 20)
    [fee] = [r for r in findings if r.leakage_type.startswith("Refund Fee")]
    assert (fee.invoice_id, float(fee.leakage_amount), fee.status) == ("back", 20, "Under Review")


def test_realized_totals_leave_out_advisory(controls, months):
    events = leakage.leakage_events(controls, months, AS_OF)
    total = leakage.leakage_totals(events).first()
    assert float(total.total_leakage) == 9 + 11 + 20 + 72 + 333
    items = by_key(leakage.leakage_advisory_totals(events, months), "advisory_item")
    assert items["Overbilled Pricing Mismatch"].item_count == 1


def test_realization_funnel_adds_up(controls):
    row = realization.revenue_realization(controls, "overall").first()
    assert row.collected_revenue + row.credited_amount + row.outstanding_revenue == row.billed_revenue
    assert 0 <= row.billing_accuracy_percent <= 100


def test_cash_without_invoice_only_shows_overall(controls):
    overall = realization.revenue_realization(controls, "overall").first()
    merchants = by_key(realization.revenue_realization(controls, "merchant"), "merchant_id")
    assert set(merchants) == {"oak", "elm"}
    lost = overall.collected_revenue - sum(r.collected_revenue for r in merchants.values())
    assert float(lost) == 18 + 18 + 25  # two strays and the unknown invoice


def test_one_aggregate_gives_all_grains(controls):
    grains = realization.realization_grains(controls)
    for grain in ("month", "merchant", "overall"):
        want = realization.revenue_realization(controls, grain)
        got = realization.realization_of(grains, grain)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
