"""Receivables and collections on the small ledger."""

from __future__ import annotations

import datetime as dt

import pytest

from tallywright.operators import collections, receivables
from tests.conftest import COLLECTIONS_AS_OF as AS_OF
from tests.conftest import by_key


@pytest.fixture(scope="module")
def aging(small):
    return by_key(receivables.ar_aging(small, AS_OF), "invoice_id")


@pytest.fixture(scope="module")
def behavior(small):
    return by_key(collections.payment_behavior(small, AS_OF), "merchant_id")


@pytest.fixture(scope="module")
def queue(small):
    frame = collections.collection_queue(
        small, receivables.ar_aging(small, AS_OF), collections.payment_behavior(small, AS_OF)
    )
    return sorted(frame.collect(), key=lambda r: r.priority_rank)


def test_settled_credited_void_overpaid_and_zero_invoices_are_not_open(aging):
    assert {k: float(r.outstanding_amount) for k, r in aging.items()} == {
        "k-rest": 1260 - 300 - 120,
        "l-fail": 130,  # a failed payment pays nothing
        "m-next": 950,  # a pending note reduces nothing
        "q-old": 6400,
    }


def test_buckets_by_days_overdue(aging):
    assert {k: (r.days_overdue, r.aging_bucket) for k, r in aging.items()} == {
        "m-next": (-16, "Current"), "l-fail": (14, "1-30 days"), "k-rest": (61, "61-90 days"),
        "q-old": (592, "90+ days"),
    }
    assert aging["q-old"].risk_category == "High"


def test_summary_keeps_empty_buckets_in_order_and_adds_up(small):
    rows = receivables.aging_summary(receivables.ar_aging(small, AS_OF)).collect()
    assert [r.aging_bucket for r in rows] == [
        "Current", "1-30 days", "31-60 days", "61-90 days", "90+ days"
    ]
    assert [r.invoice_count for r in rows] == [1, 1, None, 1, 1]
    assert sum(r.percent_of_total_ar or 0 for r in rows) == pytest.approx(100, abs=0.05)


def test_dso_without_sales_is_null(small):
    row = receivables.dso_overall(small, dt.date(2026, 1, 1)).first()
    assert row.dso_days is None
    # open balances, less what "l-over" was paid beyond its amount
    assert float(row.total_ar) == 840 + 130 + 950 + 6400 - 210


def test_dso_with_sales(small):
    row = receivables.dso_overall(small, AS_OF).first()
    # dated in the last ninety days: "l-over", "l-fail", "m-next"; the July ones are just older
    assert float(row.trailing_credit_sales) == 210 + 130 + 950
    assert row.dso_days == pytest.approx(8110 / 1290 * 90, abs=0.05)


def test_dso_by_segment_and_month(small):
    segments = by_key(receivables.dso_by(small, "merchant_segment", AS_OF), "merchant_segment")
    assert set(segments) == {"Enterprise", "Mid-Market", "SMB", "Long-tail"}
    assert segments["SMB"].dso_days is None
    assert segments["Enterprise"].dso_days == 90.0
    months = by_key(receivables.dso_monthly(small), "month")
    assert months["2024-08"].dso_days == -31.0  # paid twice in full: minus one month


def test_collection_time_counts_paid_invoices_with_a_payment(small):
    row = collections.average_collection_time(small).first()
    # last payments: twelve days late, two early, four late
    assert row.paid_invoices_measured == 3
    assert row.avg_collection_days == pytest.approx((12 - 2 + 4) / 3, abs=0.05)
    assert row.median_collection_days == 4


def test_recovery_looks_at_chased_invoices(small):
    row = collections.recovery_rate(small).first()
    assert row.invoices_chased == 5
    assert float(row.amount_recovered) == 420 + 840 + 210  # at most what was invoiced


def test_promises(small):
    row = collections.promise_to_pay(small).first()
    assert (row.promises_made, row.promises_fulfilled) == (2, 1)
    assert row.promise_fulfillment_rate_percent == 50
    assert row.promise_to_pay_rate_percent == 50  # three of six, the undated one included


def test_channels(small):
    channels = by_key(
        collections.channel_effectiveness(small["collection_activity"]), "contact_channel"
    )
    assert (channels["Email"].total_activities, channels["Phone"].total_activities) == (3, 2)
    assert channels["Email"].success_rate_percent == pytest.approx(33.33, abs=0.01)
    segments = by_key(collections.segment_effectiveness(small), "merchant_segment")
    assert segments["Mid-Market"].payments_received == 1


def test_collection_rate_window(small):
    row = collections.collection_rate(small, AS_OF).first()
    assert row.period_start == dt.date(2024, 7, 2)
    assert float(row.billed_revenue) == 1290
    assert float(row.collected_revenue) == 300 + 120 + 840 + 210 + 210


def test_payer_segments(behavior):
    assert behavior["loom"].avg_payment_delay_days == -2
    assert behavior["loom"].payer_segment == "Excellent"
    assert behavior["kiln"].avg_payment_delay_days == 12  # the partly paid invoice does not count
    assert behavior["mill"].avg_payment_delay_days is None
    assert behavior["mill"].payer_segment == "Insufficient Data"
    assert float(behavior["loom"].outstanding_balance) == 130  # the overpaid invoice counts as none


def test_segment_summary_drops_absent_segments(small, behavior):
    rows = collections.payer_segment_summary(collections.payment_behavior(small, AS_OF)).collect()
    assert sorted(r.payer_segment for r in rows) == sorted({r.payer_segment for r in behavior.values()})
    assert sum(r.merchant_count for r in rows) == len(behavior)


def test_queue_order_and_bounds(queue):
    assert [r.priority_rank for r in queue] == [1, 2, 3]
    scores = [r.priority_score for r in queue]
    assert scores == sorted(scores, reverse=True)
    assert all(0 <= s <= 100 for s in scores)
    assert queue[0].invoice_id == "q-old"
    assert {r.invoice_id for r in queue} == {"q-old", "k-rest", "l-fail"}
    assert all(r.days_overdue > 0 for r in queue)


def test_summary_bundle(small):
    row = collections.collections_summary(small, AS_OF).first()
    assert row.dso_overall.dso_days == pytest.approx(8110 / 1290 * 90, abs=0.05)
    assert row.recovery_rate.invoices_chased == 5
    assert row.promise_to_pay.promises_made == 2
