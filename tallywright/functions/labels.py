"""Classification of amounts, ages and scores into labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket bounds (upper end included) and their labels.
AGING_BOUNDS = ((0, "Current"), (30, "1-30 days"), (60, "31-60 days"), (90, "61-90 days"))
AGING_LAST = "90+ days"
AGING_LABELS = ("Current", "1-30 days", "31-60 days", "61-90 days", "90+ days")
SEVERITY_BOUNDS = ((100, "Low"), (500, "Medium"), (2000, "High"))
SEVERITY_LAST = "Critical"
SEVERITY_LABELS = ("Low", "Medium", "High", "Critical")
AMOUNT_SCORES = ((500, 0), (2000, 1), (8000, 2))
AGE_SCORES = ((0, 0), (30, 1), (60, 2))
TOP_SCORE = 3
RISK_BOUNDS = ((1, "Low"), (3, "Medium"), (5, "High"))
RISK_LAST = "Critical"

# Payer segments, priority tiers and what to do about each tier.
PAYER_SEGMENTS = ("Excellent", "Good", "Moderate", "High-risk", "Insufficient Data")
PAYER_RISK = {
    "Excellent": 0, "Good": 30, "Moderate": 60, "High-risk": 100, "Insufficient Data": 50,
}
STATUS_RISK = {"Active": 20, "Suspended": 80, "Churned": 100}
UNKNOWN_RISK = 50
TIER_ACTIONS = {
    "Critical": "Immediate escalation - account manager + finance lead call",
    "High": "Phone + email follow-up within 48 hours",
    "Medium": "Standard reminder sequence (email, then phone)",
    "Low": "Automated reminder only",
}


def bin_right_closed(value: Column, bounds: Sequence[tuple], last) -> Column:
    """Label of the first bound that is >= value; NULL stays NULL."""
    label = F.when(value.isNull(), F.lit(None))
    for upper, name in bounds:
        label = label.when(value <= F.lit(upper), F.lit(name))
    return label.otherwise(F.lit(last))


def aging_bucket(days_overdue: Column) -> Column:
    return F.coalesce(bin_right_closed(days_overdue, AGING_BOUNDS, AGING_LAST), F.lit(AGING_LAST))


def leakage_severity(amount: Column) -> Column:
    return bin_right_closed(amount, SEVERITY_BOUNDS, SEVERITY_LAST)


def ar_risk(outstanding: Column, days_overdue: Column) -> Column:
    score = bin_right_closed(outstanding, AMOUNT_SCORES, TOP_SCORE) + bin_right_closed(
        days_overdue, AGE_SCORES, TOP_SCORE
    )
    return bin_right_closed(score, RISK_BOUNDS, RISK_LAST)


def payer_segment(avg_delay: Column, on_time_percent: Column) -> Column:
    return (
        F.when(avg_delay.isNull(), "Insufficient Data")
        .when(avg_delay <= 0, "Excellent")
        .when((avg_delay <= 15) & (on_time_percent >= 50), "Good")
        .when(avg_delay <= 30, "Moderate")
        .otherwise("High-risk")
    )


def priority_tier(score: Column) -> Column:
    return (
        F.when(score >= 75, "Critical")
        .when(score >= 55, "High")
        .when(score >= 30, "Medium")
        .otherwise("Low")
    )


def lookup(value: Column, mapping: dict, default) -> Column:
    """Constant dictionary as a CASE expression."""
    result = F.when(F.lit(False), F.lit(default))
    for key, mapped in mapping.items():
        result = result.when(value == F.lit(key), F.lit(mapped))
    return result.otherwise(F.lit(default))
