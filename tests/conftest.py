"""Shared session, typed test frames and two small hand-made ledgers."""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywright.model import TABLES  # noqa: E402
from tallywright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(8, partitions=2)
    session.sparkContext.setLogLevel("ERROR")
    return session


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def frame(spark: SparkSession, table: str, columns: str, rows: list[tuple]) -> DataFrame:
    """Rows of a model table with its declared types; dates and money come as text or numbers."""
    declared = {f.name: f for f in TABLES[table].schema.fields}
    schema = T.StructType([declared[c] for c in columns.split()])

    def typed(value, kind):
        if value is None:
            return None
        if isinstance(kind, T.DateType):
            return day(value)
        if isinstance(kind, T.DecimalType):
            return Decimal(str(value))
        return value

    data = [
        tuple(typed(v, f.dataType) for v, f in zip(row, schema.fields, strict=True)) for row in rows
    ]
    return spark.createDataFrame(data, schema)


def by_key(df: DataFrame, key: str) -> dict:
    return {row[key]: row for row in df.collect()}


COLLECTIONS_AS_OF = dt.date(2024, 9, 30)


@pytest.fixture(scope="session")
def small(spark) -> dict[str, DataFrame]:
    """Four payers in the autumn of 2024; every invoice stands for one way to be (not) open."""
    months = {m: (f"2024-{m:02}-01", f"2024-{m + 1:02}-01") for m in range(1, 12)}

    def bill(name, merchant, month, due, total, status="Issued", paid="Unpaid"):
        start, dated = months[month] if isinstance(month, int) else month
        return (name, merchant, start, dated, due, total, total, total, status, paid)

    return {
        "merchants": frame(
            spark, "merchants",
            "merchant_id merchant_name merchant_segment payment_terms_days merchant_status",
            [
                ("kiln", "Kiln Ceramics", "Mid-Market", 30, "Active"),
                ("loom", "Loom Weavers", "Long-tail", 15, "Active"),
                ("mill", "Mill Holdings", "Enterprise", 45, "Active"),
                ("quay", "Quay Imports", "SMB", 15, "Suspended"),
            ],
        ),
        "invoices": frame(
            spark, "invoices",
            "invoice_id merchant_id billing_period_start invoice_date due_date "
            "total_invoice_amount billed_fee expected_fee invoice_status payment_status",
            [
                bill("q-old", "quay", ("2023-01-01", "2023-02-01"), "2023-02-16", 6400),
                bill("k-late", "kiln", 5, "2024-07-01", 840, "Paid", "Paid"),
                bill("k-rest", "kiln", 6, "2024-07-31", 1260, paid="Partially Paid"),
                bill("l-void", "loom", 6, "2024-07-16", 75, "Void"),
                bill("l-over", "loom", 7, "2024-08-16", 210, "Paid", "Paid"),
                bill("l-fail", "loom", 8, "2024-09-16", 130),
                bill("m-note", "mill", 6, "2024-08-15", 3300),
                bill("m-next", "mill", 8, "2024-10-16", 950),
                bill("q-free", "quay", 3, "2024-04-16", 0, "Paid", "Paid"),
            ],
        ),
        "payments": frame(
            spark, "payments",
            "payment_id invoice_id merchant_id payment_date payment_amount payment_status settlement_date",
            [
                ("1", "k-rest", "kiln", "2024-08-10", 300, "Success", "2024-08-12"),
                ("2", "k-rest", "kiln", "2024-08-20", 120, "Success", None),
                ("3", "k-late", "kiln", "2024-07-13", 840, "Success", "2024-07-15"),
                ("4", "l-over", "loom", "2024-08-12", 210, "Success", None),
                ("5", "l-over", "loom", "2024-08-14", 210, "Success", None),
                ("6", "l-fail", "loom", "2024-09-18", 130, "Failed", None),
                ("7", "q-free", "quay", "2024-04-20", 0, "Success", None),
            ],
        ),
        "credit_notes": frame(
            spark, "credit_notes", "credit_note_id invoice_id merchant_id credit_amount status",
            [
                ("a", "m-note", "mill", 2100, "Issued"), ("b", "m-note", "mill", 1200, "Applied"),
                ("c", "m-next", "mill", 950, "Pending"),
            ],
        ),
        "collection_activity": frame(
            spark, "collection_activity",
            "collection_id merchant_id invoice_id activity_date activity_type contact_channel "
            "outcome promised_payment_date",
            [
                ("v", "kiln", "k-rest", "2024-08-01", "Phone", "Phone", "Promise to Pay", "2024-08-11"),
                # kept too late for this date
                ("w", "loom", "l-over", "2024-08-05", "Payment Promise", "WhatsApp", "Promise to Pay", "2024-08-09"),
                # a promise without a date counts in the rate only
                ("x", "quay", "q-old", "2024-09-02", "Escalation", "Phone", "Promise to Pay", None),
                ("y", "loom", "l-fail", "2024-09-20", "Reminder", "Email", "No Response", None),
                ("z", "kiln", "k-late", "2024-07-10", "Reminder", "Email", "Payment Received", None),
                ("u", "quay", "q-old", "2024-09-09", "Email", "Email", "Disputed", None),
            ],
        ),
    }


CONTROLS_AS_OF = dt.date(2023, 12, 31)


@pytest.fixture(scope="session")
def controls(spark) -> dict[str, DataFrame]:
    """A row per billing, reconciliation and leakage case, in 2023."""
    invoice = (
        "invoice_id merchant_id billing_period_start invoice_date due_date total_invoice_amount "
        "expected_fee billed_fee invoice_status payment_status invoice_error_flag"
    )

    def billed(name, merchant, period, expected, fee, total=None):
        year, month = int(period[:4]), int(period[5:7])
        dated = f"{year + month // 12}-{month % 12 + 1:02}-02"
        due = f"{year + month // 12}-{month % 12 + 1:02}-22"
        wrong = int(fee is not None and fee != expected)
        return (name, merchant, period, dated, due, fee if total is None else total, expected, fee,
                "Issued", "Unpaid", wrong)

    def settled(name, total, status="Issued"):
        return (name, "oak", "2023-09-01", "2023-10-02", "2023-10-22", total, total, total, status, "Paid", 0)

    return {
        "merchants": frame(
            spark, "merchants",
            "merchant_id merchant_name merchant_segment payment_terms_days merchant_status",
            [("oak", "Oak & Sons", "Mid-Market", 20, "Active"), ("elm", "Elm Estate", "Long-tail", 20, "Active")],
        ),
        "contracts": frame(
            spark, "contracts", "contract_id merchant_id effective_from transaction_fee_percent",
            [
                ("oak-1", "oak", "2022-04-01", 1.2), ("elm-1", "elm", "2022-10-01", 4.0),
                ("oak-2", "oak", "2023-07-01", 1.6),
                # 45 days before 2023-08-01, 46 before 2023-11-01
                ("elm-2", "elm", "2023-06-17", 4.5), ("elm-3", "elm", "2023-09-16", 5.0),
            ],
        ),
        "transactions": frame(
            spark, "transactions",
            "transaction_id merchant_id transaction_date transaction_amount "
            "transaction_fee_percent expected_platform_fee payment_status refund_amount",
            [
                ("s1", "oak", "2023-02-03", 7500, 1.2, 90, "Success", 0),
                ("s2", "elm", "2023-02-28", 2000, 4.0, 80, "Success", 500),
                ("s3", "oak", "2023-07-14", 5000, 1.2, 80, "Success", 0),
                ("s4", "oak", "2023-11-09", 4500, 1.6, 72, "Success", 0),
                ("s5", "oak", "2023-11-30", 250, 1.6, 4, "Pending", 0),
                ("s6", "elm", "2023-03-05", 1000, 4.0, 40, "Success", 0),
            ],
        ),
        "invoices": frame(
            spark, "invoices", invoice,
            [
                billed("fair", "oak", "2023-02-01", 90, 90),
                billed("back", "elm", "2023-02-01", 80, 80),
                billed("low", "elm", "2023-03-01", 40, 31),
                billed("lag", "oak", "2023-07-01", 80, 60),
                billed("day45", "elm", "2023-08-01", 70, 77),
                billed("day46", "elm", "2023-11-01", 66, 55),
                billed("next", "elm", "2023-12-01", 50, 50),
                billed("blank", "elm", "2023-10-01", 90, None, total=64),
                settled("whole", 720), settled("bounced", 333), settled("double", 480), settled("much", 150),
                settled("before", 610), settled("some", 905), settled("gone", 44, "Void"),
            ],
        ),
        "payments": frame(
            spark, "payments",
            "payment_id invoice_id merchant_id payment_date payment_amount payment_status settlement_date",
            [
                ("whole-1", "whole", "oak", "2023-10-19", 720, "Success", "2023-10-20"),
                ("some-1", "some", "oak", "2023-10-25", 300, "Success", "2023-10-26"),
                ("some-2", "some", "oak", "2023-11-25", 250, "Success", "2023-11-26"),
                ("double-1", "double", "oak", "2023-10-11", 240, "Success", "2023-10-12"),
                ("double-2", "double", "oak", "2023-10-18", 240, "Success", None),
                ("much-1", "much", "oak", "2023-10-21", 175, "Success", "2023-10-23"),
                ("before-1", "before", "oak", "2023-10-30", 610, "Success", "2023-10-27"),
                ("gone-1", "gone", "oak", "2023-10-30", 44, "Success", "2023-10-31"),
                ("bounced-1", "bounced", "oak", "2023-10-05", 333, "Failed", None),
                # failed, but the invoice is due after the last day of the books
                ("late-1", "next", "elm", "2023-12-20", 50, "Failed", None),
                ("stray-1", None, "elm", "2023-08-08", 18, "Success", "2023-08-09"),
                ("stray-2", None, "elm", "2023-08-08", 18, "Success", "2023-08-09"),
                ("wrong-1", "unheard-of", "elm", "2023-08-15", 25, "Success", None),
            ],
        ),
        "credit_notes": frame(
            spark, "credit_notes",
            "credit_note_id invoice_id merchant_id credit_note_date credit_amount status",
            [
                ("n1", "low", "elm", "2023-05-01", 5, "Applied"),
                ("n2", "low", "elm", "2023-05-02", 4, "Pending"),
                ("n3", "day46", "elm", "2023-12-28", 11, "Pending"),
            ],
        ),
    }
