"""Quality checks, cleaning and constraints on dirty rows."""

from __future__ import annotations

import datetime as dt

import pytest

from tallywright.operators import cleaning, quality
from tallywright.sources import files
from tests.conftest import by_key, frame


@pytest.fixture(scope="module")
def dirty(spark):
    return {
        "merchants": frame(
            spark, "merchants",
            "merchant_id merchant_name industry merchant_segment onboarding_date agreed_fee_percent "
            "payment_terms_days merchant_status",
            [
                ("m1", "One", "Retail", "SMB", "2024-01-01", 2.5, 15, "Active"),
                ("m2", None, "Retail", "Huge", "1999-01-01", 20, 0, "Active"),
            ],
        ),
        "transactions": frame(
            spark, "transactions",
            "transaction_id merchant_id transaction_date order_id transaction_amount payment_status",
            [
                ("t1", "m1", "2025-01-01", "o1", 10, "Success"),
                ("t1", "m1", "2025-01-02", "o1", 12, "Success"),
                ("t2", None, "2025-01-01", "o2", -5, None),
                ("t3", "m1", "2025-01-01", "o3", -5, None),
                ("t4", "m9", "2025-01-01", "o4", 7, None),
                ("t5", "m1", "2025-01-01", "o5", 8, "Lost"),
                ("t6", "m1", "2025-01-01", "o5", 8, "Failed"),
            ],
        ),
        "invoices": frame(
            spark, "invoices",
            "invoice_id merchant_id billing_period_start invoice_date due_date subtotal discount "
            "taxable_amount tax_rate tax_amount total_invoice_amount invoice_status payment_status "
            "expected_fee billed_fee invoice_error_flag",
            [
                ("i1", "m1", "2025-01-01", "2025-02-01", None, 100, 0, 100, 0.18, 18, 118, "Issued", "Unpaid", 100, 100, 0),
                ("i2", "m1", "2025-02-01", "2025-03-01", "2025-02-01", None, None, None, 0.18, None, None, "Issued", "Unpaid", 55.55, None, 0),
                ("i3", "m1", "2025-03-01", "2025-04-01", "2025-05-01", None, None, None, 0.18, None, None, "Issued", "Unpaid", None, None, 0),
            ],
        ),
        "payments": frame(
            spark, "payments", "payment_id invoice_id merchant_id payment_date payment_amount payment_status",
            [
                ("p1", "i1", "m1", "2025-02-02", 118, "Success"),
                ("p2", "i9", "m1", "2025-02-02", None, "Success"),
                ("p3", None, "m1", "2031-02-02", 5, "Success"),
            ],
        ),
        "refunds": frame(
            spark, "refunds", "refund_id transaction_id merchant_id refund_date refund_amount refund_status",
            [
                ("r1", "t1", "m1", "2025-01-05", 1, "Processed"),
                ("r1", "t1", "m1", "2025-01-06", 1, "Processed"),
                ("r2", "t3", "m1", "2025-01-05", 1, "Processed"),
                ("r3", "t4", None, "2025-01-05", 1, "Processed"),
            ],
        ),
        "credit_notes": frame(
            spark, "credit_notes", "credit_note_id invoice_id merchant_id credit_note_date credit_amount status",
            [("c1", "i1", "m1", "2025-02-05", None, "Issued"), ("c2", "i1", "m1", "2025-02-06", 3, "Gone")],
        ),
        "contracts": frame(
            spark, "contracts",
            "contract_id merchant_id effective_from effective_to transaction_fee_percent payment_terms_days contract_status",
            [("k1", "m1", "2025-01-01", "2024-01-01", 2.5, 15, "Active")],
        ),
        "collection_activity": frame(
            spark, "collection_activity", "collection_id merchant_id invoice_id activity_date activity_type",
            [("a1", "m1", None, "2025-02-05", "Email")],
        ),
        "disputes": frame(
            spark, "disputes", "dispute_id merchant_id invoice_id dispute_date disputed_amount resolution_status",
            [("d1", "m1", "i1", "2025-02-05", -1, "Open")],
        ),
    }


@pytest.fixture(scope="module")
def findings(dirty):
    rows = quality.findings(dirty).collect()
    return {(r.table_name, r.check_name, r.column_name): r.violations for r in rows}


@pytest.mark.parametrize("where, count", [
    (("transactions", "rows", None), 7),
    (("transactions", "missing_values", "merchant_id"), 1),
    (("transactions", "missing_values", "payment_status"), 3),
    (("transactions", "duplicate_ids", "transaction_id"), 2),
    (("transactions", "duplicate_business_rows",
      "merchant_id, order_id, transaction_date, transaction_amount"), 2),
    (("transactions", "negative_amounts", "transaction_amount"), 2),
    (("transactions", "invalid_domain", "payment_status"), 1),
    (("transactions", "unresolved_reference", "merchant_id -> merchants.merchant_id"), 1),
    (("merchants", "missing_values", "merchant_name"), 1),
    (("merchants", "invalid_dates", "onboarding_date"), 1),
    (("merchants", "out_of_range", "agreed_fee_percent"), 1),
    (("merchants", "invalid_domain", "merchant_segment"), 1),
    (("contracts", "date_order", "effective_to < effective_from"), 1),
    (("invoices", "date_order", "due_date < invoice_date"), 1),
    (("payments", "invalid_dates", "payment_date"), 1),
    (("disputes", "negative_amounts", "disputed_amount"), 1),
])
def test_findings(findings, where, count):
    assert findings[where] == count


def test_clean_table_reports_nothing_but_rows_and_keys(findings):
    found = {k[1] for k in findings if k[0] == "collection_activity"}
    assert found == {"rows", "duplicate_ids"}


def test_text_dates_are_parsed(spark):
    df = spark.createDataFrame([("2025-01-01",), ("soon",), ("1950-01-01",), (None,)], "d string")
    [(check, column, count)] = quality.invalid_dates(df, ["d"], "2020-01-01", "2027-12-31")
    assert df.agg(count).first()[0] == 2


def test_spot_checks_count_null_merchants(dirty):
    rows = by_key(quality.dq_fk_spot(dirty), "table_name")
    assert rows["transactions"].violations == 2
    assert rows["payments"].violations == 1


def test_excess_key_rows(dirty):
    rows = by_key(quality.dq_dup_pk_extra(dirty), "table_name")
    assert rows["transactions"].violations == 1


def test_missing_cells(dirty):
    row = by_key(quality.dq_missing_cells(dirty), "table_name")["payments"]
    assert (row.missing_cells, row.missing_pct_of_cells) == (2, 11.111)


def test_clean_transactions_steps(dirty):
    cleaned = by_key(
        cleaning.clean_transactions(dirty["transactions"], ["transaction_date"]), "transaction_id"
    )
    assert set(cleaned) == {"t1", "t4", "t5", "t6"}
    assert float(cleaned["t1"].transaction_amount) == 10  # the first of the two
    assert cleaned["t4"].payment_status == "Unknown"


def test_clean_invoices_rebuilds_amounts(dirty):
    rows = by_key(cleaning.clean_invoices(dirty["invoices"]), "invoice_id")
    assert rows["i1"].due_date == dt.date(2025, 3, 3)
    rebuilt = rows["i2"]
    assert [float(rebuilt[c]) for c in ("subtotal", "tax_amount", "total_invoice_amount", "billed_fee")] == [
        55.55, 10.0, 65.55, 55.55
    ]
    assert rebuilt.invoice_error_flag == 1
    assert rows["i3"].total_invoice_amount is None


def test_clean_all_and_stats(dirty):
    orders = {"transactions": ["transaction_date"], "refunds": ["refund_date"]}
    cleaned = cleaning.clean_all(dirty, orders)
    assert {r.refund_id for r in cleaned["refunds"].collect()} == {"r1"}
    stats = {
        (r.table_name, r.step): r.row_count
        for r in cleaning.cleaning_stats(dirty, orders).collect()
    }
    assert stats["transactions", "rows_before"] == 7
    assert stats["transactions", "duplicate_rows_dropped"] == 1
    assert stats["transactions", "missing_merchant_dropped"] == 1
    assert stats["transactions", "negative_amount_dropped"] == 1  # t2 was gone before
    assert stats["transactions", "missing_status_filled"] == 1
    assert stats["refunds", "parent_dropped"] == 1
    for name, df in cleaned.items():
        assert stats[name, "rows_after"] == df.count()


def test_gate_raises_and_passes(dirty):
    rules = {
        (r.table_name, r.check_name, r.column_name)
        for r in quality.constraint_violations(dirty).collect()
    }
    assert ("payments", "foreign_key", "invoice_id -> invoices.invoice_id") in rules
    assert ("merchants", "positive", "payment_terms_days") in rules
    assert ("credit_notes", "domain", "status") in rules
    with pytest.raises(ValueError, match="constraints violated"):
        quality.require_sound(dirty)
    sound = {"merchants": dirty["merchants"].where("merchant_id = 'm1'")}
    quality.require_sound(sound)


def test_csv_round_trip_keeps_types_and_bad_lines(spark, dirty, tmp_path):
    path = str(tmp_path / "payments.csv")
    files.write_csv(dirty["payments"], path)
    again = files.scan_csv(spark, path, dirty["payments"].schema)
    assert [r._corrupt_record for r in again.collect()] == [None] * 3
    assert again.schema["payment_date"].dataType.typeName() == "date"
    bad = tmp_path / "bad.csv"
    bad.write_text("payment_id,payment_amount\np1,12.50\np2,twelve\n")
    rows = by_key(
        files.scan_csv(spark, str(bad), dirty["payments"].select("payment_id", "payment_amount").schema),
        "payment_id",
    )
    assert rows["p1"]._corrupt_record is None
    assert rows["p2"].payment_amount is None and "twelve" in rows["p2"]._corrupt_record


def test_load_model_is_strict(dirty, tmp_path):
    with pytest.raises(ValueError):
        files.load_model(dirty, str(tmp_path / "model"))
