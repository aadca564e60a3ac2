"""The whole batch from raw CSV files to the star schema."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from tallywright.__main__ import run
from tallywright.model import TABLES
from tallywright.operators import leakage, quality, receivables
from tallywright.operators.billing import billing_merchant_month
from tallywright.operators.cleaning import clean_all
from tallywright.sources.files import read_model, read_raw_tables

AS_OF = dt.date(2026, 6, 1)

RAW = {
    "merchants": """merchant_id,merchant_name,industry,merchant_segment,city,state,country,onboarding_date,account_manager,pricing_plan,contract_start_date,contract_end_date,agreed_fee_percent,monthly_subscription_fee,payment_terms_days,merchant_status
m1,Lamp Shop,Retail,SMB,Pune,MH,IN,2024-01-05,Kim,Standard,2024-01-05,,2.5,100,15,Active
m2,Tea House,Food,Enterprise,Delhi,DL,IN,2024-02-01,Lee,Custom,2024-02-01,2026-12-31,2.0,0,30,Churned
""",
    "contracts": """contract_id,merchant_id,effective_from,effective_to,pricing_plan,transaction_fee_percent,fixed_transaction_fee,subscription_fee,payment_terms_days,discount_percent,minimum_monthly_fee,contract_status
k1,m1,2024-01-05,,Standard,2.5,0,100,15,0,0,Active
k2,m2,2024-02-01,2026-12-31,Custom,2.0,0,0,30,5,2000,Terminated
""",
    "transactions": """transaction_id,merchant_id,transaction_date,order_id,transaction_amount,transaction_fee_percent,expected_platform_fee,payment_method,payment_status,order_status,refund_amount,discount_amount,currency,created_timestamp
t1,m1,2026-01-10,o1,4000,2.5,100,UPI,Success,Delivered,0,0,INR,2026-01-10 10:00:00
t1,m1,2026-01-10,o1,4000,2.5,100,UPI,Success,Delivered,0,0,INR,2026-01-10 10:00:00
t2,m2,2026-01-11,o2,9000,2.0,180,Card,Success,Returned,4500,0,INR,2026-01-11 10:00:00
t3,,2026-01-11,o3,50,2.0,1,Card,Success,Delivered,0,0,INR,2026-01-11 10:00:00
t4,m1,2026-02-11,o4,-50,2.5,1,Card,,Delivered,0,0,INR,2026-02-11 10:00:00
t5,m1,2026-02-12,o5,2000,2.5,50,Card,Success,Delivered,0,0,INR,2026-02-12 10:00:00
""",
    "invoices": """invoice_id,merchant_id,billing_period_start,billing_period_end,invoice_date,due_date,subtotal,discount,taxable_amount,tax_rate,tax_amount,total_invoice_amount,currency,invoice_status,payment_status,expected_fee,billed_fee,invoice_error_flag
i1,m1,2026-01-01,2026-01-31,2026-02-02,2026-02-17,80,0,80,0.18,14.4,94.4,INR,Overdue,Partially Paid,100,80,1
i2,m2,2026-01-01,2026-01-31,2026-02-02,,,,,0.18,,,INR,Issued,Unpaid,180,,0
""",
    "payments": """payment_id,invoice_id,merchant_id,payment_date,payment_amount,payment_method,payment_reference,payment_status,bank_reference,settlement_date
p1,i1,m1,2026-02-20,40,UPI,x,Success,y,2026-02-21
p2,i2,m2,2026-02-20,,UPI,x,Success,y,2026-02-21
""",
    "refunds": """refund_id,transaction_id,merchant_id,refund_date,refund_amount,refund_reason,refund_status
r1,t2,m2,2026-01-15,4500,Other,Processed
r2,t4,m1,2026-02-15,10,Other,Processed
""",
    "credit_notes": """credit_note_id,invoice_id,merchant_id,credit_note_date,credit_amount,reason,status
c1,i1,m1,2026-03-01,20,Billing Error,Issued
""",
    "collection_activity": """collection_id,merchant_id,invoice_id,activity_date,activity_type,contact_channel,collector,outcome,promised_payment_date,promised_amount,notes
a1,m1,i1,2026-02-25,Email,Email,Kim,Promise to Pay,2026-03-01,54.4,soon
""",
    "disputes": """dispute_id,merchant_id,invoice_id,dispute_date,dispute_type,disputed_amount,resolution_status,resolution_date,resolution_amount
d1,m1,i1,2026-02-26,Tax Error,5,Open,,
""",
}


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    for name, text in RAW.items():
        (raw / f"{name}.csv").write_text(text)
    folder = tmp_path_factory.mktemp("out")
    run(spark, str(raw), str(folder), AS_OF, csv=True)
    return folder


def test_model_is_clean_and_typed(spark, out):
    model = read_model(spark, f"{out}/model")
    assert set(model) == set(TABLES)
    assert {r.transaction_id for r in model["transactions"].collect()} == {"t1", "t2", "t5"}
    rebuilt = model["invoices"].where("invoice_id = 'i2'").first()
    assert float(rebuilt.total_invoice_amount) == 212.4
    assert rebuilt.due_date == dt.date(2026, 3, 4)
    assert model["refunds"].count() == 1


def test_reports(spark, out):
    def report(name):
        return spark.read.parquet(f"{out}/reports/{name}")

    assert len([p for p in (out / "reports").iterdir() if p.name not in ("csv",)]) == 20
    model = read_model(spark, f"{out}/model")
    aging = {r.invoice_id: float(r.outstanding_amount) for r in report("ar_aging").collect()}
    assert aging == {"i1": 34.4, "i2": 212.4}
    direct = receivables.ar_aging(model, AS_OF).collect()
    assert sorted(direct) == sorted(report("ar_aging").collect())
    months = billing_merchant_month(model)
    events = leakage.leakage_events(model, months, AS_OF)
    assert report("revenue_leakage").count() == events.count()
    assert report("collection_priority_queue").count() == 2
    text = spark.read.option("header", True).csv(f"{out}/reports/csv/ar_aging")
    assert text.columns == report("ar_aging").columns
    assert {r.outstanding_amount for r in text.collect()} == {"34.40", "212.40"}


def test_json_summary(out):
    [part] = (out / "reports" / "collections_summary.json").glob("part-*.json")
    summary = json.loads(part.read_text())
    assert set(summary) == {
        "collection_rate", "recovery_rate", "average_collection_time", "promise_to_pay",
        "dso_overall",
    }
    assert summary["promise_to_pay"]["promises_fulfilled"] == 1
    assert summary["average_collection_time"]["avg_collection_days"] is None


def test_star_facts_are_partitioned_by_month(spark, out):
    invoices = spark.read.parquet(f"{out}/star/fact_invoices")
    assert "year_month" in invoices.columns
    assert (out / "star" / "fact_invoices" / "year_month=2026-02").is_dir()
    assert spark.read.parquet(f"{out}/star/dim_date").where("is_month_end").count() >= 2


def test_quality_outputs(spark, out):
    stats = {
        (r.table_name, r.step): r.row_count
        for r in spark.read.parquet(f"{out}/quality/cleaning_stats").collect()
    }
    assert stats["transactions", "rows_before"] == 6
    assert stats["transactions", "rows_after"] == 3
    assert stats["refunds", "parent_dropped"] == 1


def test_no_fact_date_is_missing_from_the_calendar(spark, out):
    days = {r.date for r in spark.read.parquet(f"{out}/star/dim_date").select("date").collect()}
    for name, columns in {
        "fact_invoices": ("invoice_date", "due_date"), "fact_payments": ("payment_date",),
        "fact_collection_activity": ("activity_date",), "fact_leakage": ("detection_date",),
        "fact_ar_aging": ("invoice_date",),
    }.items():
        for r in spark.read.parquet(f"{out}/star/{name}").select(*columns).collect():
            assert {d for d in r if d is not None} <= days
    assert min(days).strftime("%m-%d") == "01-01" and max(days).strftime("%m-%d") == "12-31"


def test_unreadable_cells_are_reported_and_left_alone(spark, tmp_path):
    raw = {k: v for k, v in RAW.items()}
    raw["invoices"] = raw["invoices"].replace("80,1\n", "80,True\n").replace("180,,0\n", "180,,False\n") + (
        "i3,m1,2026-02-01,2026-02-28,2026-03-02,31/03/2026,7,0,7,0.18,1.26,n/a,INR,Issued,Unpaid,7,7,False\n"
    )
    for name, text in raw.items():
        (tmp_path / f"{name}.csv").write_text(text)
    tables = read_raw_tables(spark, str(tmp_path))
    flags = {r.invoice_id: r.invoice_error_flag for r in tables["invoices"].collect()}
    assert flags == {"i1": 1, "i2": 0, "i3": 0}
    found = {
        (r.check_name, r.column_name): r.violations
        for r in quality.findings(tables, ["invoices"]).collect()
    }
    assert found["invalid_dates", "due_date"] == 1 and found["unreadable_values", "total_invoice_amount"] == 1
    assert found["missing_values", "due_date"] == 1  # the empty one of "i2"
    cleaned = {r.invoice_id: r for r in clean_all(tables)["invoices"].collect()}
    assert cleaned["i3"].due_date is None and cleaned["i2"].due_date == dt.date(2026, 3, 4)


def test_the_first_row_in_the_files_stays(spark, tmp_path):
    for name, text in RAW.items():
        (tmp_path / f"{name}.csv").write_text(text)
    head, *rows = RAW["payments"].splitlines()
    (tmp_path / "payments.csv").unlink()
    (tmp_path / "payments.csv").mkdir()
    again = rows[0].replace(",40,", ",39,")
    (tmp_path / "payments.csv" / "a.csv").write_text("\n".join([head, rows[0], rows[1]]) + "\n")
    (tmp_path / "payments.csv" / "b.csv").write_text("\n".join([head, again]) + "\n")
    cleaned = clean_all(read_raw_tables(spark, str(tmp_path)))["payments"].where("payment_id = 'p1'").collect()
    assert [float(r.payment_amount) for r in cleaned] == [40]
    assert cleaned[0].asDict().keys() >= {"payment_id"} and "_source_order" not in cleaned[0].asDict()
