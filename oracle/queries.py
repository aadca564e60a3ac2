"""Check queries: what each named result must equal, as DuckDB SQL.

Written from the definition of each result, not from the Spark code.  Ratios
are formed in DOUBLE from exact sums and rounded once.
"""

from __future__ import annotations

from oracle.model import with_model

AS_OF = "DATE '2001-08-13'"
WINDOW = f"BETWEEN {AS_OF} - 90 AND {AS_OF}"

ORACLES: dict[str, str] = {}


def pct(n: str, d: str, places: int = 2) -> str:
    return f"round(100::DOUBLE * ({n})::DOUBLE / nullif(({d})::DOUBLE, 0), {places})"


def div(n: str, d: str) -> str:
    return f"(({n})::DOUBLE / nullif(({d})::DOUBLE, 0))"


def ym(date: str) -> str:
    return f"strftime({date}, '%Y-%m')"


def add(name: str, sql: str) -> None:
    ORACLES[name] = with_model(sql)


# ---------------------------------------------------------------- shared parts

PAID = """paid AS (SELECT invoice_id, sum(payment_amount) AS paid, count(*) AS n,
  min(payment_date) AS first_day, max(payment_date) AS last_day
 FROM payments WHERE payment_status = 'Success' AND invoice_id IS NOT NULL GROUP BY invoice_id)"""
CREDITED = """credited AS (SELECT invoice_id, sum(credit_amount) AS credited FROM credit_notes
 WHERE status IN ('Issued', 'Applied') GROUP BY invoice_id)"""
LEDGER = f"""{PAID}, {CREDITED}, ledger AS (SELECT i.*, coalesce(p.paid, 0) AS paid,
  coalesce(p.n, 0) AS n_paid, coalesce(c.credited, 0) AS credited, p.first_day, p.last_day,
  i.total_invoice_amount - coalesce(p.paid, 0) - coalesce(c.credited, 0) AS open_amount,
  i.total_invoice_amount - coalesce(p.paid, 0) AS unpaid,
  date_diff('day', i.due_date, {AS_OF}) AS age
 FROM invoices i LEFT JOIN paid p USING (invoice_id) LEFT JOIN credited c USING (invoice_id))"""
MISSING_MONTHS = """txn_months AS (SELECT merchant_id,
  date_trunc('month', transaction_date)::DATE AS month, count(*) AS txns,
  sum(transaction_amount) AS gmv, sum(expected_platform_fee) AS fee
 FROM transactions WHERE payment_status = 'Success' GROUP BY 1, 2),
missing AS (SELECT * FROM txn_months t WHERE NOT EXISTS (SELECT 1 FROM invoices i
  WHERE i.merchant_id = t.merchant_id AND i.billing_period_start = t.month))"""
AGE_BUCKET = """CASE WHEN age > 90 THEN '90+ days' WHEN age > 60 THEN '61-90 days'
 WHEN age > 30 THEN '31-60 days' WHEN age > 0 THEN '1-30 days' ELSE 'Current' END"""
AGE_LABELS = """labels(pos, aging_bucket) AS (VALUES (0, 'Current'), (1, '1-30 days'),
 (2, '31-60 days'), (3, '61-90 days'), (4, '90+ days'))"""


def risk(amount: str, age: str) -> str:
    score = (
        f"((CASE WHEN {amount} > 8000 THEN 3 WHEN {amount} > 2000 THEN 2 WHEN {amount} > 500 THEN 1"
        f" ELSE 0 END) + (CASE WHEN {age} > 60 THEN 3 WHEN {age} > 30 THEN 2 WHEN {age} > 0 THEN 1"
        " ELSE 0 END))"
    )
    return (
        f"CASE WHEN {score} <= 1 THEN 'Low' WHEN {score} <= 3 THEN 'Medium'"
        f" WHEN {score} <= 5 THEN 'High' ELSE 'Critical' END"
    )


AGING = f"""{LEDGER}, aging AS (SELECT l.merchant_id, m.merchant_name, m.merchant_segment,
  l.invoice_id, l.invoice_date, l.due_date, l.total_invoice_amount, l.paid, l.credited,
  l.open_amount, l.age, {AGE_BUCKET} AS aging_bucket, {risk('l.open_amount', 'l.age')} AS risk
 FROM ledger l LEFT JOIN merchants m USING (merchant_id)
 WHERE l.invoice_status <> 'Void' AND l.open_amount > 0.01)"""

# ---------------------------------------------------------------- shared blocks

add("paid_by_invoice", f"""WITH {PAID}
SELECT invoice_id, paid::DOUBLE AS total_paid, n AS payment_count FROM paid""")
add("credited_by_invoice", f"""WITH {CREDITED}
SELECT invoice_id, credited::DOUBLE AS total_credited FROM credited""")
add("open_balance", f"""WITH {LEDGER}
SELECT invoice_id, merchant_id, total_invoice_amount::DOUBLE AS total_invoice_amount,
 paid::DOUBLE AS total_paid, credited::DOUBLE AS total_credited,
 open_amount::DOUBLE AS outstanding_amount FROM ledger WHERE invoice_status <> 'Void'""")
add("last_first_payment", f"""WITH {PAID}
SELECT invoice_id, first_day AS first_payment_date, last_day AS last_payment_date FROM paid""")
add("uninvoiced_months", f"""WITH {MISSING_MONTHS}
SELECT merchant_id, {ym('month')} AS month, txns AS transaction_count,
 gmv::DOUBLE AS gross_transaction_value, fee::DOUBLE AS expected_revenue FROM missing""")
add("bin_right_closed", """SELECT invoice_id, CASE WHEN billed_fee > 5000 THEN 'huge'
 WHEN billed_fee > 1000 THEN 'large' WHEN billed_fee > 100 THEN 'medium'
 WHEN billed_fee IS NOT NULL THEN 'small' END AS size_class FROM invoices""")

# ---------------------------------------------------------------- receivables

add("ar_aging", f"""WITH {AGING}
SELECT merchant_id, merchant_name, merchant_segment, invoice_id, invoice_date, due_date,
 total_invoice_amount::DOUBLE AS total_invoice_amount, paid::DOUBLE AS total_paid,
 credited::DOUBLE AS total_credited, open_amount::DOUBLE AS outstanding_amount,
 age AS days_overdue, aging_bucket, risk AS risk_category FROM aging""")
ORACLES["fact_ar_aging"] = ORACLES["ar_aging"]
add("aging_bucket", f"""WITH {LEDGER} SELECT invoice_id, {AGE_BUCKET} AS aging_bucket FROM ledger""")
add("ar_risk", f"""WITH {LEDGER}
SELECT invoice_id, {risk('total_invoice_amount', 'age')} AS risk_category FROM ledger""")
add("aging_summary", f"""WITH {AGING}, {AGE_LABELS},
s AS (SELECT aging_bucket, count(*) AS n, sum(open_amount) AS amount FROM aging GROUP BY 1)
SELECT aging_bucket, n AS invoice_count, amount::DOUBLE AS total_outstanding,
 {pct('amount', '(SELECT sum(open_amount) FROM aging)')} AS percent_of_total_ar
FROM labels LEFT JOIN s USING (aging_bucket)""")
add("ar_cumulative", f"""WITH {AGING}
SELECT coalesce(sum(open_amount) FILTER (age <= 0), 0)::DOUBLE AS current_ar,
 coalesce(sum(open_amount) FILTER (age > 0), 0)::DOUBLE AS overdue_ar,
 coalesce(sum(open_amount) FILTER (age > 30), 0)::DOUBLE AS ar_30_plus,
 coalesce(sum(open_amount) FILTER (age > 60), 0)::DOUBLE AS ar_60_plus,
 coalesce(sum(open_amount) FILTER (age > 90), 0)::DOUBLE AS ar_90_plus,
 coalesce(sum(open_amount), 0)::DOUBLE AS total_ar FROM aging""")
DSO_OVERALL = f"""SELECT ar::DOUBLE AS total_ar, sales::DOUBLE AS trailing_credit_sales,
 round({div('ar', 'sales')} * 90::DOUBLE, 1) AS dso_days FROM
 (SELECT coalesce(sum(open_amount), 0) AS ar FROM ledger
  WHERE invoice_status <> 'Void' AND invoice_date <= {AS_OF}),
 (SELECT coalesce(sum(billed_fee), 0) AS sales FROM invoices WHERE invoice_date {WINDOW})"""
add("dso_overall", f"WITH {LEDGER} {DSO_OVERALL}")
add("dso_monthly", f"""WITH {LEDGER}, m AS (SELECT date_trunc('month', invoice_date)::DATE AS d,
  sum(billed_fee) AS sales, sum(open_amount) AS ar FROM ledger
 WHERE invoice_status <> 'Void' GROUP BY 1)
SELECT {ym('d')} AS month, sales::DOUBLE AS credit_sales, ar::DOUBLE AS month_end_ar,
 round({div('ar', 'sales')} * day(last_day(d))::DOUBLE, 1) AS dso_days FROM m""")
ORACLES["m_dso_trend"] = ORACLES["dso_monthly"]
for group in ("merchant_id", "merchant_segment"):
    add("dso_by_" + group.removeprefix("merchant_").replace("id", "merchant"), f"""WITH {LEDGER},
g AS (SELECT m.{group}, sum(open_amount) AS ar,
  coalesce(sum(billed_fee) FILTER (invoice_date {WINDOW}), 0) AS sales
 FROM ledger l JOIN merchants m ON m.merchant_id = l.merchant_id
 WHERE l.invoice_status <> 'Void' GROUP BY 1)
SELECT {group}, ar::DOUBLE AS total_ar, sales::DOUBLE AS trailing_credit_sales,
 round({div('ar', 'sales')} * 90::DOUBLE, 1) AS dso_days FROM g""")

# ---------------------------------------------------------------- billing

BILLING = f"""{MISSING_MONTHS}, near AS (SELECT i.invoice_id,
  coalesce(date_diff('day', k.effective_from, i.billing_period_start) <= 45, false) AS is_near
 FROM invoices i ASOF LEFT JOIN contracts k
  ON k.merchant_id = i.merchant_id AND k.effective_from <= i.billing_period_start),
classified AS (SELECT i.*, n.is_near, i.billed_fee - i.expected_fee AS diff,
  CASE WHEN abs(i.billed_fee - i.expected_fee) > 0.01 THEN
    CASE WHEN n.is_near THEN 'Pricing Mismatch' WHEN i.billed_fee < i.expected_fee
     THEN 'Underbilled' ELSE 'Overbilled' END ELSE 'Correct' END AS billing_status
 FROM invoices i JOIN near n USING (invoice_id)),
billing AS (SELECT merchant_id, {ym('billing_period_start')} AS billing_period, invoice_id,
  expected_fee AS expected, billed_fee AS billed, diff,
  {pct('diff', 'expected_fee')} AS variance_percent, billing_status FROM classified
 UNION ALL SELECT merchant_id, {ym('month')}, NULL, fee::DECIMAL(18,2), 0, -fee::DECIMAL(18,2),
  -100::DOUBLE, 'Missing Invoice' FROM missing)"""
add("near_contract_transition", f"""WITH {BILLING}
SELECT invoice_id, merchant_id, billing_period_start FROM classified WHERE is_near""")
add("billing_status", f"""WITH {BILLING}
SELECT invoice_id, merchant_id, diff::DOUBLE AS revenue_difference,
 {pct('diff', 'expected_fee')} AS variance_percent, billing_status FROM classified""")
add("billing_missing_months", f"""WITH {MISSING_MONTHS}
SELECT merchant_id, month AS billing_period_start, gmv::DOUBLE AS gross_transaction_value,
 fee::DOUBLE AS expected_revenue FROM missing""")
add("billing_merchant_month", f"""WITH {BILLING}
SELECT merchant_id, billing_period, invoice_id, expected::DOUBLE AS expected_revenue,
 billed::DOUBLE AS actual_billed_revenue, diff::DOUBLE AS revenue_difference, variance_percent,
 billing_status FROM billing""")
add("billing_status_summary", f"""WITH {BILLING}
SELECT billing_status, count(*) AS merchant_months, (CASE
 WHEN billing_status IN ('Underbilled', 'Pricing Mismatch') THEN -sum(diff) ELSE 0 END)::DOUBLE
 AS leakage_amount FROM billing GROUP BY billing_status""")
add("billing_errors_by_segment", f"""WITH {BILLING}
SELECT merchant_segment, count(*) FILTER (billing_status = 'Missing Invoice') AS missing_invoice,
 count(*) FILTER (billing_status = 'Overbilled') AS overbilled,
 count(*) FILTER (billing_status = 'Pricing Mismatch') AS pricing_mismatch,
 count(*) FILTER (billing_status = 'Underbilled') AS underbilled
FROM billing JOIN merchants USING (merchant_id) WHERE billing_status <> 'Correct' GROUP BY 1""")
add("billing_accuracy_count", f"""WITH {BILLING}, s AS (SELECT count(*) AS n,
 count(*) FILTER (billing_status = 'Correct') AS ok FROM billing)
SELECT ok AS correct_count, n AS merchant_months, {pct('ok', 'n')} AS billing_accuracy_percent
FROM s""")
add("billing_repeat_offenders", f"""WITH {BILLING}
SELECT merchant_id, count(*) AS error_count FROM billing WHERE billing_status <> 'Correct'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")

# ---------------------------------------------------------------- realization

REALIZATION_COLUMNS = f"""gmv::DOUBLE AS gross_transaction_value, fee::DOUBLE AS expected_revenue,
 billed::DOUBLE AS billed_revenue, cash::DOUBLE AS collected_revenue,
 credit::DOUBLE AS credited_amount, (billed - cash - credit)::DOUBLE AS outstanding_revenue,
 {pct('cash', 'billed')} AS realization_rate_percent,
 {pct('exact', 'inv_expected')} AS billing_accuracy_percent"""


def realization(key: str, txn_key: str, inv_key: str) -> str:
    return f"""WITH t AS (SELECT {txn_key} AS key, sum(transaction_amount) AS gmv,
  sum(expected_platform_fee) AS fee FROM transactions WHERE payment_status = 'Success' GROUP BY 1),
i AS (SELECT {inv_key} AS key, sum(expected_fee) AS inv_expected, sum(billed_fee) AS billed,
  coalesce(sum(expected_fee) FILTER (abs(billed_fee - expected_fee) <= 0.01), 0) AS exact
 FROM invoices GROUP BY 1),
p AS (SELECT {inv_key.replace('merchant_id', 'x.merchant_id')} AS key, sum(payment_amount) AS cash
 FROM payments y JOIN invoices x USING (invoice_id) WHERE y.payment_status = 'Success' GROUP BY 1),
c AS (SELECT {inv_key.replace('merchant_id', 'x.merchant_id')} AS key, sum(credit_amount) AS credit
 FROM credit_notes y JOIN invoices x USING (invoice_id)
 WHERE y.status IN ('Issued', 'Applied') GROUP BY 1),
r AS (SELECT key, coalesce(gmv, 0) AS gmv, coalesce(fee, 0) AS fee, coalesce(billed, 0) AS billed,
  coalesce(cash, 0) AS cash, coalesce(credit, 0) AS credit, exact, inv_expected
 FROM t FULL JOIN i USING (key) FULL JOIN p USING (key) FULL JOIN c USING (key))
SELECT key AS {key}, {REALIZATION_COLUMNS} FROM r"""


add("realization_month", realization(
    "billing_period", ym("transaction_date"), ym("billing_period_start")))
add("realization_merchant", realization("merchant_id", "merchant_id", "merchant_id"))
OVERALL = """r AS (SELECT * FROM
 (SELECT sum(transaction_amount) AS gmv, sum(expected_platform_fee) AS fee FROM transactions
  WHERE payment_status = 'Success'),
 (SELECT sum(expected_fee) AS inv_expected, sum(billed_fee) AS billed,
   sum(expected_fee) FILTER (abs(billed_fee - expected_fee) <= 0.01) AS exact FROM invoices),
 (SELECT sum(payment_amount) AS cash FROM payments WHERE payment_status = 'Success'),
 (SELECT sum(credit_amount) AS credit FROM credit_notes WHERE status IN ('Issued', 'Applied')))"""
add("realization_overall", f"WITH {OVERALL} SELECT 'total' AS total, {REALIZATION_COLUMNS} FROM r")
add("realization_grains", " UNION ALL ".join((
    "SELECT 'month' AS grain, billing_period, NULL::BIGINT AS merchant_id, * EXCLUDE (billing_period) FROM ("
    + realization("billing_period", ym("transaction_date"), ym("billing_period_start")) + ")",
    "SELECT 'merchant', NULL, merchant_id, * EXCLUDE (merchant_id) FROM ("
    + realization("merchant_id", "merchant_id", "merchant_id") + ")",
    f"SELECT 'overall', NULL, NULL, * FROM (WITH {OVERALL} SELECT {REALIZATION_COLUMNS} FROM r)",
)))
add("m_funnel", f"""WITH {OVERALL}
SELECT 1::BIGINT AS step, 'Gross Transaction Value' AS stage, gmv::DOUBLE AS amount FROM r
UNION ALL SELECT 2, 'Expected Revenue', fee::DOUBLE FROM r
UNION ALL SELECT 3, 'Billed Revenue', billed::DOUBLE FROM r
UNION ALL SELECT 4, 'Collected Revenue', cash::DOUBLE FROM r""")

# ---------------------------------------------------------------- reconciliation

RECON = f"""flags AS (SELECT *,
  count(*) OVER (PARTITION BY invoice_id, payment_amount, payment_status) > 1 AS again,
  coalesce(settlement_date < payment_date, false) AS early FROM payments),
recon_payments AS (SELECT f.payment_id, f.invoice_id, f.merchant_id, f.payment_date,
  f.payment_amount, f.payment_status,
  CASE WHEN f.payment_status <> 'Success' THEN 'NOT_APPLICABLE_' || upper(f.payment_status)
   WHEN f.invoice_id IS NULL THEN 'ORPHAN'
   WHEN f.invoice_id NOT IN (SELECT invoice_id FROM invoices) THEN 'UNMATCHED'
   WHEN again THEN 'DUPLICATE' WHEN early THEN 'TIMING_MISMATCH' ELSE 'MATCHED' END AS status
 FROM flags f),
per_invoice AS (SELECT invoice_id, sum(payment_amount) AS paid, count(*) AS n,
  bool_or(again) AS again, bool_or(early) AS early FROM flags
 WHERE payment_status = 'Success' AND invoice_id IS NOT NULL GROUP BY 1),
recon_invoices AS (SELECT i.invoice_id, i.merchant_id, i.total_invoice_amount,
  coalesce(p.paid, 0) AS paid, coalesce(p.n, 0) AS n,
  coalesce(p.paid, 0) - i.total_invoice_amount AS variance,
  CASE WHEN i.invoice_status = 'Void' THEN 'VOID' WHEN p.n IS NULL THEN 'MISSING_PAYMENT'
   WHEN p.again THEN 'DUPLICATE' WHEN p.paid - i.total_invoice_amount > 1 THEN 'AMOUNT_MISMATCH'
   WHEN p.early THEN 'TIMING_MISMATCH' WHEN i.total_invoice_amount - p.paid > 1 THEN 'PARTIAL'
   ELSE 'MATCHED' END AS status
 FROM invoices i LEFT JOIN per_invoice p USING (invoice_id))"""
add("recon_payments", f"""WITH {RECON}
SELECT payment_id, invoice_id, merchant_id, payment_date, payment_amount::DOUBLE AS payment_amount,
 payment_status, status AS reconciliation_status FROM recon_payments""")
ORACLES["fact_payments"] = ORACLES["recon_payments"]
add("recon_invoices", f"""WITH {RECON}
SELECT invoice_id, merchant_id, total_invoice_amount::DOUBLE AS total_invoice_amount,
 paid::DOUBLE AS total_paid, n AS payment_count, variance::DOUBLE AS variance,
 status AS reconciliation_status FROM recon_invoices""")
ORACLES["write_csv"] = ORACLES["recon_invoices"]
add("recon_missing_invoices", f"""WITH {MISSING_MONTHS}
SELECT merchant_id, {ym('month')} AS billing_period, txns AS transaction_count,
 gmv::DOUBLE AS gross_transaction_value, 'MISSING_INVOICE' AS reconciliation_status FROM missing""")
add("recon_summary", f"""WITH {RECON}, {MISSING_MONTHS}, s AS (SELECT status, count(*) AS n
 FROM (SELECT status FROM recon_invoices UNION ALL SELECT 'MISSING_INVOICE' FROM missing)
 GROUP BY 1), t AS (SELECT sum(n) AS total, coalesce(sum(n) FILTER (status = 'MATCHED'), 0) AS ok
 FROM s)
SELECT status AS reconciliation_status, n AS count, {pct('n', 'total')} AS percent_of_total,
 {pct('ok', 'total')} AS reconciliation_rate_percent FROM s, t""")
add("m_recon_status_counts", f"""WITH {RECON}
SELECT status AS reconciliation_status, count(*) AS payment_count,
 sum(payment_amount)::DOUBLE AS payment_amount FROM recon_payments GROUP BY 1""")
add("m_mismatch_types", f"""WITH {RECON}
SELECT status AS reconciliation_status, count(*) AS item_count FROM (
 SELECT status FROM recon_payments WHERE status IN ('DUPLICATE', 'TIMING_MISMATCH', 'ORPHAN',
  'UNMATCHED') UNION ALL SELECT status FROM recon_invoices WHERE status = 'AMOUNT_MISMATCH')
GROUP BY 1""")
add("m_top_control_failures", f"""WITH {RECON}
SELECT payment_id, invoice_id, merchant_id, payment_amount::DOUBLE AS payment_amount,
 status AS reconciliation_status FROM recon_payments r
WHERE status IN ('UNMATCHED', 'DUPLICATE')""")

# ---------------------------------------------------------------- leakage

LEAKAGE = f"""{BILLING}, best AS (SELECT invoice_id, CASE WHEN bool_or(status = 'Applied')
  THEN 'Recovered' ELSE 'Recoverable' END AS recovery FROM credit_notes
 WHERE status IN ('Applied', 'Issued', 'Pending') GROUP BY 1),
refund_fee AS (SELECT merchant_id, {ym('transaction_date')} AS billing_period,
  sum(round(refund_amount::DOUBLE * (expected_platform_fee::DOUBLE
   / nullif(transaction_amount::DOUBLE, 0)), 2)::DECIMAL(18,2)) AS fee
 FROM transactions WHERE refund_amount > 0 AND payment_status = 'Success' GROUP BY 1, 2),
refund_review AS (SELECT r.merchant_id, i.invoice_id, r.billing_period, r.fee,
  coalesce((SELECT sum(credit_amount) FROM credit_notes c WHERE c.invoice_id = i.invoice_id), 0)
   AS credited
 FROM refund_fee r LEFT JOIN invoices i ON i.merchant_id = r.merchant_id
  AND {ym('i.billing_period_start')} = r.billing_period),
found AS (
 SELECT 1 AS pos, b.merchant_id, NULL::BIGINT AS transaction_id, b.invoice_id, b.billing_period,
  'Underbilling' AS leakage_type, b.expected, b.billed AS actual, -b.diff AS amount,
  coalesce(s.recovery, 'Outstanding') AS status
 FROM billing b LEFT JOIN best s USING (invoice_id) WHERE b.billing_status = 'Underbilled'
 UNION ALL SELECT 2, b.merchant_id, NULL, b.invoice_id, b.billing_period, 'Pricing Mismatch',
  b.expected, b.billed, -b.diff, coalesce(s.recovery, 'Outstanding')
 FROM billing b LEFT JOIN best s USING (invoice_id)
 WHERE b.billing_status = 'Pricing Mismatch' AND b.diff < 0
 UNION ALL SELECT 3, merchant_id, NULL, NULL, billing_period, 'Missing Invoice', expected, 0,
  expected, 'Outstanding' FROM billing WHERE billing_status = 'Missing Invoice'
 UNION ALL SELECT 4, merchant_id, NULL, invoice_id, billing_period,
  'Refund Fee Retention (Policy Review)', 0, fee, fee - credited, 'Under Review'
 FROM refund_review WHERE credited < fee * 0.5 AND fee - credited > 1
 UNION ALL SELECT 5, merchant_id, transaction_id, NULL, {ym('transaction_date')},
  'Rate Discrepancy', expected_platform_fee, charged, abs(expected_platform_fee - charged),
  'Recovered'
 FROM (SELECT *, (transaction_amount * transaction_fee_percent * 0.01)::DECIMAL(18,2) AS charged
  FROM transactions WHERE payment_status = 'Success')
 WHERE abs(transaction_fee_percent::DOUBLE - 100::DOUBLE * expected_platform_fee::DOUBLE
  / nullif(transaction_amount::DOUBLE, 0)) > 0.05::DOUBLE
 UNION ALL SELECT 6, merchant_id, NULL, invoice_id, NULL, 'Failed Payment', total_invoice_amount,
  0, total_invoice_amount, 'Outstanding' FROM invoices
 WHERE invoice_status <> 'Void' AND due_date < {AS_OF}
  AND invoice_id IN (SELECT invoice_id FROM payments WHERE payment_status = 'Failed'
   AND invoice_id IS NOT NULL)
  AND invoice_id NOT IN (SELECT invoice_id FROM payments WHERE payment_status = 'Success'
   AND invoice_id IS NOT NULL)),
events AS (SELECT *, CASE WHEN amount > 2000 THEN 'Critical' WHEN amount > 500 THEN 'High'
  WHEN amount > 100 THEN 'Medium' WHEN amount IS NOT NULL THEN 'Low' END AS severity FROM found),
realized AS (SELECT * FROM events WHERE pos NOT IN (4, 5))"""
EVENT_COLUMNS = """merchant_id, transaction_id, invoice_id, billing_period, leakage_type,
 expected::DOUBLE AS expected_amount, actual::DOUBLE AS actual_amount,
 amount::DOUBLE AS leakage_amount, severity, status"""
for name, positions in {
    "leakage_billing": "1, 2", "leakage_missing_invoice": "3", "leakage_refund_fee": "4",
    "leakage_rate_discrepancy": "5", "leakage_failed_payment": "6",
}.items():
    add(name, f"WITH {LEAKAGE} SELECT {EVENT_COLUMNS} FROM events WHERE pos IN ({positions})")
add("leakage_severity", f"""WITH {LEAKAGE}
SELECT leakage_type, merchant_id, invoice_id, transaction_id, amount::DOUBLE AS leakage_amount,
 severity FROM events""")
add("credit_recovery_status", f"""WITH {LEAKAGE}
SELECT i.invoice_id, i.merchant_id, coalesce(b.recovery, 'Outstanding') AS status
FROM invoices i LEFT JOIN best b USING (invoice_id)""")
add("leakage_table", f"""WITH {LEAKAGE}
SELECT printf('LKG%07d', row_number() OVER (ORDER BY pos, merchant_id NULLS FIRST,
  billing_period NULLS FIRST, invoice_id NULLS FIRST, transaction_id NULLS FIRST)) AS leakage_id,
 merchant_id, transaction_id, invoice_id, leakage_type, expected::DOUBLE AS expected_amount,
 actual::DOUBLE AS actual_amount, amount::DOUBLE AS leakage_amount, {AS_OF} AS detection_date,
 severity, status FROM events""")
ORACLES["fact_leakage"] = ORACLES["leakage_table"]
for column in ("leakage_type", "status", "severity"):
    add(f"leakage_by_{column.removeprefix('leakage_')}", f"""WITH {LEAKAGE}
SELECT {column}, count(amount) AS leakage_count, sum(amount)::DOUBLE AS leakage_amount
FROM realized WHERE {column} IS NOT NULL GROUP BY 1""")
add("leakage_totals", f"""WITH {LEAKAGE}
SELECT sum(amount)::DOUBLE AS total_leakage,
 coalesce(sum(amount) FILTER (status = 'Recovered'), 0)::DOUBLE AS recovered,
 coalesce(sum(amount) FILTER (status = 'Recoverable'), 0)::DOUBLE AS recoverable,
 coalesce(sum(amount) FILTER (status = 'Outstanding'), 0)::DOUBLE AS outstanding FROM realized""")
add("leakage_advisory_totals", f"""WITH {LEAKAGE}
SELECT leakage_type AS advisory_item, count(*) AS item_count, sum(amount)::DOUBLE AS notional_amount
FROM events WHERE pos IN (4, 5) GROUP BY 1
UNION ALL SELECT 'Overbilled Pricing Mismatch', count(*), sum(diff)::DOUBLE FROM billing
WHERE billing_status = 'Pricing Mismatch' AND diff > 0 HAVING count(*) > 0""")
add("leakage_top_merchants", f"""WITH {LEAKAGE}, t AS (SELECT merchant_id, sum(amount) AS a
 FROM realized GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT merchant_id, a::DOUBLE AS leakage_amount FROM t""")
add("leakage_severity_counts", f"""WITH {LEAKAGE}, l(severity) AS (VALUES ('Low'), ('Medium'),
 ('High'), ('Critical')), s AS (SELECT severity, count(*) AS n FROM realized GROUP BY 1)
SELECT severity, n AS leakage_count FROM l LEFT JOIN s USING (severity)""")
add("leakage_status_ordered", f"""WITH {LEAKAGE}, l(status) AS (VALUES ('Recovered'),
 ('Recoverable'), ('Outstanding')), s AS (SELECT status, sum(amount) AS a FROM realized GROUP BY 1)
SELECT status, a::DOUBLE AS leakage_amount FROM l LEFT JOIN s USING (status)""")
add("m_leakage_by_type", f"""WITH {LEAKAGE}
SELECT leakage_type, sum(amount)::DOUBLE AS leakage_amount FROM events GROUP BY 1""")
add("m_leakage_top15", f"""WITH {LEAKAGE}, t AS (SELECT merchant_id, merchant_name, sum(amount) AS a
 FROM realized JOIN merchants USING (merchant_id) GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 15)
SELECT merchant_id, merchant_name, a::DOUBLE AS leakage_amount FROM t""")
add("m_leakage_trend", f"""WITH {LEAKAGE}
SELECT {ym(AS_OF)} AS year_month, count(*) AS leakage_count, sum(amount)::DOUBLE AS leakage_amount
FROM realized""")

# ---------------------------------------------------------------- collections

COLLECTION_RATE = f"""SELECT {AS_OF} - 90 AS period_start, {AS_OF} AS period_end,
 b::DOUBLE AS billed_revenue, k::DOUBLE AS collected_revenue,
 {pct('k', 'b')} AS collection_rate_percent FROM
 (SELECT coalesce(sum(total_invoice_amount), 0) AS b FROM invoices
  WHERE invoice_status <> 'Void' AND invoice_date {WINDOW}),
 (SELECT coalesce(sum(payment_amount), 0) AS k FROM payments
  WHERE payment_status = 'Success' AND payment_date {WINDOW})"""
RECOVERY = f"""SELECT n AS invoices_chased, owed::DOUBLE AS amount_owed_at_contact,
 got::DOUBLE AS amount_recovered, {pct('got', 'owed')} AS recovery_rate_percent FROM
 (SELECT count(*) AS n, sum(total_invoice_amount) AS owed,
   sum(least(paid, total_invoice_amount)) AS got FROM ledger
  WHERE invoice_status <> 'Void' AND invoice_id IN (SELECT invoice_id FROM collection_activity))"""
COLLECTION_TIME = f"""SELECT count(*) AS paid_invoices_measured,
 round({div('sum(d)', 'count(d)')}, 1) AS avg_collection_days,
 round(median(d), 1) AS median_collection_days FROM
 (SELECT date_diff('day', due_date, last_day) AS d FROM ledger
  WHERE invoice_status <> 'Void' AND payment_status = 'Paid' AND n_paid > 0)"""
PROMISE = f"""SELECT total AS total_collection_activities, made AS promises_made,
 {pct('said', 'total')} AS promise_to_pay_rate_percent, kept AS promises_fulfilled,
 {pct('kept', 'made')} AS promise_fulfillment_rate_percent FROM
 (SELECT count(*) AS total, count(*) FILTER (outcome = 'Promise to Pay') AS said,
   count(*) FILTER (outcome = 'Promise to Pay' AND invoice_id IS NOT NULL
    AND promised_payment_date IS NOT NULL) AS made,
   count(*) FILTER (outcome = 'Promise to Pay' AND EXISTS (SELECT 1 FROM payments p
    WHERE p.payment_status = 'Success' AND p.invoice_id = a.invoice_id
     AND p.payment_date <= a.promised_payment_date)) AS kept FROM collection_activity a)"""
add("collection_rate", COLLECTION_RATE.replace(f"{AS_OF} - 90 AS", f"({AS_OF} - 90)::DATE AS"))
add("recovery_rate", f"WITH {LEDGER} {RECOVERY}")
add("avg_collection_time", f"WITH {LEDGER} {COLLECTION_TIME}")
add("promise_to_pay", PROMISE)
SUMMARY = {
    "collection_rate": (
        COLLECTION_RATE.replace(f"{AS_OF} - 90 AS", f"({AS_OF} - 90)::DATE AS"),
        ["period_start", "period_end", "billed_revenue", "collected_revenue",
         "collection_rate_percent"]),
    "recovery_rate": (RECOVERY, ["invoices_chased", "amount_owed_at_contact", "amount_recovered",
                                 "recovery_rate_percent"]),
    "average_collection_time": (COLLECTION_TIME, [
        "paid_invoices_measured", "avg_collection_days", "median_collection_days"]),
    "promise_to_pay": (PROMISE, [
        "total_collection_activities", "promises_made", "promise_to_pay_rate_percent",
        "promises_fulfilled", "promise_fulfillment_rate_percent"]),
    "dso_overall": (DSO_OVERALL, ["total_ar", "trailing_credit_sales", "dso_days"]),
}
add("collections_summary", f"WITH {LEDGER} SELECT " + ", ".join(
    f"{g}.{c} AS {g}_{c}" for g, (_, columns) in SUMMARY.items() for c in columns
) + " FROM " + ", ".join(f"({sql}) AS {g}" for g, (sql, _) in SUMMARY.items()))
add("write_json_summary", f"""WITH {LEDGER}
SELECT d.total_ar, d.dso_days, c.collection_rate_percent, r.invoices_chased, p.promises_fulfilled
FROM ({DSO_OVERALL}) d, ({COLLECTION_RATE}) c, ({RECOVERY}) r, ({PROMISE}) p""")


def effectiveness(key: str, source: str, where: str, total: str = "count(outcome)") -> str:
    return f"""WITH s AS (SELECT {key}, {total} AS n,
 count(*) FILTER (outcome = 'Payment Received') AS r FROM {source} WHERE {where} GROUP BY ALL)
SELECT {key}, n AS total_activities, r AS payments_received,
 {pct('r', 'n')} AS success_rate_percent FROM s"""


WITH_SEGMENT = "collection_activity JOIN merchants USING (merchant_id)"
add("channel_effectiveness", effectiveness(
    "contact_channel", "collection_activity", "contact_channel IS NOT NULL"))
add("xl_channel_effectiveness", effectiveness(
    "contact_channel", "collection_activity", "contact_channel IS NOT NULL", "count(*)"))
add("segment_effectiveness", effectiveness("merchant_segment", WITH_SEGMENT, "true"))
add("m_success_by_channel_segment", effectiveness(
    "contact_channel, merchant_segment", WITH_SEGMENT, "contact_channel IS NOT NULL"))

BEHAVIOR = f"""{LEDGER}, delays AS (SELECT *, CASE WHEN payment_status = 'Paid'
  THEN date_diff('day', due_date, last_day) END AS delay FROM ledger
 WHERE invoice_status <> 'Void'),
per_merchant AS (SELECT merchant_id, count(*) AS n, sum(total_invoice_amount) AS invoiced,
  sum(greatest(open_amount, 0)) AS open_sum, sum(delay) AS delay_sum, count(delay) AS delay_n,
  median(delay) AS delay_median, max(delay) AS delay_max,
  {pct("count(*) FILTER (delay <= 0)", "count(*) FILTER (payment_status = 'Paid')")} AS on_time,
  count(*) FILTER (payment_status <> 'Paid' AND due_date < {AS_OF}) AS overdue
 FROM delays GROUP BY 1),
behavior AS (SELECT p.*, m.merchant_name, m.merchant_segment, {div('delay_sum', 'delay_n')} AS mean,
  CASE WHEN delay_n = 0 THEN 'Insufficient Data' WHEN delay_sum <= 0 THEN 'Excellent'
   WHEN delay_sum <= 15 * delay_n AND on_time >= 50 THEN 'Good'
   WHEN delay_sum <= 30 * delay_n THEN 'Moderate' ELSE 'High-risk' END AS payer
 FROM per_merchant p LEFT JOIN merchants m USING (merchant_id))"""
add("payment_behavior", f"""WITH {BEHAVIOR}
SELECT merchant_id, merchant_name, merchant_segment, n AS total_invoice_count,
 round({div('invoiced', 'n')}, 2) AS avg_invoice_value, open_sum::DOUBLE AS outstanding_balance,
 round(mean, 1) AS avg_payment_delay_days, round(delay_median, 1) AS median_payment_delay_days,
 delay_max AS max_payment_delay_days, on_time AS on_time_percent,
 round(100::DOUBLE - on_time, 2) AS late_percent, overdue AS overdue_invoice_count,
 {pct('n - overdue', 'n')} AS collection_success_rate_percent, payer AS payer_segment
FROM behavior""")
add("payer_segment", f"WITH {BEHAVIOR} SELECT merchant_id, payer AS payer_segment FROM behavior")
add("payer_segment_summary", f"""WITH {BEHAVIOR}, r AS (SELECT *,
 round(mean, 1)::DECIMAL(18,1) AS shown FROM behavior)
SELECT payer AS payer_segment, count(*) AS merchant_count, sum(open_sum)::DOUBLE AS total_outstanding,
 round({div('sum(shown)', 'count(shown)')}, 1) AS avg_delay_days FROM r GROUP BY 1""")
add("payer_segment_counts", f"""WITH {BEHAVIOR}
SELECT payer AS payer_segment, count(*) AS merchant_count FROM behavior GROUP BY 1""")
QUEUE = f"""{BEHAVIOR}, late AS (SELECT l.invoice_id, l.merchant_id, m.merchant_name,
  m.merchant_segment, l.open_amount, l.age, {AGE_BUCKET} AS aging_bucket,
  coalesce(b.payer, 'Insufficient Data') AS payer, m.merchant_status
 FROM ledger l LEFT JOIN merchants m ON m.merchant_id = l.merchant_id
 LEFT JOIN behavior b ON b.merchant_id = l.merchant_id
 WHERE l.invoice_status <> 'Void' AND l.open_amount > 0.01 AND l.age > 0),
scored AS (SELECT *, round(
  0.40::DOUBLE * least(100::DOUBLE, 100::DOUBLE * open_amount::DOUBLE
   / (SELECT max(open_amount)::DOUBLE FROM late))
  + 0.30::DOUBLE * least(100::DOUBLE, 100::DOUBLE * age::DOUBLE / 120::DOUBLE)
  + 0.20::DOUBLE * (CASE payer WHEN 'Excellent' THEN 0 WHEN 'Good' THEN 30 WHEN 'Moderate' THEN 60
   WHEN 'High-risk' THEN 100 ELSE 50 END)::DOUBLE
  + 0.10::DOUBLE * (CASE merchant_status WHEN 'Active' THEN 20 WHEN 'Suspended' THEN 80
   WHEN 'Churned' THEN 100 ELSE 50 END)::DOUBLE, 1) AS score FROM late),
queue AS (SELECT row_number() OVER (ORDER BY score DESC, open_amount DESC, invoice_id) AS pos, *,
  CASE WHEN score < 30 THEN 'Low' WHEN score < 55 THEN 'Medium' WHEN score < 75 THEN 'High'
   ELSE 'Critical' END AS tier FROM scored)"""
TIER_ACTION = """CASE tier WHEN 'Critical' THEN
 'Immediate escalation - account manager + finance lead call'
 WHEN 'High' THEN 'Phone + email follow-up within 48 hours'
 WHEN 'Medium' THEN 'Standard reminder sequence (email, then phone)'
 ELSE 'Automated reminder only' END"""
add("collection_queue", f"""WITH {QUEUE}
SELECT pos AS priority_rank, merchant_id, merchant_name, merchant_segment, invoice_id,
 open_amount::DOUBLE AS outstanding_amount, age AS days_overdue, aging_bucket,
 payer AS payer_segment, score AS priority_score, tier AS priority_tier,
 {TIER_ACTION} AS recommended_action FROM queue""")
add("m_queue", f"""WITH {QUEUE}
SELECT pos AS priority_rank, merchant_name, open_amount::DOUBLE AS outstanding_amount,
 age AS days_overdue, tier AS priority_tier FROM queue""")
add("priority_tier", f"""WITH {QUEUE}
SELECT tier AS priority_tier, {TIER_ACTION} AS recommended_action, count(*) AS invoice_count
FROM queue GROUP BY ALL""")
