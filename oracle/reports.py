"""Check queries for the analyst questions, star schema, measures, worksheets and derivations."""

from __future__ import annotations

from oracle.queries import (
    AGING, AS_OF, BILLING, LEAKAGE, LEDGER, MISSING_MONTHS, ORACLES, PAID, RECON, WINDOW, add, div,
    pct, ym,
)

# ---------------------------------------------------------------- analyst questions

add("sql_01", f"""SELECT {ym('invoice_date')} AS billing_month, count(*) AS invoice_count,
 sum(billed_fee)::DOUBLE AS billed_revenue, sum(expected_fee)::DOUBLE AS expected_revenue
FROM invoices GROUP BY 1""")
add("sql_02", f"""WITH m AS (SELECT {ym('invoice_date')} AS month, sum(billed_fee) AS r
 FROM invoices GROUP BY 1),
p AS (SELECT a.month, a.r, (SELECT b.r FROM m b WHERE b.month < a.month ORDER BY b.month DESC LIMIT 1)
  AS before FROM m a)
SELECT month AS billing_month, r::DOUBLE AS revenue, before::DOUBLE AS prior_month_revenue,
 {pct('r - before', 'before')} AS growth_percent FROM p""")
add("sql_03", """WITH t AS (SELECT merchant_id, sum(billed_fee) AS r, count(*) AS n FROM invoices
 GROUP BY 1)
SELECT merchant_id, merchant_name, merchant_segment, r::DOUBLE AS total_billed_revenue,
 n AS invoice_count FROM t JOIN merchants USING (merchant_id) ORDER BY r DESC, merchant_id LIMIT 20""")
add("sql_04", f"""WITH {LEDGER}
SELECT invoice_id, merchant_id, total_invoice_amount::DOUBLE AS total_invoice_amount,
 paid::DOUBLE AS total_paid, credited::DOUBLE AS total_credited,
 open_amount::DOUBLE AS outstanding_amount FROM ledger
WHERE invoice_status <> 'Void' AND open_amount > 0.01""")
UNPAID = f"""{LEDGER}, unpaid_invoices AS (SELECT * FROM ledger
 WHERE invoice_status <> 'Void' AND unpaid > 0.01)"""
add("sql_05", f"""WITH {UNPAID}, edges(aging_bucket, lo, hi) AS (VALUES ('Current', -100000, 0),
 ('1-30 days', 1, 30), ('31-60 days', 31, 60), ('61-90 days', 61, 90), ('90+ days', 91, 1000000))
SELECT aging_bucket, count(*) AS invoice_count, sum(unpaid)::DOUBLE AS total_outstanding
FROM unpaid_invoices JOIN edges ON age BETWEEN lo AND hi GROUP BY 1""")
add("sql_06", f"""WITH {LEDGER}, t AS (SELECT sum(unpaid) FILTER (invoice_status <> 'Void') AS ar,
 sum(billed_fee) FILTER (invoice_date {WINDOW}) AS sales FROM ledger)
SELECT ar::DOUBLE AS total_ar, sales::DOUBLE AS trailing_90d_credit_sales,
 round({div('ar', 'sales')} * 90::DOUBLE, 1) AS dso_days FROM t""")
add("sql_07", f"""WITH {UNPAID}
SELECT invoice_id, merchant_id, due_date, unpaid::DOUBLE AS outstanding_amount, age AS days_overdue
FROM unpaid_invoices WHERE age > 0""")
CASH_MONTHS = f"""cash AS (SELECT {ym('payment_date')} AS month, sum(payment_amount) AS k
 FROM payments WHERE payment_status = 'Success' GROUP BY 1),
bills AS (SELECT {ym('invoice_date')} AS month, sum(billed_fee) AS b, sum(expected_fee) AS e
 FROM invoices GROUP BY 1)"""
add("sql_08", f"""WITH {CASH_MONTHS}
SELECT month, b::DOUBLE AS billed_revenue, coalesce(k, 0)::DOUBLE AS collected_revenue,
 {pct('coalesce(k, 0)', 'b')} AS collection_rate_percent FROM bills LEFT JOIN cash USING (month)""")
add("sql_09", f"""WITH {PAID}, d AS (SELECT i.merchant_id,
 date_diff('day', i.due_date, p.first_day) AS x FROM invoices i JOIN paid p USING (invoice_id))
SELECT merchant_id, count(*) AS paid_invoice_count,
 round({div('sum(x)', 'count(x)')}, 1) AS avg_payment_delay_days,
 {pct('count(*) FILTER (x <= 0)', 'count(*)', 1)} AS on_time_payment_percent,
 max(x) AS max_delay_days FROM d GROUP BY 1""")
add("sql_10", """WITH u AS (SELECT merchant_id, expected_fee - billed_fee AS gap FROM invoices
 WHERE invoice_error_flag = 1 AND billed_fee < expected_fee)
SELECT merchant_id, count(*) AS underbilled_invoice_count, sum(gap)::DOUBLE AS total_leakage_amount
FROM u GROUP BY 1 HAVING sum(gap) > 0""")
add("sql_11", f"""SELECT merchant_segment, count(*) AS total_invoices,
 sum(invoice_error_flag)::BIGINT AS error_count,
 {pct('sum(invoice_error_flag)', 'count(*)')} AS error_rate_percent
FROM invoices JOIN merchants USING (merchant_id) GROUP BY 1""")
for number, name, gap in (
    ("12", "underbilled_amount", "i.expected_fee - i.billed_fee"),
    ("13", "overbilled_amount", "i.billed_fee - i.expected_fee"),
):
    add(f"sql_{number}", f"""SELECT invoice_id, merchant_id, invoice_date,
 expected_fee::DOUBLE AS expected_fee, billed_fee::DOUBLE AS billed_fee, ({gap})::DOUBLE AS {name}
FROM invoices i WHERE invoice_error_flag = 1 AND {gap} > 0""")
add("sql_14", f"""WITH {LEDGER}
SELECT invoice_id, merchant_id, total_invoice_amount::DOUBLE AS total_invoice_amount,
 paid::DOUBLE AS total_paid, n_paid AS payment_count, CASE WHEN n_paid = 0 THEN 'MISSING_PAYMENT'
 WHEN unpaid BETWEEN -1 AND 1 THEN 'MATCHED' WHEN unpaid > 0 THEN 'PARTIAL'
 ELSE 'AMOUNT_MISMATCH' END AS reconciliation_status FROM ledger WHERE invoice_status <> 'Void'""")
add("sql_15", """WITH n AS (SELECT *,
  count(*) OVER (PARTITION BY invoice_id, payment_amount) AS total FROM payments
 WHERE payment_status = 'Success' AND invoice_id IS NOT NULL)
SELECT invoice_id, payment_amount::DOUBLE AS payment_amount, total AS payment_count, payment_id
FROM n WHERE total > 1""")
add("sql_16", f"""WITH {MISSING_MONTHS}
SELECT merchant_id, {ym('month')} AS txn_month FROM missing""")
ORACLES["sql_17"] = ORACLES["x_invoices_without_payment"]
add("sql_18", f"""SELECT merchant_segment, count(DISTINCT merchant_id) AS merchant_count,
 sum(billed_fee)::DOUBLE AS total_billed_revenue,
 round({div('sum(billed_fee)', 'count(billed_fee)')}, 2) AS avg_invoice_value
FROM merchants JOIN invoices USING (merchant_id) GROUP BY 1""")
add("sql_19", """WITH b AS (SELECT merchant_id, sum(billed_fee) AS b FROM invoices GROUP BY 1),
r AS (SELECT merchant_id, sum(refund_amount) AS r FROM refunds WHERE refund_status = 'Processed'
 GROUP BY 1),
c AS (SELECT merchant_id, sum(credit_amount) AS c FROM credit_notes
 WHERE status IN ('Issued', 'Applied') GROUP BY 1)
SELECT merchant_id, b::DOUBLE AS total_billed_revenue, coalesce(r, 0)::DOUBLE AS total_refunds,
 coalesce(c, 0)::DOUBLE AS total_credit_notes,
 (b - coalesce(r, 0) - coalesce(c, 0))::DOUBLE AS net_revenue
FROM b LEFT JOIN r USING (merchant_id) LEFT JOIN c USING (merchant_id)""")
DELAYS = """delays AS (SELECT i.merchant_id, date_diff('day', i.due_date, p.payment_date) AS x
 FROM payments p JOIN invoices i USING (invoice_id) WHERE p.payment_status = 'Success')"""
add("sql_20", f"""WITH {UNPAID}, {DELAYS},
history AS (SELECT merchant_id, {div('sum(x)', 'count(x)')} AS mean FROM delays GROUP BY 1),
late AS (SELECT * FROM unpaid_invoices WHERE due_date < {AS_OF}),
s AS (SELECT invoice_id, merchant_id, unpaid, age, round(
  0.4::DOUBLE * (100::DOUBLE * unpaid::DOUBLE / (SELECT max(unpaid)::DOUBLE FROM late))
  + 0.3::DOUBLE * (100::DOUBLE * age::DOUBLE / (SELECT max(age)::DOUBLE FROM late))
  + 0.2::DOUBLE * (100::DOUBLE * coalesce(mean, 0::DOUBLE) / (SELECT max(mean) FROM history))
  + 0.1::DOUBLE * 50::DOUBLE, 1) AS score FROM late LEFT JOIN history USING (merchant_id))
SELECT invoice_id, merchant_id, unpaid::DOUBLE AS outstanding_amount, age AS days_overdue,
 score AS priority_score FROM s ORDER BY score DESC, invoice_id LIMIT 50""")
add("sql_21", f"""WITH {CASH_MONTHS}
SELECT month, e::DOUBLE AS expected_revenue, b::DOUBLE AS billed_revenue,
 (b - e)::DOUBLE AS billing_variance, {pct('b - e', 'e')} AS billing_variance_percent,
 coalesce(k, 0)::DOUBLE AS collected_revenue FROM bills LEFT JOIN cash USING (month)""")
add("sql_22", f"""WITH r AS (SELECT merchant_id, sum(billed_fee) AS b FROM invoices GROUP BY 1),
t AS (SELECT (SELECT sum(b) FROM (SELECT b FROM r ORDER BY b DESC, merchant_id LIMIT 10)) AS top,
 (SELECT sum(b) FROM r) AS every)
SELECT top::DOUBLE AS top_10_revenue, every::DOUBLE AS total_revenue,
 {pct('top', 'every')} AS top_10_share_percent FROM t""")
add("sql_23", f"""WITH {DELAYS}
SELECT merchant_segment, count(*) AS payment_count,
 round({div('sum(x)', 'count(x)')}, 1) AS avg_delay_days, max(x) AS max_delay_days
FROM delays JOIN merchants USING (merchant_id) GROUP BY 1""")
add("sql_24", f"""WITH {LEDGER}, {DELAYS},
o AS (SELECT merchant_id, coalesce(sum(unpaid) FILTER (due_date < {AS_OF}), 0) AS overdue
 FROM ledger WHERE invoice_status <> 'Void' GROUP BY 1),
h AS (SELECT merchant_id, {div('sum(x)', 'count(x)')} AS mean FROM delays GROUP BY 1)
SELECT merchant_id, merchant_name, merchant_segment, overdue::DOUBLE AS overdue_ar,
 round(coalesce(mean, 0::DOUBLE), 1) AS avg_payment_delay_days
FROM o JOIN merchants USING (merchant_id) LEFT JOIN h USING (merchant_id)
WHERE overdue > 5000 AND coalesce(mean, 0) > 15""")
GOT_PAID = "count(*) FILTER (outcome = 'Payment Received')"
add("sql_25", f"""SELECT activity_type, count(*) AS activity_count, {GOT_PAID} AS resulted_in_payment,
 {pct(GOT_PAID, 'count(*)')} AS recovery_effectiveness_percent FROM collection_activity GROUP BY 1""")
add("sql_26", f"""SELECT count(*) AS promises_made, {GOT_PAID} AS promises_kept,
 {pct(GOT_PAID, 'count(*)')} AS fulfillment_rate_percent FROM collection_activity
WHERE activity_type = 'Payment Promise'""")
SOLVED = "count(*) FILTER (resolution_status = 'Resolved')"
add("sql_27", f"""SELECT dispute_type, count(*) AS dispute_count,
 sum(disputed_amount)::DOUBLE AS total_disputed_amount, {SOLVED} AS resolved_count,
 {pct(SOLVED, 'count(*)')} AS resolution_rate_percent FROM disputes GROUP BY 1""")
add("sql_28", f"""SELECT industry, count(DISTINCT transaction_id) AS transaction_count,
 sum(transaction_amount)::DOUBLE AS gross_transaction_value,
 sum(refund_amount)::DOUBLE AS total_refunded,
 {pct('sum(refund_amount)', 'sum(transaction_amount)')} AS refund_rate_percent
FROM transactions JOIN merchants USING (merchant_id) GROUP BY 1""")

# ---------------------------------------------------------------- sources

add("scan_csv", """SELECT payment_id, invoice_id, merchant_id, payment_date,
 payment_amount::DOUBLE AS payment_amount, payment_status, settlement_date,
 false AS is_corrupt FROM payments""")
ORACLES["scan_table"] = "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000"

# ---------------------------------------------------------------- star schema

add("dim_merchant", """SELECT merchant_id, merchant_name, industry, merchant_segment,
 'City ' || merchant_id % 10 AS city, state, country,
 (DATE '1994-01-01' + (merchant_id % 300)::INT)::DATE AS onboarding_date,
 'Manager ' || merchant_id % 7 AS account_manager,
 CASE merchant_segment WHEN 'Enterprise' THEN 'Custom' ELSE 'Standard' END AS pricing_plan,
 (1.5 + (merchant_id % 5) * 0.4)::DECIMAL(9,4)::DOUBLE AS agreed_fee_percent,
 ((merchant_id % 4) * 100)::DOUBLE AS monthly_subscription_fee,
 payment_terms_days::BIGINT AS payment_terms_days, merchant_status FROM merchants""")
CALENDAR = """days AS (
 SELECT unnest([billing_period_start, invoice_date, due_date]) AS d FROM invoices
 UNION ALL SELECT unnest([payment_date, settlement_date]) FROM payments
 UNION ALL SELECT unnest([activity_date, promised_payment_date]) FROM collection_activity
 UNION ALL SELECT DATE '2001-08-13'),
calendar AS (SELECT make_date(year(min(d)), 1, 1) AS first_day, make_date(year(max(d)), 12, 31) AS last_day
 FROM days)"""
add("dim_date", f"""WITH {CALENDAR}, d AS (SELECT unnest(generate_series(first_day, last_day,
 INTERVAL 1 DAY))::DATE AS date FROM calendar)
SELECT date, strftime(date, '%Y%m%d')::BIGINT AS date_key, year(date) AS year, month(date) AS month,
 strftime(date, '%b') AS month_name, {ym('date')} AS year_month, 'Q' || quarter(date) AS quarter,
 dayname(date) AS day_of_week, date = last_day(date) AS is_month_end FROM d""")
FACT_INVOICES = """SELECT invoice_id, merchant_id, billing_period_start, invoice_date, due_date,
 total_invoice_amount::DOUBLE AS total_invoice_amount, expected_fee::DOUBLE AS expected_fee,
 billed_fee::DOUBLE AS billed_fee, invoice_status, payment_status,
 diff::DOUBLE AS revenue_difference, billing_status FROM classified"""
add("fact_invoices", f"WITH {BILLING} {FACT_INVOICES}")
add("fact_collection_activity", """SELECT collection_id, merchant_id, invoice_id, activity_date,
 activity_type, contact_channel, 'Agent ' || collection_id % 9 AS collector, outcome, promised_payment_date,
 promised_amount::DOUBLE AS promised_amount FROM collection_activity""")
add("export_star", f"""WITH {CALENDAR}, {LEAKAGE},
{AGING.replace('paid AS (', 'paid_sum AS (').replace('LEFT JOIN paid p', 'LEFT JOIN paid_sum p')}
SELECT 'dim_merchant' AS table_name, NULL::VARCHAR AS year_month, count(*) AS row_count, NULL::DOUBLE AS total
 FROM merchants
UNION ALL SELECT 'dim_date', NULL, last_day - first_day + 1, NULL FROM calendar
UNION ALL SELECT 'fact_invoices', {ym('invoice_date')}, count(*), sum(total_invoice_amount)::DOUBLE FROM invoices GROUP BY 2
UNION ALL SELECT 'fact_payments', {ym('payment_date')}, count(*), sum(payment_amount)::DOUBLE FROM payments GROUP BY 2
UNION ALL SELECT 'fact_collection_activity', {ym('activity_date')}, count(*), sum(promised_amount)::DOUBLE
 FROM collection_activity GROUP BY 2
UNION ALL SELECT 'fact_leakage', '2001-08', count(*), sum(amount)::DOUBLE FROM events HAVING count(*) > 0
UNION ALL SELECT 'fact_ar_aging', {ym('invoice_date')}, count(*), sum(open_amount)::DOUBLE FROM aging GROUP BY 2""")

# ---------------------------------------------------------------- measures

LAST_90 = f"BETWEEN {AS_OF} - 89 AND {AS_OF}"


def by_segment(name: str, numerator: str, denominator: str | None, prefix: str = "",
               value: str = "") -> None:
    """Numerator and denominator are queries of (merchant_id, x)."""
    den = denominator or "SELECT NULL::BIGINT AS merchant_id, 0 AS x WHERE false"
    result = value or pct("n", "d")
    add(name, f"""WITH {prefix}{', ' if prefix else ''}num AS ({numerator}), den AS ({denominator or den}),
ids AS (SELECT merchant_id FROM num UNION SELECT merchant_id FROM den),
sides AS (SELECT merchant_id, (SELECT sum(x) FROM num WHERE num.merchant_id = ids.merchant_id) AS n,
  (SELECT sum(x) FROM den WHERE den.merchant_id = ids.merchant_id) AS d FROM ids),
g AS (SELECT merchant_segment, coalesce(sum(n), 0) AS n, coalesce(sum(d), 0) AS d
 FROM sides LEFT JOIN merchants USING (merchant_id) GROUP BY 1)
SELECT merchant_segment, {result} AS {name} FROM g""")


CASH = "SELECT merchant_id, payment_amount AS x FROM payments WHERE payment_status = 'Success'"
BILLED = "SELECT merchant_id, billed_fee AS x FROM invoices"
by_segment("m_realization", CASH, BILLED)
by_segment(
    "m_billing_accuracy",
    "SELECT merchant_id, expected_fee AS x FROM classified WHERE billing_status = 'Correct'",
    "SELECT merchant_id, expected_fee AS x FROM classified", BILLING)
by_segment(
    "m_ar90_share",
    "SELECT merchant_id, open_amount AS x FROM aging WHERE aging_bucket = '90+ days'",
    "SELECT merchant_id, open_amount AS x FROM aging", AGING)
by_segment(
    "m_dso_t90", "SELECT merchant_id, open_amount AS x FROM aging",
    f"{BILLED} WHERE invoice_date {LAST_90}", AGING,
    f"round({div('n', 'd')} * 90::DOUBLE, 1)")
by_segment(
    "m_collection_rate", f"{CASH} AND payment_date {LAST_90}",
    f"{BILLED} WHERE invoice_date {LAST_90}")
by_segment(
    "m_leakage_total", "SELECT merchant_id, amount AS x FROM realized", None, LEAKAGE, "n::DOUBLE")
by_segment(
    "m_leakage_outstanding",
    "SELECT merchant_id, amount AS x FROM realized WHERE status = 'Outstanding'", None, LEAKAGE,
    "n::DOUBLE")
by_segment(
    "m_recon_rate",
    "SELECT merchant_id, (status = 'MATCHED')::INT AS x FROM recon_payments",
    "SELECT merchant_id, 1 AS x FROM recon_payments", RECON)
add("m_realization_by_month", f"""WITH {CASH_MONTHS}
SELECT month AS year_month, {pct('coalesce(k, 0)', 'b')} AS m_realization
FROM bills FULL JOIN cash USING (month)""")
add("m_recon_rate_total", f"""WITH {RECON}
SELECT {pct("count(*) FILTER (status = 'MATCHED')", 'count(*)')} AS m_recon_rate
FROM recon_payments""")
for name, column in (("m_billed", "billed_fee"), ("m_expected", "expected_fee")):
    add(name, f"""SELECT merchant_segment, sum(coalesce({column}, 0))::DOUBLE AS {name}
FROM invoices LEFT JOIN merchants USING (merchant_id) GROUP BY 1""")
add("m_collected", """SELECT merchant_segment, sum(coalesce(payment_amount, 0))::DOUBLE AS m_collected
FROM payments LEFT JOIN merchants USING (merchant_id) WHERE payment_status = 'Success' GROUP BY 1""")
add("m_total_ar", f"""WITH {AGING}
SELECT merchant_segment, sum(open_amount)::DOUBLE AS m_total_ar FROM aging GROUP BY 1""")
add("m_growth_mom", f"""WITH m AS (SELECT date_trunc('month', invoice_date)::DATE AS d,
 sum(billed_fee) AS b FROM invoices GROUP BY 1),
p AS (SELECT m.d, m.b, o.b AS before FROM m LEFT JOIN m o ON o.d = (m.d - INTERVAL 1 MONTH)::DATE)
SELECT {ym('d')} AS year_month, b::DOUBLE AS billed_revenue, before::DOUBLE AS prior_revenue,
 {pct('b - before', 'before')} AS m_growth_mom FROM p""")
add("m_billed_vs_collected", f"""WITH {CASH_MONTHS}
SELECT month AS year_month, coalesce(b, 0)::DOUBLE AS billed_revenue,
 coalesce(k, 0)::DOUBLE AS collected_revenue FROM bills FULL JOIN cash USING (month)""")
add("m_revenue_by_segment", """SELECT merchant_segment, sum(billed_fee)::DOUBLE AS billed_revenue
FROM invoices JOIN merchants USING (merchant_id) GROUP BY 1""")
add("m_top10_merchants", """WITH t AS (SELECT merchant_id, sum(billed_fee) AS b FROM invoices
 GROUP BY 1)
SELECT merchant_id, merchant_name, b::DOUBLE AS billed_revenue FROM t
JOIN merchants USING (merchant_id) ORDER BY b DESC, merchant_id LIMIT 10""")
add("m_expected_vs_billed", f"""WITH {CASH_MONTHS}
SELECT month AS year_month, e::DOUBLE AS expected_revenue, b::DOUBLE AS billed_revenue FROM bills""")
add("m_billing_status_counts", f"""WITH {BILLING}
SELECT billing_status, count(*) AS merchant_months FROM billing GROUP BY 1""")
add("m_merchant_invoice_detail", f"""WITH {BILLING} {FACT_INVOICES} WHERE merchant_id = (
 SELECT merchant_id FROM invoices GROUP BY 1 ORDER BY sum(billed_fee) DESC, merchant_id LIMIT 1)""")
add("m_ar_bucket_by_segment", f"""WITH {AGING}
SELECT merchant_segment, {", ".join(
    f"coalesce(sum(open_amount) FILTER (aging_bucket = '{b}'), 0)::DOUBLE AS {n}" for b, n in (
        ("Current", "current_ar"), ("1-30 days", "days_1_30"), ("31-60 days", "days_31_60"),
        ("61-90 days", "days_61_90"), ("90+ days", "days_90_plus")))} FROM aging GROUP BY 1""")

# ---------------------------------------------------------------- worksheets

add("xl_invoice_validation", f"""WITH v AS (SELECT i.*, coalesce(m.merchant_name, 'Not found') AS name,
 billed_fee - expected_fee AS diff FROM invoices i LEFT JOIN merchants m USING (merchant_id))
SELECT invoice_id, merchant_id, name AS merchant_name, expected_fee::DOUBLE AS expected_fee,
 billed_fee::DOUBLE AS billed_fee, diff::DOUBLE AS revenue_difference,
 CASE WHEN v.expected_fee = 0 THEN 0 ELSE {pct('diff', 'v.expected_fee')} END AS variance_percent,
 CASE WHEN diff < -0.01 THEN 'Underbilled' WHEN diff > 0.01 THEN 'Overbilled' ELSE 'Correct' END
 AS billing_status FROM v""")
SHEET = f"""{LEDGER}, sheet AS (SELECT l.*, coalesce(m.merchant_name, 'Not found') AS name,
 greatest(unpaid, 0) AS due_amount, CASE WHEN unpaid <= 0 THEN 'Excluded (paid)'
  WHEN age <= 0 THEN 'Current' WHEN age <= 30 THEN '1-30 days' WHEN age <= 60 THEN '31-60 days'
  WHEN age <= 90 THEN '61-90 days' ELSE '90+ days' END AS bucket
 FROM ledger l LEFT JOIN merchants m USING (merchant_id))"""
add("xl_ar_aging", f"""WITH {SHEET}
SELECT invoice_id, merchant_id, name AS merchant_name, due_date,
 total_invoice_amount::DOUBLE AS total_invoice_amount, paid::DOUBLE AS total_paid,
 due_amount::DOUBLE AS outstanding_amount, age AS days_overdue, bucket AS aging_bucket FROM sheet""")
add("xl_ar_aging_summary", f"""WITH {SHEET}, l(bucket) AS (VALUES ('Current'), ('1-30 days'),
 ('31-60 days'), ('61-90 days'), ('90+ days'))
SELECT bucket AS aging_bucket, count(invoice_id) AS invoice_count,
 coalesce(sum(due_amount), 0)::DOUBLE AS total_outstanding
FROM l LEFT JOIN sheet USING (bucket) GROUP BY 1""")
add("xl_reconciliation", f"""WITH {LEDGER}
SELECT invoice_id, merchant_id, total_invoice_amount::DOUBLE AS total_invoice_amount,
 paid::DOUBLE AS total_paid, (-unpaid)::DOUBLE AS variance, CASE WHEN paid = 0
 THEN 'MISSING_PAYMENT' WHEN unpaid > 1 THEN 'PARTIAL' WHEN unpaid < -1 THEN 'AMOUNT_MISMATCH'
 ELSE 'MATCHED' END AS reconciliation_status FROM ledger""")
add("xl_monthly_mis", f"""SELECT {ym('billing_period_start')} AS billing_month,
 count(*) AS invoice_count, sum(expected_fee)::DOUBLE AS expected_revenue,
 sum(billed_fee)::DOUBLE AS billed_revenue,
 (sum(billed_fee) - sum(expected_fee))::DOUBLE AS revenue_variance FROM invoices GROUP BY 1""")
add("xl_kpi_dashboard", f"""WITH {LEDGER}, t AS (SELECT sum(expected_fee) AS e, sum(billed_fee) AS b,
 count(*) FILTER (abs(billed_fee - expected_fee) <= 0.01) AS ok, count(*) AS n,
 sum(greatest(unpaid, 0)) AS ar, (SELECT sum(payment_amount) FROM payments
  WHERE payment_status = 'Success') AS k FROM ledger)
SELECT 'Total Expected Revenue' AS kpi, e::DOUBLE AS value FROM t
UNION ALL SELECT 'Total Billed Revenue', b::DOUBLE FROM t
UNION ALL SELECT 'Billing Accuracy %', {pct('ok', 'n')} FROM t
UNION ALL SELECT 'Total Collected (Payments, Success)', k::DOUBLE FROM t
UNION ALL SELECT 'Revenue Realization %', {pct('k', 'b')} FROM t
UNION ALL SELECT 'Total Outstanding AR', ar::DOUBLE FROM t
UNION ALL SELECT 'Invoices Analyzed', n::DOUBLE FROM t
UNION ALL SELECT 'Payments Analyzed', count(*)::DOUBLE FROM payments
UNION ALL SELECT 'Merchants in Sample', count(*)::DOUBLE FROM merchants""")
SAMPLE = """sample AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY merchant_segment
  ORDER BY md5(merchant_id || '-42'), merchant_id) AS place FROM merchants)
 WHERE place <= CASE merchant_segment WHEN 'Enterprise' THEN 4 WHEN 'Mid-Market' THEN 8
  ELSE 14 END)"""
add("stratified_sample", f"""WITH {SAMPLE}
SELECT merchant_id, merchant_name, merchant_segment FROM sample""")
add("stratified_sample_tables", f"""WITH {SAMPLE},
si AS (SELECT * FROM invoices WHERE merchant_id IN (SELECT merchant_id FROM sample)),
st AS (SELECT * FROM transactions WHERE merchant_id IN (SELECT merchant_id FROM sample))
SELECT 'merchants' AS table_name, count(*) AS row_count, NULL::DOUBLE AS amount FROM sample
UNION ALL SELECT 'invoices', count(*), coalesce(sum(total_invoice_amount), 0)::DOUBLE FROM si
UNION ALL SELECT 'payments', count(*), coalesce(sum(payment_amount), 0)::DOUBLE FROM payments
 WHERE invoice_id IN (SELECT invoice_id FROM si)
UNION ALL SELECT 'collection_activity', count(*), NULL FROM collection_activity
 WHERE merchant_id IN (SELECT merchant_id FROM sample)
UNION ALL SELECT 'transactions', count(*), coalesce(sum(transaction_amount), 0)::DOUBLE FROM st""")

# ---------------------------------------------------------------- derivations

add("asof_contract_rate", """WITH p AS (SELECT t.*,
 coalesce(k.transaction_fee_percent, 2.5)::DECIMAL(9,4) AS rate
 FROM raw_transactions t ASOF LEFT JOIN contracts k
  ON k.merchant_id = t.merchant_id AND k.effective_from <= t.transaction_date
 WHERE t.merchant_id IS NOT NULL)
SELECT transaction_id, merchant_id, transaction_date,
 transaction_amount::DOUBLE AS transaction_amount, rate::DOUBLE AS contract_fee_percent,
 (p.transaction_amount * rate * 0.01)::DECIMAL(18,2)::DOUBLE AS expected_fee FROM p""")
add("rate_invoices", f"""WITH m AS (SELECT merchant_id,
  date_trunc('month', transaction_date)::DATE AS d, sum(expected_platform_fee)::DECIMAL(18,2) AS fee
 FROM transactions GROUP BY 1, 2),
r AS (SELECT m.*, last_day(m.d) + 2 AS issued, coalesce((k.contract_id % 4) * 2.5, 0) AS off
 FROM m ASOF LEFT JOIN contracts k ON k.merchant_id = m.merchant_id AND k.effective_from <= m.d),
x AS (SELECT r.*, (fee * off * 0.01)::DECIMAL(18,2) AS less FROM r),
y AS (SELECT x.*, fee - less AS net, ((fee - less) * 0.18)::DECIMAL(18,2) AS tax FROM x)
SELECT merchant_id, d AS billing_period_start, last_day(d) AS billing_period_end,
 issued AS invoice_date, issued + payment_terms_days AS due_date, fee::DOUBLE AS subtotal,
 less::DOUBLE AS discount, net::DOUBLE AS taxable_amount, tax::DOUBLE AS tax_amount,
 (net + tax)::DOUBLE AS total_invoice_amount,
 CASE WHEN {AS_OF} - issued < 3 THEN 'Draft' ELSE 'Issued' END AS invoice_status
FROM y JOIN merchants USING (merchant_id)""")
SETTLED = f"""{LEDGER}, ratio AS (SELECT *, CASE
  WHEN total_invoice_amount > 0 AND paid >= total_invoice_amount * 0.995 THEN 'Paid'
  WHEN paid > 0 THEN 'Partially Paid' ELSE 'Unpaid' END AS pay FROM ledger),
settled AS (SELECT *, CASE WHEN pay = 'Paid' AND invoice_status IN ('Issued', 'Overdue') THEN 'Paid'
  WHEN pay <> 'Paid' AND invoice_status = 'Issued' AND age > 0 THEN 'Overdue'
  ELSE invoice_status END AS state FROM ratio)"""
add("invoice_settlement_status", f"""WITH {SETTLED}
SELECT invoice_id, merchant_id, due_date, total_invoice_amount::DOUBLE AS total_invoice_amount,
 paid::DOUBLE AS total_paid, pay AS settled_payment_status, state AS settled_invoice_status
FROM settled""")
add("chase_candidates", f"""WITH {SETTLED}
SELECT invoice_id, merchant_id, state AS settled_invoice_status, pay AS settled_payment_status
FROM settled WHERE state = 'Overdue' UNION
SELECT invoice_id, merchant_id, state, pay FROM settled WHERE pay = 'Partially Paid'""")
add("contract_intervals", """WITH n AS (SELECT k.*, (SELECT min(o.effective_from) FROM contracts o
  WHERE o.merchant_id = k.merchant_id AND o.effective_from > k.effective_from) AS following
 FROM contracts k)
SELECT contract_id, merchant_id, effective_from, following AS effective_to,
 CASE WHEN following IS NOT NULL THEN 'Superseded' WHEN merchant_status = 'Churned'
  THEN 'Terminated' ELSE 'Active' END AS contract_status
FROM n LEFT JOIN merchants USING (merchant_id)""")
add("refund_events", """SELECT transaction_id, merchant_id, transaction_date,
 refund_amount::DOUBLE AS refund_amount FROM transactions t WHERE t.refund_amount > 0""")
