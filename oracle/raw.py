"""Check queries for data quality, cleaning and constraints of the uncleaned extract."""

from __future__ import annotations

from oracle.queries import MISSING_MONTHS, PAID, add, ym
from tallywright.model import LOADED_REFERENCES, TABLES

RAW = """repeated_transactions AS (
 SELECT * EXCLUDE (again) REPLACE ((transaction_date + (CASE WHEN again = 1 THEN transaction_id % 2 ELSE 0 END)::INT)::DATE
  AS transaction_date) FROM raw_transactions
 JOIN (VALUES (0), (1)) AS r(again) ON again = 0 OR transaction_id % 31 = 0),
raw_invoices AS (
 SELECT invoice_id, merchant_id, midx, billing_period_start, invoice_date + again AS invoice_date,
  CASE WHEN invoice_id % 37 = 0 THEN NULL WHEN invoice_id % 59 = 0 THEN raw_date - 5 ELSE due_date END AS due_date,
  expected_fee, k,
  CASE WHEN full_row THEN billed_fee END AS billed_fee,
  CASE WHEN full_row THEN total_invoice_amount END AS total_invoice_amount,
  invoice_status, payment_status, invoice_error_flag,
  CASE WHEN full_row THEN billed_fee END AS subtotal,
  CASE WHEN full_row THEN 0::DECIMAL(18,2) END AS discount,
  CASE WHEN full_row THEN billed_fee END AS taxable_amount, 0.18::DECIMAL(9,4) AS tax_rate,
  CASE WHEN full_row THEN (billed_fee * 0.18)::DECIMAL(18,2) END AS tax_amount
 FROM (SELECT *, invoice_date AS raw_date, invoice_id % 41 <> 0 AS full_row FROM invoices)
 JOIN (VALUES (0), (1)) AS r(again) ON again = 0 OR invoice_id % 43 = 0),
raw_payments AS (SELECT payment_id, invoice_id, merchant_id, payment_date + again AS payment_date,
  CASE WHEN abs(payment_id) % 53 <> 0 THEN payment_amount END AS payment_amount, payment_status,
  settlement_date FROM payments
 JOIN (VALUES (0), (1)) AS r(again) ON again = 0 OR abs(payment_id) % 29 = 0),
raw_credit_notes AS (SELECT credit_note_id,
  CASE WHEN credit_note_id % 61 = 0 THEN -invoice_id ELSE invoice_id END AS invoice_id, merchant_id,
  credit_note_date + again AS credit_note_date,
  CASE WHEN credit_note_id % 31 <> 0 THEN credit_amount END AS credit_amount, status
 FROM credit_notes JOIN (VALUES (0), (1)) AS r(again) ON again = 0 OR credit_note_id % 17 = 0),
raw_refunds AS (SELECT refund_id, transaction_id,
  CASE WHEN refund_id % 53 = 0 THEN -merchant_id - 1
   WHEN refund_id % 47 <> 0 THEN merchant_id END AS merchant_id,
  refund_date + again AS refund_date, refund_amount, refund_status FROM refunds
 JOIN (VALUES (0), (1)) AS r(again) ON again = 0 OR refund_id % 23 = 0)"""
SOURCE = {
    name: f"raw_{name}" if name in ("invoices", "payments", "credit_notes", "refunds") else name
    for name in TABLES
} | {"transactions": "repeated_transactions"}
COLUMNS = {
    "merchants": "merchant_id merchant_name industry merchant_segment state country "
    "payment_terms_days merchant_status",
    "contracts": "contract_id merchant_id effective_from transaction_fee_percent",
    "transactions": "transaction_id merchant_id transaction_date order_id transaction_amount "
    "payment_status refund_amount l_partkey l_suppkey",
    "invoices": "invoice_id merchant_id midx billing_period_start invoice_date due_date "
    "expected_fee k billed_fee total_invoice_amount invoice_status payment_status "
    "invoice_error_flag subtotal discount taxable_amount tax_rate tax_amount",
    "payments": "payment_id invoice_id merchant_id payment_date payment_amount payment_status "
    "settlement_date",
    "refunds": "refund_id transaction_id merchant_id refund_date refund_amount refund_status",
    "credit_notes": "credit_note_id invoice_id merchant_id credit_note_date credit_amount status",
    "collection_activity": "collection_id merchant_id invoice_id activity_date activity_type "
    "contact_channel outcome promised_payment_date promised_amount",
    "disputes": "dispute_id merchant_id invoice_id dispute_date dispute_type disputed_amount "
    "resolution_status",
}
HAS = {name: columns.split() for name, columns in COLUMNS.items()}


def row(table: str, check: str, column: str | None, condition: str, source: str = "") -> str:
    label = "NULL::VARCHAR" if column is None else f"'{column}'"
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, {label} AS column_name, "
        f"count(*) AS violations FROM {source or SOURCE[table]} WHERE {condition}"
    )


def listed(values) -> str:
    return ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)


def missing(t):
    return [row(t, "missing_values", c, f"{c} IS NULL") for c in TABLES[t].required if c in HAS[t]]


def bad_dates(t):
    return [
        row(t, "invalid_dates", c, f"{c} < DATE '1990-01-01' OR {c} > DATE '2000-12-31'")
        for c in TABLES[t].dates if c in HAS[t]
    ]


def date_order(t):
    return [
        row(t, "date_order", f"{b} < {a}", f"{b} < {a}")
        for a, b in TABLES[t].ordered_dates if a in HAS[t] and b in HAS[t]
    ]


def negative(t):
    return [
        row(t, "negative_amounts", c, f"{c} < 0") for c in TABLES[t].non_negative if c in HAS[t]
    ]


def ranges(t):
    return [
        row(t, "out_of_range", c, f"{c} < {lo} OR {c} > {hi}")
        for c, lo, hi in TABLES[t].ranges if c in HAS[t]
    ]


def domain(t, source=""):
    return [
        row(t, "invalid_domain", c, f"{c} NOT IN ({listed(allowed)})", source)
        for c, allowed in TABLES[t].domains.items() if c in HAS[t]
    ]


def shared(t, check, keys):
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    groups = f"(SELECT {', '.join(keys)}, count(*) AS n FROM {SOURCE[t]} GROUP BY ALL)"
    return [
        f"SELECT '{t}' AS table_name, '{check}' AS check_name, '{', '.join(keys)}' AS column_name, "
        f"count(*) AS violations FROM {SOURCE[t]} a JOIN {groups} b ON {same} WHERE b.n > 1"
    ]


def unresolved(t, refs, check="unresolved_reference", nulls=False):
    out = []
    for r in refs:
        if r.column in HAS[t]:
            absent = (
                f"NOT EXISTS (SELECT 1 FROM {SOURCE[r.parent]} p WHERE p.{r.parent_key} = c.{r.column})"
            )
            given = "true" if nulls else f"c.{r.column} IS NOT NULL"
            out.append(row(t, check, f"{r.column} -> {r.parent}.{r.parent_key}",
                           f"{given} AND {absent}", f"{SOURCE[t]} c"))
    return out


def extra(t, check):
    key = TABLES[t].key
    return [
        f"SELECT '{t}' AS table_name, '{check}' AS check_name, '{key}' AS column_name, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {SOURCE[t]})) AS violations "
        f"FROM {SOURCE[t]}"
    ]


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def nonzero(parts) -> str:
    return f"SELECT * FROM ({union(parts)}) WHERE violations > 0"


def over_tables(*checks):
    return [part for t in TABLES for check in checks for part in check(t)]


def add_raw(name: str, sql: str) -> None:
    """``sql`` is a body without CTEs of its own."""
    add(name, f"WITH {RAW}\n{sql}")


add_raw("dq_missing", nonzero(over_tables(missing)))
add_raw("dq_invalid_dates", nonzero(over_tables(bad_dates)))
add_raw("dq_date_order", nonzero(over_tables(date_order)))
add_raw("dq_negative", nonzero(over_tables(negative)))
add_raw("dq_range", nonzero([
    row(t, "out_of_range", "transaction_fee_percent",
        "transaction_fee_percent * 5 < 0 OR transaction_fee_percent * 5 > 15", t)
    for t in ("contracts", "transactions")
] + over_tables(ranges)))
add_raw("dq_domain", nonzero([
    part for t in TABLES for part in domain(t, "transactions" if t == "transactions" else "")
]))
add_raw("dq_dup_ids", union(over_tables(
    lambda t: shared(t, "duplicate_ids", [TABLES[t].key]))))
add_raw("dq_dup_rows", union(over_tables(
    lambda t: shared(t, "duplicate_business_rows", TABLES[t].business_key)
    if TABLES[t].business_key else [])))
add_raw("dq_referential", nonzero(over_tables(lambda t: unresolved(t, TABLES[t].references))))
add_raw("dq_findings", union([
    *[row(t, "rows", None, "true") for t in TABLES],
    *over_tables(lambda t: shared(t, "duplicate_ids", [TABLES[t].key])),
    *over_tables(lambda t: shared(t, "duplicate_business_rows", TABLES[t].business_key)
                 if TABLES[t].business_key else []),
]) + "\nUNION ALL " + nonzero(over_tables(
    missing, bad_dates, date_order, negative, ranges, domain,
    lambda t: unresolved(t, TABLES[t].references))))
add_raw("dq_missing_cells", union(
    f"SELECT '{t}' AS table_name, sum(x)::BIGINT AS missing_cells, "
    f"round(100::DOUBLE * sum(x)::DOUBLE / nullif((count(*) * {len(HAS[t])})::DOUBLE, 0), 3) "
    f"AS missing_pct_of_cells FROM (SELECT {' + '.join(f'({c} IS NULL)::INT' for c in HAS[t])} AS x "
    f"FROM {SOURCE[t]})"
    for t in TABLES
))
add_raw("dq_dup_pk_extra", union(over_tables(lambda t: extra(t, "duplicate_pk_rows"))))
add_raw("dq_fk_spot", union([
    part
    for t, column, parent, nulls in (
        ("invoices", "merchant_id", "merchants", True),
        ("payments", "invoice_id", "invoices", False),
        ("transactions", "merchant_id", "merchants", True),
        ("credit_notes", "invoice_id", "invoices", True),
    )
    for part in unresolved(
        t, [r for r in LOADED_REFERENCES[t] if r.column == column and r.parent == parent],
        "orphaned_rows", nulls)
]))
add_raw("table_profile", union(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(HAS[t])}::BIGINT AS column_count "
    f"FROM {SOURCE[t]}" for t in TABLES
))
add("load_model", union(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, sum({TABLES[t].key})::BIGINT AS key_total, "
    f"sum({measure})::DOUBLE AS measure_total FROM {t}"
    + (" WHERE invoice_id IS NULL OR invoice_id IN (SELECT invoice_id FROM invoices)" if t == "payments" else "")
    for t, measure in (
        ("merchants", "payment_terms_days"), ("contracts", "transaction_fee_percent"),
        ("transactions", "transaction_amount"), ("invoices", "total_invoice_amount"),
        ("payments", "payment_amount"), ("refunds", "refund_amount"), ("credit_notes", "credit_amount"),
        ("collection_activity", "promised_amount"), ("disputes", "disputed_amount"))
))
add("category_mix", union(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c}::VARCHAR AS value, "
    f"count(*) AS value_count, round(count(*)::DOUBLE / (SELECT count({c}) FROM {t})::DOUBLE, 3) "
    f"AS value_share FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"
    for t, c in (
        ("merchants", "merchant_status"), ("merchants", "merchant_segment"),
        ("transactions", "payment_status"), ("invoices", "payment_status"),
        ("invoices", "invoice_error_flag"))
))

# ---------------------------------------------------------------- cleaning

FIRST_TRANSACTION = """first_transaction AS (SELECT *, row_number() OVER (PARTITION BY transaction_id
 ORDER BY transaction_date) AS rn FROM repeated_transactions)"""
CLEAN_TRANSACTION = f"""{FIRST_TRANSACTION}, kept_transaction AS (SELECT * FROM first_transaction
 WHERE rn = 1 AND merchant_id IS NOT NULL AND transaction_amount >= 0)"""


def first(t: str, order: str) -> str:
    key = TABLES[t].key
    return (
        f"first_{t} AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM {SOURCE[t]})"
    )


add("clean_transactions", f"""WITH {RAW}, {CLEAN_TRANSACTION}
SELECT transaction_id, merchant_id, transaction_date, order_id,
 transaction_amount::DOUBLE AS transaction_amount,
 coalesce(payment_status, 'Unknown') AS payment_status, refund_amount::DOUBLE AS refund_amount,
 l_partkey, l_suppkey FROM kept_transaction""")
add("clean_invoices", f"""WITH {RAW}, {first('invoices', 'invoice_date')}
SELECT invoice_id, merchant_id, billing_period_start, invoice_date,
 coalesce(due_date, invoice_date + 30)::DATE AS due_date, expected_fee::DOUBLE AS expected_fee,
 (CASE WHEN gap THEN expected_fee ELSE billed_fee END)::DOUBLE AS billed_fee,
 (CASE WHEN gap THEN expected_fee + (expected_fee * 0.18)::DECIMAL(18,2)
  ELSE total_invoice_amount END)::DOUBLE AS total_invoice_amount,
 invoice_status, payment_status,
 (CASE WHEN gap THEN 1 ELSE invoice_error_flag END)::BIGINT AS invoice_error_flag,
 (CASE WHEN gap THEN expected_fee ELSE subtotal END)::DOUBLE AS subtotal,
 (CASE WHEN gap THEN 0 ELSE discount END)::DOUBLE AS discount,
 (CASE WHEN gap THEN expected_fee ELSE taxable_amount END)::DOUBLE AS taxable_amount,
 tax_rate::DOUBLE AS tax_rate,
 (CASE WHEN gap THEN (expected_fee * 0.18)::DECIMAL(18,2) ELSE tax_amount END)::DOUBLE AS tax_amount
FROM (SELECT *, total_invoice_amount IS NULL AND expected_fee IS NOT NULL AS gap
 FROM first_invoices WHERE rn = 1)""")
PAYMENT_COLUMNS = """payment_id, invoice_id, merchant_id, payment_date,
 payment_amount::DOUBLE AS payment_amount, payment_status, settlement_date"""
add("dedupe_pk", f"""WITH {RAW}, {first('payments', 'payment_date')}
SELECT {PAYMENT_COLUMNS} FROM first_payments WHERE rn = 1""")
add("clean_payments", f"""WITH {RAW}, {first('payments', 'payment_date')}
SELECT {PAYMENT_COLUMNS} FROM first_payments p WHERE rn = 1 AND p.payment_amount IS NOT NULL""")
add("clean_credit_notes", f"""WITH {RAW}, {first('credit_notes', 'credit_note_date')}
SELECT credit_note_id, invoice_id, merchant_id, credit_note_date,
 credit_amount::DOUBLE AS credit_amount, status
FROM first_credit_notes c WHERE rn = 1 AND c.credit_amount IS NOT NULL""")
add("clean_refunds", f"""WITH {RAW}, {CLEAN_TRANSACTION}, {first('refunds', 'refund_date')}
SELECT refund_id, transaction_id, merchant_id, refund_date, refund_amount::DOUBLE AS refund_amount,
 refund_status FROM first_refunds WHERE rn = 1 AND merchant_id IS NOT NULL
 AND transaction_id IN (SELECT transaction_id FROM kept_transaction)""")


def stat(t: str, step: str, value: str) -> str:
    return f"SELECT '{t}' AS table_name, '{step}' AS step, ({value})::BIGINT AS row_count"


def count(source: str, condition: str = "true") -> str:
    return f"SELECT count(*) FROM {source} WHERE {condition}"


STATS = []
for t, spec in TABLES.items():
    one = f"first_{t.removesuffix('s') if t == 'transactions' else t}"
    STATS += [
        stat(t, "rows_before", count(SOURCE[t])),
        stat(t, "duplicate_rows_dropped",
             f"SELECT count(*) - count(DISTINCT {spec.key}) FROM {SOURCE[t]}"),
    ]
    if t == "transactions":
        ok = "rn = 1 AND merchant_id IS NOT NULL"
        STATS += [
            stat(t, "missing_merchant_dropped", count(one, "rn = 1 AND merchant_id IS NULL")),
            stat(t, "negative_amount_dropped", count(one, f"{ok} AND transaction_amount < 0")),
            stat(t, "missing_status_filled", count("kept_transaction", "payment_status IS NULL")),
            stat(t, "rows_after", count("kept_transaction")),
        ]
    elif t == "invoices":
        STATS += [
            stat(t, "missing_due_date_filled", count(one, "rn = 1 AND due_date IS NULL")),
            stat(t, "incomplete_amounts_rebuilt", count(
                one, "rn = 1 AND total_invoice_amount IS NULL AND expected_fee IS NOT NULL")),
            stat(t, "rows_after", count(one, "rn = 1")),
        ]
    elif t in ("payments", "credit_notes"):
        amount = "payment_amount" if t == "payments" else "credit_amount"
        STATS += [
            stat(t, "missing_amount_dropped", count(one, f"rn = 1 AND {amount} IS NULL")),
            stat(t, "rows_after", count(one, f"rn = 1 AND {amount} IS NOT NULL")),
        ]
    elif t == "refunds":
        ok = "rn = 1 AND merchant_id IS NOT NULL AND transaction_id"
        STATS += [
            stat(t, "missing_merchant_dropped", count(one, "rn = 1 AND merchant_id IS NULL")),
            stat(t, "parent_dropped", count(
                one, f"{ok} NOT IN (SELECT transaction_id FROM kept_transaction)")),
            stat(t, "rows_after", count(
                one, f"{ok} IN (SELECT transaction_id FROM kept_transaction)")),
        ]
    else:
        STATS.append(stat(t, "rows_after", count(t)))
add("cleaning_stats", f"""WITH {RAW}, {CLEAN_TRANSACTION}, {first('invoices', 'invoice_date')},
{first('payments', 'payment_date')}, {first('credit_notes', 'credit_note_date')},
{first('refunds', 'refund_date')}
{union(STATS)}""")

# ---------------------------------------------------------------- constraints


def constraints(t: str) -> list[str]:
    spec, has = TABLES[t], HAS[t]
    rules = extra(t, "primary_key")
    rules += [row(t, "not_null", c, f"{c} IS NULL") for c in (spec.key, *spec.not_null) if c in has]
    rules += [row(t, "non_negative", c, f"{c} < 0") for c in spec.checked_non_negative if c in has]
    rules += [row(t, "positive", c, f"{c} <= 0") for c in spec.checked_positive if c in has]
    rules += [
        row(t, "domain", c, f"{c} NOT IN ({listed(v)})")
        for c, v in spec.checked_domains.items() if c in has
    ]
    return rules + unresolved(t, LOADED_REFERENCES[t], "foreign_key")


add_raw("constraint_violations", nonzero(over_tables(constraints)))

# ---------------------------------------------------------------- cross-table checks

add("x_missing_invoices", f"""WITH {MISSING_MONTHS}
SELECT merchant_id, {ym('month')} AS billing_period, txns AS transaction_count FROM missing""")
add("x_duplicate_payments", """SELECT payment_id, invoice_id, merchant_id, payment_date,
 payment_amount::DOUBLE AS payment_amount FROM payments p WHERE payment_status = 'Success'
 AND EXISTS (SELECT 1 FROM payments o WHERE o.payment_status = 'Success'
  AND o.invoice_id = p.invoice_id AND o.payment_amount = p.payment_amount
  AND o.payment_id <> p.payment_id)""")
add("x_unmatched_payments", """SELECT payment_id, invoice_id, merchant_id,
 payment_amount::DOUBLE AS payment_amount, payment_status FROM payments
WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices)""")
add("x_orphan_payments", """SELECT payment_id, merchant_id, payment_date,
 payment_amount::DOUBLE AS payment_amount, payment_status FROM payments WHERE invoice_id IS NULL""")
add("x_invoices_without_payment", f"""WITH {PAID}
SELECT invoice_id, merchant_id, invoice_date, due_date,
 total_invoice_amount::DOUBLE AS total_invoice_amount FROM invoices
WHERE invoice_status <> 'Void' AND invoice_id NOT IN (SELECT invoice_id FROM paid)""")
add("x_amount_mismatches", f"""WITH {PAID}
SELECT invoice_id, i.merchant_id, total_invoice_amount::DOUBLE AS total_invoice_amount,
 coalesce(paid, 0)::DOUBLE AS total_paid,
 (coalesce(paid, 0) - total_invoice_amount)::DOUBLE AS variance
FROM invoices i LEFT JOIN paid USING (invoice_id)
WHERE abs(coalesce(paid, 0) - total_invoice_amount) > 1""")
