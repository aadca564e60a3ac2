"""Cleaning of raw tables, with the counts of what each step changed.

Steps are sequential: a row dropped by one step is not counted by a later one.
"Keep first" needs an order that Spark rows do not have, so callers name it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallywright.functions.numeric import count_where, money
from tallywright.functions.relational import keep_first
from tallywright.model import SOURCE_ORDER, TABLES, UNREADABLE, Tables
from tallywright.operators.quality import unreadable, union_all

DEFAULT_TERMS_DAYS = 30  # fixed value: payment terms when the due date is missing
UNKNOWN_STATUS = "Unknown"
WRITERS = 4  # tables cleaned at a time


def _survivors(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row per key; without another order, the first one in the source files."""
    if not order_by and SOURCE_ORDER in df.columns:
        order_by = (SOURCE_ORDER,)
    return keep_first(df, key, order_by)


def dedupe_pk(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    return _survivors(df, key, order_by).drop("_copies")


def _kept_transactions() -> Column:
    return F.col("merchant_id").isNotNull() & (F.col("transaction_amount") >= 0)


def _cleaned_transactions(deduped: DataFrame) -> DataFrame:
    return deduped.where(_kept_transactions()).withColumn(
        "payment_status", F.coalesce("payment_status", F.lit(UNKNOWN_STATUS))
    )


def clean_transactions(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    return _cleaned_transactions(dedupe_pk(df, "transaction_id", order_by))


def _incomplete() -> Column:
    return F.col("total_invoice_amount").isNull() & F.col("expected_fee").isNotNull()


def _no_due_date(df: DataFrame) -> Column:
    # a date that cannot be read is reported, not made up
    return F.col("due_date").isNull() & ~unreadable(df, "due_date")


def _cleaned_invoices(deduped: DataFrame) -> DataFrame:
    fee = F.col("expected_fee")
    tax = money(fee * F.col("tax_rate"))
    rebuilt = {
        "subtotal": fee,
        "discount": F.lit(0),
        "taxable_amount": fee,
        "tax_amount": tax,
        "billed_fee": fee,
        "invoice_error_flag": F.lit(1),
        "total_invoice_amount": money(fee + tax),
    }
    fixed = {
        name: F.when(_incomplete(), value).otherwise(F.col(name)).cast(deduped.schema[name].dataType)
        for name, value in rebuilt.items()
        if name in deduped.columns
    }
    due = F.when(_no_due_date(deduped), F.date_add("invoice_date", DEFAULT_TERMS_DAYS)).otherwise(F.col("due_date"))
    return deduped.withColumns({**fixed, "due_date": due})


def clean_invoices(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Fill missing due dates; rebuild blank amounts from the expected fee and flag them."""
    return _cleaned_invoices(dedupe_pk(df, "invoice_id", order_by))


def _with_amount(deduped: DataFrame, amount: str) -> DataFrame:
    return deduped.where(F.col(amount).isNotNull())


def clean_payments(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    return _with_amount(dedupe_pk(df, "payment_id", order_by), "payment_amount")


def clean_credit_notes(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    return _with_amount(dedupe_pk(df, "credit_note_id", order_by), "credit_amount")


def clean_refunds(
    df: DataFrame, transactions: DataFrame, order_by: Sequence[str] = ()
) -> DataFrame:
    """Drop refunds without merchant or whose transaction did not survive cleaning."""
    return (
        dedupe_pk(df, "refund_id", order_by)
        .where(F.col("merchant_id").isNotNull())
        .join(transactions.select("transaction_id"), "transaction_id", "left_semi")
        .select(*df.columns)
    )


def clean_all(tables: Tables, orders: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """All nine tables cleaned; ``orders`` gives the keep-first order per table."""
    orders = orders or {}
    steps = {
        "transactions": clean_transactions,
        "invoices": clean_invoices,
        "payments": clean_payments,
        "credit_notes": clean_credit_notes,
    }
    cleaned = {}
    for name in TABLES:
        order = orders.get(name, ())
        if name in steps:
            cleaned[name] = steps[name](tables[name], order)
        elif name == "refunds":
            cleaned[name] = clean_refunds(tables[name], cleaned["transactions"], order)
        else:
            cleaned[name] = dedupe_pk(tables[name], TABLES[name].key, order)
    return {name: df.drop(UNREADABLE, SOURCE_ORDER) for name, df in cleaned.items()}


def _counted(name: str, survivors: DataFrame) -> dict[str, Column]:
    """What each step does to a table's survivors of deduplication, as counts over these.

    Survivors carry how many rows they stand for, and refunds whether their transaction is left.
    """
    everything, merchant = F.count(F.lit(1)), F.col("merchant_id")
    steps = {
        "rows_before": F.sum("_copies"), "duplicate_rows_dropped": F.sum(F.col("_copies") - 1),
    }
    if name == "transactions":
        negative = merchant.isNotNull() & (F.col("transaction_amount") < 0)
        unknown = _kept_transactions() & F.col("payment_status").isNull()
        return steps | {
            "missing_merchant_dropped": count_where(merchant.isNull()),
            "negative_amount_dropped": count_where(negative),
            "missing_status_filled": count_where(unknown),
            "rows_after": count_where(_kept_transactions()),
        }
    if name == "invoices":
        return steps | {
            "missing_due_date_filled": count_where(_no_due_date(survivors)),
            "incomplete_amounts_rebuilt": count_where(_incomplete()),
            "rows_after": everything,
        }
    if name in ("payments", "credit_notes"):
        amount = F.col("payment_amount" if name == "payments" else "credit_amount")
        return steps | {
            "missing_amount_dropped": count_where(amount.isNull()),
            "rows_after": count_where(amount.isNotNull()),
        }
    if name == "refunds":
        return steps | {
            "missing_merchant_dropped": count_where(merchant.isNull()),
            "parent_dropped": count_where(merchant.isNotNull() & ~F.col("_parent")),
            "rows_after": count_where(merchant.isNotNull() & F.col("_parent")),
        }
    return steps | {"rows_after": everything}


def _changed(name: str, survivors: DataFrame) -> DataFrame:
    """Survivors after the steps that drop or fill."""
    if name == "transactions":
        return _cleaned_transactions(survivors)
    if name == "invoices":
        return _cleaned_invoices(survivors)
    if name in ("payments", "credit_notes"):
        return _with_amount(survivors, "payment_amount" if name == "payments" else "credit_amount")
    if name == "refunds":
        return survivors.where(F.col("merchant_id").isNotNull() & F.col("_parent"))
    return survivors


def _with_parents(refunds: DataFrame, transactions: DataFrame) -> DataFrame:
    kept = transactions.select("transaction_id", F.lit(True).alias("_kept"))
    return refunds.join(kept, "transaction_id", "left").withColumn("_parent", F.col("_kept").isNotNull())


def cleaning_stats(
    tables: Tables, orders: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """The counts of ``clean_and_count`` without the tables, for callers that write none."""
    orders = orders or {}
    frames = []
    for name, spec in TABLES.items():
        survivors = _survivors(tables[name], spec.key, orders.get(name, ()))
        if name == "refunds":
            kept = clean_transactions(tables["transactions"], orders.get("transactions", ()))
            survivors = _with_parents(survivors, kept)
        steps = _counted(name, survivors)
        totals = survivors.agg(*[
            F.coalesce(count, F.lit(0)).cast("bigint").alias(step) for step, count in steps.items()
        ])
        cells = ", ".join(f"'{name}', '{step}', {step}" for step in steps)
        frames.append(totals.select(F.expr(f"stack({len(steps)}, {cells}) AS (table_name, step, row_count)")))
    return union_all(frames)


def clean_and_count(
    tables: Tables,
    put: Callable[[str, DataFrame], DataFrame],
    orders: Mapping[str, Sequence[str]] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All nine tables cleaned and handed to ``put``, and the rows that each step dropped or filled.

    ``put`` writes a table and returns it read back.  The counts are observed while it writes, so
    each table is deduplicated once.  They are observed behind the last shuffle, in the
    tasks that write, whose repeats Spark counts once.
    """
    orders = orders or {}
    cleaned: dict[str, DataFrame] = {}

    def clean(name: str) -> list[tuple[str, str, int]]:
        survivors = _survivors(tables[name], TABLES[name].key, orders.get(name, ()))
        if name == "refunds":
            survivors = _with_parents(survivors, cleaned["transactions"])
        steps = _counted(name, survivors)
        seen = Observation(f"cleaning of {name}")
        watched = survivors.observe(seen, *[
            F.coalesce(count, F.lit(0)).cast("bigint").alias(step) for step, count in steps.items()
        ])
        columns = [c for c in tables[name].columns if c not in (UNREADABLE, SOURCE_ORDER)]
        cleaned[name] = put(name, _changed(name, watched).select(*columns))
        found = seen.get
        # nothing is observed of a table that Spark sees to be empty
        return [(name, step, int(found.get(step) or 0)) for step in steps]

    # tables do not wait for one another, but for refunds, which need their transactions
    with ThreadPoolExecutor(WRITERS) as pool:
        counts = list(pool.map(clean, [name for name in TABLES if name != "refunds"]))
    counts.append(clean("refunds"))
    rows = [row for part in counts for row in part]
    spark = tables["transactions"].sparkSession
    return (
        {name: cleaned[name] for name in TABLES},
        spark.createDataFrame(rows, "table_name string, step string, row_count bigint"),
    )
