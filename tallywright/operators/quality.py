"""Data-quality checks, cross-table checks and model constraints.

Every check reduces to counts.  Row-wise checks of a table share one aggregate scan.
Repeated ids, repeated business rows and references of all tables share one pass over
keys: a table is read once for all of its keys, and one aggregate by (domain, key) counts
how often each key is an id and how often each reference names it.
"""

from __future__ import annotations

from collections.abc import Container, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions.dates import month_label
from tallywright.functions.numeric import count_where, money, round_dp, zero
from tallywright.model import (
    EARLIEST_DATE, LATEST_DATE, LOADED_REFERENCES, TABLES, UNREADABLE, Reference, Tables,
)
from tallywright.operators.ledger import (
    applied, not_void, paid_by_invoice, uninvoiced_months,
)
from tallywright.operators.reconciliation import repeated_payments

FINDING = "table_name string, check_name string, column_name string, violations bigint"


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name, paired as a tree: each frame is analysed log(n) times, not n."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[n:n + 2] for n in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]


def _counts(df: DataFrame, table: str, measures: list[tuple[str, str, Column]]) -> DataFrame:
    """Evaluate (check, column, count) measures of one table in one scan, a row for each."""
    return _count_rows(df, [(table, *m) for m in measures])


def _count_rows(df: DataFrame, measures: list[tuple[str, str, str, Column]]) -> DataFrame:
    names = [f"m{n}" for n in range(len(measures))]
    totals = df.agg(*[m[3].cast("bigint").alias(n) for n, m in zip(names, measures)])
    cells = ", ".join(
        f"'{table}', '{check}', {'CAST(NULL AS STRING)' if column is None else repr(column)}, {n}"
        for n, (table, check, column, _) in zip(names, measures)
    )
    columns = "table_name, check_name, column_name, violations"
    return totals.select(F.expr(f"stack({len(names)}, {cells}) AS ({columns})"))


def _as_date(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(column).cast("date")
    return F.col(column).try_cast("date")


# ---- single checks: each takes a frame and yields one count or several ----

def unreadable(df: DataFrame, column: str) -> Column:
    """Whether the source had text for this NULL cell that did not fit its type."""
    if UNREADABLE not in df.columns:
        return F.lit(False)
    return F.array_contains(UNREADABLE, column)


def missing_values(df: DataFrame, columns: Iterable[str]) -> list[tuple[str, str, Column]]:
    return [
        ("missing_values", c, count_where(F.col(c).isNull() & ~unreadable(df, c)))
        for c in columns if c in df.columns
    ]


def unreadable_values(df: DataFrame, dates: Iterable[str]) -> list[tuple[str, str, Column]]:
    """Cells of other kinds than dates that did not fit their type; only raw extracts have any."""
    if UNREADABLE not in df.columns:
        return []
    typed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return [("unreadable_values", c, count_where(unreadable(df, c))) for c in typed if c not in dates]


def invalid_dates(
    df: DataFrame, columns: Iterable[str], earliest: str, latest: str
) -> list[tuple[str, str, Column]]:
    """Present but unparsable, or outside the plausible range."""
    found = []
    for c in columns:
        if c in df.columns:
            parsed = _as_date(df, c)
            inside = parsed.between(F.lit(earliest).cast("date"), F.lit(latest).cast("date"))
            bad = (F.col(c).isNotNull() & ~F.coalesce(inside, F.lit(False))) | unreadable(df, c)
            found.append(("invalid_dates", c, count_where(bad)))
    return found


def date_order(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> list[tuple[str, str, Column]]:
    return [
        ("date_order", f"{later} < {earlier}",
         count_where(_as_date(df, later) < _as_date(df, earlier)))
        for earlier, later in pairs
        if earlier in df.columns and later in df.columns
    ]


def negative_amounts(df: DataFrame, columns: Iterable[str]) -> list[tuple[str, str, Column]]:
    return [
        ("negative_amounts", c, count_where(F.col(c) < 0)) for c in columns if c in df.columns
    ]


def out_of_range(
    df: DataFrame, ranges: Iterable[tuple[str, int, int]]
) -> list[tuple[str, str, Column]]:
    return [
        ("out_of_range", c, count_where((F.col(c) < low) | (F.col(c) > high)))
        for c, low, high in ranges
        if c in df.columns
    ]


def invalid_domain(
    df: DataFrame, domains: Mapping[str, Iterable]
) -> list[tuple[str, str, Column]]:
    return [
        ("invalid_domain", c, count_where(F.col(c).isNotNull() & ~F.col(c).isin(*allowed)))
        for c, allowed in domains.items()
        if c in df.columns
    ]


def repeated_key_rows(df: DataFrame, table: str, check: str, keys: Iterable[str]) -> DataFrame:
    """Rows that share their key with another row; all members count, NULL equals NULL."""
    keys = list(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    label = keys[0] if len(keys) == 1 else ", ".join(keys)
    rows = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return _counts(sizes, table, [(check, label, rows)])


def excess_key_rows(df: DataFrame, table: str, check: str, key: str) -> DataFrame:
    """Rows beyond the first of each key."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _counts(sizes, table, [(check, key, F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))])


class KeyPass:
    """One aggregate over all keys that checks ask for.

    A domain is a set of keys that are compared: the ids of a parent with all that refers to
    them, or the business rows of a table.  Every row of a table gives one (domain, slot, key) for
    each of its keys, slot 0 for ids; equal keys of a hot merchant collapse before the
    shuffle.  Keys are compared as text.
    """

    def __init__(self, tables: Tables):
        self._tables = tables
        self._domains: dict[tuple[str, str], int] = {}
        self._slots: dict[int, int] = {}
        self._cells: dict[str, list[Column]] = {}
        self._measures: list[tuple[str, str, str, Column]] = []

    def _cell(self, table: str, domain: int, slot: int, key: Column, nulls: bool) -> None:
        entry = F.struct(F.lit(domain).alias("_domain"), F.lit(slot).alias("_slot"), key.alias("_key"))
        self._cells.setdefault(table, []).append(entry if nulls else F.when(key.isNotNull(), entry))

    def _domain(self, table: str, label: str, key: Column) -> int:
        if (table, label) not in self._domains:
            domain = self._domains[table, label] = len(self._domains)
            self._slots[domain] = 1
            self._cell(table, domain, 0, key, nulls=True)
        return self._domains[table, label]

    def _ids(self, table: str, key: str) -> int:
        return self._domain(table, key, F.col(key).cast("string"))

    def _add(self, table: str, check: str, label: str, domain: int, counted: Column, rows: Column) -> None:
        here = (F.col("_domain") == domain) & counted
        self._measures.append((table, check, label, F.coalesce(F.sum(F.when(here, rows)), F.lit(0))))

    def repeated_ids(self, table: str, check: str, key: str) -> None:
        """Rows that share their id with another row; NULL equals NULL."""
        self._add(table, check, key, self._ids(table, key), F.col("_n0") > 1, F.col("_n0"))

    def excess_ids(self, table: str, check: str, key: str) -> None:
        """Rows beyond the first of each id."""
        self._add(table, check, key, self._ids(table, key), F.col("_n0") > 1, F.col("_n0") - 1)

    def repeated_rows(self, table: str, check: str, keys: Iterable[str]) -> None:
        """Rows that agree with another one in several columns."""
        label = ", ".join(keys)
        domain = self._domain(table, label, F.to_json(F.struct(*keys)))
        self._add(table, check, label, domain, F.col("_n0") > 1, F.col("_n0"))

    def unresolved(self, table: str, check: str, ref: Reference, nulls: bool = False) -> None:
        """Rows whose reference names no id of the parent; NULLs count only if asked for."""
        domain = self._ids(ref.parent, ref.parent_key)
        slot = self._slots[domain]
        self._slots[domain] += 1
        self._cell(table, domain, slot, F.col(ref.column).cast("string"), nulls)
        lost = (F.col("_n0") == 0) | F.col("_key").isNull()
        self._add(table, check, f"{ref.column} -> {ref.parent}.{ref.parent_key}", domain, lost, F.col(f"_n{slot}"))

    def counts(self) -> DataFrame:
        """A row for each check that was added."""
        if not self._measures:
            return next(iter(self._tables.values())).sparkSession.createDataFrame([], FINDING)
        keys = union_all(
            self._tables[table].select(F.explode(F.array_compact(F.array(*cells))).alias("_cell")).select("_cell.*")
            for table, cells in self._cells.items()
        )
        slots = range(max(self._slots.values()))
        sizes = keys.groupBy("_domain", "_key").agg(
            *[F.count_if(F.col("_slot") == slot).alias(f"_n{slot}") for slot in slots]
        )
        return _count_rows(sizes, self._measures)


def unresolved_references(
    tables: Tables,
    references: Iterable[tuple[str, Reference]],
    *,
    check: str = "unresolved_reference",
    null_counts: Container[tuple[str, str]] = (),
) -> DataFrame:
    """Rows per (table, reference) whose key is absent from the parent.

    NULL keys count only for the (table, column) pairs in ``null_counts``.
    """
    keys = KeyPass(tables)
    for table, ref in references:
        if ref.column in tables[table].columns and ref.parent in tables:
            keys.unresolved(table, check, ref, nulls=(table, ref.column) in null_counts)
    return keys.counts()


# ---- the checks over all tables ----

def _present_tables(tables: Tables) -> list[str]:
    return [name for name in TABLES if name in tables]


def _rowwise(tables: Tables, measures) -> DataFrame:
    """One scan per table for the measures a check finds in it."""
    frames = []
    for name in _present_tables(tables):
        found = measures(TABLES[name], tables[name])
        if found:
            frames.append(_counts(tables[name], name, found))
    return union_all(frames).where(F.col("violations") > 0)


def dq_missing(tables: Tables) -> DataFrame:
    return _rowwise(tables, lambda s, df: missing_values(df, s.required))


def dq_invalid_dates(
    tables: Tables, earliest: str = EARLIEST_DATE, latest: str = LATEST_DATE
) -> DataFrame:
    return _rowwise(tables, lambda s, df: invalid_dates(df, s.dates, earliest, latest))


def dq_date_order(tables: Tables) -> DataFrame:
    return _rowwise(tables, lambda s, df: date_order(df, s.ordered_dates))


def dq_negative(tables: Tables) -> DataFrame:
    return _rowwise(tables, lambda s, df: negative_amounts(df, s.non_negative))


def dq_range(tables: Tables) -> DataFrame:
    return _rowwise(tables, lambda s, df: out_of_range(df, s.ranges))


def dq_domain(tables: Tables) -> DataFrame:
    return _rowwise(tables, lambda s, df: invalid_domain(df, s.domains))


def dq_dup_ids(tables: Tables) -> DataFrame:
    return union_all(
        repeated_key_rows(tables[n], n, "duplicate_ids", [TABLES[n].key])
        for n in _present_tables(tables)
    )


def dq_dup_rows(tables: Tables) -> DataFrame:
    return union_all(
        repeated_key_rows(tables[n], n, "duplicate_business_rows", TABLES[n].business_key)
        for n in _present_tables(tables)
        if TABLES[n].business_key
    )


def _references(tables: Tables, names: Iterable[str]) -> list[tuple[str, Reference]]:
    return [(n, r) for n in names for r in TABLES[n].references]


def dq_referential(tables: Tables) -> DataFrame:
    found = unresolved_references(tables, _references(tables, _present_tables(tables)))
    return found.where(F.col("violations") > 0)


def findings(
    tables: Tables,
    names: Iterable[str] | None = None,
    earliest: str = EARLIEST_DATE,
    latest: str = LATEST_DATE,
) -> DataFrame:
    """All checks of the named tables (default: all present ones).

    Two scans a table: one aggregate of its rows, and its part of the pass over keys.
    """
    names = _present_tables(tables) if names is None else list(names)
    frames, keys = [], KeyPass(tables)
    for name in names:
        df, spec = tables[name], TABLES[name]
        frames.append(_counts(df, name, [
            ("rows", None, F.count(F.lit(1))),
            *missing_values(df, spec.required),
            *invalid_dates(df, spec.dates, earliest, latest),
            *unreadable_values(df, spec.dates),
            *date_order(df, spec.ordered_dates),
            *negative_amounts(df, spec.non_negative),
            *out_of_range(df, spec.ranges),
            *invalid_domain(df, spec.domains),
        ]))
        keys.repeated_ids(name, "duplicate_ids", spec.key)
        if spec.business_key:
            keys.repeated_rows(name, "duplicate_business_rows", spec.business_key)
        for ref in spec.references:
            if ref.column in df.columns and ref.parent in tables:
                keys.unresolved(name, "unresolved_reference", ref)
    frames.append(keys.counts())
    always = F.col("check_name").isin("rows", "duplicate_ids", "duplicate_business_rows")
    return union_all(frames).where(always | (F.col("violations") > 0))


def table_profile(tables: Tables) -> DataFrame:
    return union_all(
        tables[n].agg(
            F.lit(n).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(tables[n].columns)).alias("column_count"),
        )
        for n in _present_tables(tables)
    )


def dq_missing_cells(tables: Tables) -> DataFrame:
    """NULL cells per table and their share of all cells."""
    frames = []
    for n in _present_tables(tables):
        df = tables[n]
        nulls = reduce(Column.__add__, [count_where(F.col(c).isNull()) for c in df.columns])
        cells = F.count(F.lit(1)) * len(df.columns)
        share = F.try_divide(F.lit(100.0) * nulls.cast("double"), cells.cast("double"))
        frames.append(df.agg(
            F.lit(n).alias("table_name"),
            nulls.alias("missing_cells"),
            round_dp(share, 3).alias("missing_pct_of_cells"),
        ))
    return union_all(frames)


def dq_dup_pk_extra(tables: Tables) -> DataFrame:
    return union_all(
        excess_key_rows(tables[n], n, "duplicate_pk_rows", TABLES[n].key)
        for n in _present_tables(tables)
    )


def dq_fk_spot(tables: Tables) -> DataFrame:
    """Four spot checks; a NULL merchant or credited invoice counts, a NULL paid invoice not."""
    spots = (
        ("invoices", Reference("merchant_id", "merchants", "merchant_id")),
        ("payments", Reference("invoice_id", "invoices", "invoice_id")),
        ("transactions", Reference("merchant_id", "merchants", "merchant_id")),
        ("credit_notes", Reference("invoice_id", "invoices", "invoice_id")),
    )
    with_nulls = {(table, ref.column) for table, ref in spots if table != "payments"}
    return unresolved_references(tables, spots, check="orphaned_rows", null_counts=with_nulls)


def category_mix(tables: Tables) -> DataFrame:
    """Share of each value of the headline categories, and the invoice error rate."""
    categories = (
        ("merchants", "merchant_status"),
        ("merchants", "merchant_segment"),
        ("transactions", "payment_status"),
        ("invoices", "payment_status"),
        ("invoices", "invoice_error_flag"),
    )
    frames = []
    for table, column in categories:
        value = F.col(column).cast("string")
        counts = (
            tables[table].where(value.isNotNull())
            .groupBy(value.alias("value"))
            .agg(F.count(F.lit(1)).alias("value_count"))
            .select(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                "value", "value_count",
            )
        )
        frames.append(counts)
    # five short lists of labels: the grand totals are windows over those only
    total = F.sum("value_count").over(Window.partitionBy("table_name", "column_name"))
    share = F.col("value_count").cast("double") / total.cast("double")
    return union_all(frames).withColumn("value_share", round_dp(share, 3))


# ---- cross-table finance checks ----

def x_missing_invoices(tables: Tables) -> DataFrame:
    return uninvoiced_months(tables["transactions"], tables["invoices"]).select(
        "merchant_id", month_label(F.col("month")).alias("billing_period"), "transaction_count"
    )


def x_duplicate_payments(tables: Tables) -> DataFrame:
    """Successful payments sharing invoice and amount with another, all members."""
    payments = tables["payments"]
    repeated = repeated_payments(payments).select("invoice_id", "payment_amount")
    return applied(payments).join(repeated, ["invoice_id", "payment_amount"], "left_semi").select(
        "payment_id", "invoice_id", "merchant_id", "payment_date", "payment_amount"
    )


def x_unmatched_payments(tables: Tables) -> DataFrame:
    return (
        tables["payments"].where(F.col("invoice_id").isNotNull())
        .join(tables["invoices"].select("invoice_id"), "invoice_id", "left_anti")
        .select("payment_id", "invoice_id", "merchant_id", "payment_amount", "payment_status")
    )


def x_orphan_payments(tables: Tables) -> DataFrame:
    return tables["payments"].where(F.col("invoice_id").isNull()).select(
        "payment_id", "merchant_id", "payment_date", "payment_amount", "payment_status"
    )


def x_invoices_without_payment(tables: Tables) -> DataFrame:
    paid = applied(tables["payments"]).select("invoice_id").distinct()
    return not_void(tables["invoices"]).join(paid, "invoice_id", "left_anti").select(
        "invoice_id", "merchant_id", "invoice_date", "due_date", "total_invoice_amount"
    )


def x_amount_mismatches(tables: Tables, tolerance: int = 1) -> DataFrame:
    """Paid total off by more than the tolerance; Void and never-paid invoices take part."""
    paid = paid_by_invoice(tables["payments"]).select("invoice_id", "total_paid")
    return (
        tables["invoices"].join(paid, "invoice_id", "left")
        .withColumn("total_paid", zero(F.col("total_paid")))
        .withColumn("variance", money(F.col("total_paid") - F.col("total_invoice_amount")))
        .where(F.abs("variance") > tolerance)
        .select("invoice_id", "merchant_id", "total_invoice_amount", "total_paid", "variance")
    )


# ---- constraints of the loaded model ----

def constraint_violations(tables: Tables) -> DataFrame:
    """Breaches of primary keys, NOT NULL, checks and foreign keys; empty when sound."""
    frames, keys = [], KeyPass(tables)
    for name in _present_tables(tables):
        df, spec = tables[name], TABLES[name]
        keys.excess_ids(name, "primary_key", spec.key)
        for ref in LOADED_REFERENCES[name]:
            if ref.column in df.columns and ref.parent in tables:
                keys.unresolved(name, "foreign_key", ref)
        rules = [
            ("not_null", c, count_where(F.col(c).isNull()))
            for c in (spec.key, *spec.not_null) if c in df.columns
        ]
        rules += [
            ("non_negative", c, count_where(F.col(c) < 0))
            for c in spec.checked_non_negative if c in df.columns
        ]
        rules += [
            ("positive", c, count_where(F.col(c) <= 0))
            for c in spec.checked_positive if c in df.columns
        ]
        rules += [("domain", c, m) for _, c, m in invalid_domain(df, spec.checked_domains)]
        frames.append(_counts(df, name, rules))
    frames.append(keys.counts())
    return union_all(frames).where(F.col("violations") > 0)


def require_sound(tables: Tables) -> None:
    """Raise when any constraint is broken; the message lists the rules, never the rows."""
    broken = constraint_violations(tables).orderBy("table_name", "check_name", "column_name")
    found = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in broken.collect()]
    if found:
        raise ValueError("model constraints violated: " + "; ".join(found))
