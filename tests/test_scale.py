"""Results that must not depend on partitioning or on how keys are spread, and plan shapes."""

from __future__ import annotations

import datetime as dt
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.functions.relational import as_of_value, keep_first, number_rows, salted_lookup
from tallywright.operators import adhoc, billing, receivables, reconciliation, star
from tallywright.plans.catalog import RESULTS
from tallywright.sources import binding
from tallywright.sources.binding import BoundModel
from tallywright.sources.storage import names_in
from tests.conftest import COLLECTIONS_AS_OF, frame

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "ar_aging", "collection_queue", "leakage_table", "recon_payments", "payment_behavior",
    "cleaning_stats", "realization_merchant", "stratified_sample", "sql_15",
)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_result_with_1_and_16_partitions(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            model = BoundModel(spark, FOLDER, f"partitions-{partitions}-{name}")
            results.append(sorted(map(repr, RESULTS[name](model).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the payments repeat one amount on one invoice, a third name no invoice."""
    rng = random.Random(7)
    rows = []
    for n in range(9000):
        if n % 3 == 0:
            invoice, amount = "hot", 10
        elif n % 3 == 1:
            invoice, amount = None, 10
        else:
            invoice, amount = f"i{rng.randrange(900)}", rng.randrange(1, 4)
        status = "Failed" if rng.random() < 0.1 else "Success"
        settled = "2026-01-01" if rng.random() < 0.05 else "2026-02-02"
        rows.append((f"p{n:05d}", invoice, "m", "2026-02-01", amount, status, settled))
    invoices = [(f"i{n}", "m", 4, "Issued") for n in range(0, 900, 2)] + [("hot", "m", 50, "Issued")]
    payments = frame(
        spark, "payments",
        "payment_id invoice_id merchant_id payment_date payment_amount payment_status settlement_date",
        rows,
    )
    table = frame(
        spark, "invoices", "invoice_id merchant_id total_invoice_amount invoice_status", invoices
    )
    return rows, {i[0] for i in invoices}, {"payments": payments, "invoices": table}


def test_payment_status_by_brute_force(skewed):
    rows, known, tables = skewed
    same = Counter((r[1], r[4]) for r in rows if r[5] == "Success")

    def status(r):
        if r[5] != "Success":
            return "NOT_APPLICABLE_FAILED"
        if r[1] is None:
            return "ORPHAN"
        if r[1] not in known:
            return "UNMATCHED"
        if same[r[1], r[4]] > 1:
            return "DUPLICATE"
        return "TIMING_MISMATCH" if r[6] < r[3] else "MATCHED"

    got = {r.payment_id: r.reconciliation_status for r in reconciliation.reconcile_payments(tables).collect()}
    assert got == {r[0]: status(r) for r in rows}


def test_repeated_payments_are_one_row_each(skewed):
    rows, _, tables = skewed
    want = defaultdict(list)
    for r in rows:
        if r[5] == "Success" and r[1] is not None:
            want[r[1], r[4]].append(r[0])
    want = {k: sorted(v) for k, v in want.items() if len(v) > 1}
    got = defaultdict(list)
    for r in adhoc.duplicate_payments(tables).collect():
        got[r.invoice_id, int(r.payment_amount)].append(r.payment_id)
        assert r.payment_count == len(want[r.invoice_id, int(r.payment_amount)])
    assert {k: sorted(v) for k, v in got.items()} == want


def test_numbering_is_dense_and_ordered(spark):
    values = [(random.Random(n).randrange(50), n) for n in range(2000)]
    df = spark.createDataFrame(values, "a int, b int")
    rows = number_rows(df, "n", [F.desc("a"), F.asc("b")]).collect()
    want = sorted(values, key=lambda v: (-v[0], v[1]))
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.n)] == want
    assert sorted(r.n for r in rows) == list(range(1, 2001))


def test_numbering_an_empty_frame(spark):
    assert number_rows(spark.createDataFrame([], "a int"), "n", [F.asc("a")]).count() == 0


def test_as_of_value_by_brute_force(spark):
    rng = random.Random(3)
    start = dt.date(2026, 1, 1)
    history = [
        (f"k{rng.randrange(4)}", start + dt.timedelta(days=rng.randrange(90)), rng.randrange(100))
        for _ in range(40)
    ]
    # one key holds most facts; some keys have no history
    facts = [
        (n, "k0" if n % 2 else f"k{rng.randrange(6)}", start + dt.timedelta(days=rng.randrange(120)))
        for n in range(600)
    ]
    got = as_of_value(
        spark.createDataFrame(facts, "id int, key string, day date"),
        spark.createDataFrame(history, "key string, since date, value int"),
        key="key", fact_date="day", history_date="since", values=["value"],
    ).collect()

    def expected(key, day):
        known = [(h[1], -h[2]) for h in history if h[0] == key and h[1] <= day]
        return -max(known)[1] if known else None

    assert {r.id: r.value for r in got} == {n: expected(k, d) for n, k, d in facts}


def test_keep_first_counts_copies(spark):
    rows = [(1, 5, "x"), (1, 3, "y"), (1, 3, "a"), (2, None, "z"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "id int, ord int, v string")
    got = {r.id: (r.ord, r.v, r._copies) for r in keep_first(df, "id", ["ord"]).collect()}
    assert got == {1: (3, "a", 3), 2: (None, "z", 1), None: (1, "n", 2)}


def test_salted_lookup_of_a_hot_key(spark):
    rows = [(n, "hot" if n % 3 == 0 else None if n % 3 == 1 else f"k{n % 7}") for n in range(3000)]
    facts = spark.createDataFrame(rows, "id int, key string")
    names = {"hot": "H", "k0": "A", "k1": "A", "k2": "B", "unused": "U"}
    dimension = spark.createDataFrame(list(names.items()), "key string, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = salted_lookup(facts, dimension, "key", "id", salts=8)
        # every row once, and the hot key's rows in several tasks
        assert Counter((r.id, r.key, r.name) for r in got.collect()) == Counter(
            (n, k, names[k]) for n, k in rows if k in names
        )
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tasks = got.where("key = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_industries_are_looked_up_by_salted_merchants(plans):
    assert "hashpartitioning(merchant_id" in plans("sql_28") and "_salt" in plans("sql_28")


def test_repeated_dimension_rows_are_not_broadcast(spark):
    facts = spark.createDataFrame([(n, n % 3) for n in range(9)], "id int, key int")
    dimension = spark.createDataFrame([(0, "a"), (1, "b")], "key int, name string")
    got = salted_lookup(facts, dimension, "key", "id")
    # small enough to be broadcast by Spark's own estimate, which does not see the repetition
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.name) for r in got.collect()) == [
        (n, "ab"[n % 3]) for n in range(9) if n % 3 < 2
    ]


def test_a_row_per_merchant_is_not_broadcast(spark, controls, small):
    # all so small that Spark would broadcast them by its own estimate, which is low at any size
    frames = (
        star.fact_invoices(controls), billing.billing_merchant_month(controls),
        receivables.ar_aging(small, COLLECTIONS_AS_OF),
        binding._billed_months(BoundModel(spark, FOLDER, "months")),
    )
    for got in frames:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin \[merchant_id#\d+L?\], \[merchant_id#\d+L?\]", plan)
        assert not re.search(r"BroadcastHashJoin \[merchant_id#\d+L?\], \[merchant_id#\d+L?\]", plan)


def test_line_items_are_derived_once_for_an_export(spark, monkeypatch):
    class Bound(Exception):
        pass

    def bound(*args):
        raise Bound

    def counted(model, derive=binding._lines):
        made.append(model)
        return derive(model)

    made = []
    monkeypatch.setattr(binding, "_lines", counted)
    monkeypatch.setitem(binding._BASES, "lines", counted)
    monkeypatch.setattr(star, "star", bound)
    with pytest.raises(Bound):
        RESULTS["export_star"](BoundModel(spark, FOLDER, "lines-once"))
    assert len(made) == 1


@pytest.fixture(scope="module")
def plans(spark):
    """Plans with broadcasting off, as for tables that are all large."""
    model = BoundModel(spark, FOLDER, "plans")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def plan(name):
        return RESULTS[name](model)._jdf.queryExecution().executedPlan().toString()

    yield plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


PURE = sorted(set(RESULTS) - {"scan_csv", "write_csv", "write_json_summary", "load_model", "export_star"})


@pytest.mark.parametrize("name", PURE)
def test_no_pairwise_join_and_no_python(plans, name):
    text = plans(name)
    for bad in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark, capsys):
    RESULTS["leakage_rate_discrepancy"](BoundModel(spark, FOLDER, "scan")).explain("formatted")
    [scan] = [p for p in capsys.readouterr().out.split("\n\n") if "ReadSchema" in p]
    assert "EqualTo(payment_status,Success)" in scan
    assert "refund_amount" not in scan.split("ReadSchema")[1]


def test_only_what_takes_a_shuffle_is_written(spark):
    model = BoundModel(spark, FOLDER, "written")
    # neither line items nor payments, which follow from invoices row by row
    RESULTS["x_unmatched_payments"](model).collect()
    assert set(names_in(spark, model._root)) == {"merchants", "billed_months"}
    RESULTS["billing_missing_months"](model).collect()
    assert set(names_in(spark, model._root)) == {"merchants", "billed_months", "lines"}


def test_sample_limits_groups_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans("stratified_sample")


def test_settlements_share_one_shuffle(plans):
    assert plans("open_balance").count("Exchange hashpartitioning") == 2


def test_money_is_exact(spark):
    rows = [("i", Decimal("0.10")) for _ in range(1000)]
    df = spark.createDataFrame(rows, "invoice_id string, payment_amount decimal(18,2)")
    assert df.agg(F.sum("payment_amount")).first()[0] == Decimal("100.00")
