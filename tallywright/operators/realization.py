"""Revenue realization: from transaction value to cash, by billing cohort."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_label
from tallywright.functions.numeric import money, percent, zero
from tallywright.model import Tables
from tallywright.operators.billing import TOLERANCE
from tallywright.operators.ledger import (
    SUCCESS, counted_credits, settled_invoices, settlements, successful,
)

_MEASURES = (
    "gross_transaction_value", "expected_revenue", "billed_revenue", "invoiced_expected",
    "correctly_billed", "collected_revenue", "credited_amount",
)


def _measures(keys: list[Column], **given: Column) -> list[Column]:
    """All measures in order, 0 for those a source does not carry."""
    return [*keys, *[money(given.get(m, F.lit(0))).alias(m) for m in _MEASURES]]


def _invoiced() -> dict[str, Column]:
    expected, billed = F.col("expected_fee"), F.col("billed_fee")
    exact = F.abs(billed - expected) <= F.lit(TOLERANCE).cast("decimal(18,2)")
    return {
        "billed_revenue": zero(billed),
        "invoiced_expected": zero(expected),
        "correctly_billed": F.when(exact, expected).otherwise(F.lit(0)),
    }


def _traded(tables: Tables, keys: Callable[[str], list[Column]]) -> DataFrame:
    transactions = tables["transactions"].where(F.col("payment_status") == SUCCESS)
    return transactions.select(*_measures(
        keys("transaction_date"),
        gross_transaction_value=zero(F.col("transaction_amount")),
        expected_revenue=zero(F.col("expected_platform_fee")),
    ))


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in _MEASURES])


def _rates(totals: DataFrame, *keys: str) -> DataFrame:
    c = F.col
    return totals.select(
        *keys, "gross_transaction_value", "expected_revenue", "billed_revenue",
        "collected_revenue", "credited_amount",
        (c("billed_revenue") - c("collected_revenue") - c("credited_amount")).alias(
            "outstanding_revenue"
        ),
        percent(c("collected_revenue"), c("billed_revenue")).alias("realization_rate_percent"),
        percent(c("correctly_billed"), c("invoiced_expected")).alias("billing_accuracy_percent"),
    )


KEYS = {"month": "billing_period", "merchant": "merchant_id", "overall": "total"}


def revenue_realization(tables: Tables, grain: str) -> DataFrame:
    """``grain`` is ``month``, ``merchant`` or ``overall``.

    Cash and credits belong to the billing period of their invoice.  Amounts on
    no known invoice have no period or merchant; only the overall grain holds
    them.  All sources are tagged into one union and meet in one aggregate.
    """
    invoices, key = tables["invoices"], KEYS[grain]

    def keyed(date: str) -> list[Column]:
        if grain == "month":
            return [month_label(F.col(date)).alias(key)]
        return [F.col("merchant_id")] if grain == "merchant" else [F.lit("total").alias(key)]

    parts = [_traded(tables, keyed)]
    if grain == "overall":
        parts += [
            invoices.select(*_measures(keyed(""), **_invoiced())),
            successful(tables["payments"]).select(
                *_measures(keyed(""), collected_revenue=zero(F.col("payment_amount")))
            ),
            counted_credits(tables["credit_notes"]).select(
                *_measures(keyed(""), credited_amount=zero(F.col("credit_amount")))
            ),
        ]
    else:
        parts.append(
            settled_invoices(tables).select(*_measures(
                keyed("billing_period_start"),
                **_invoiced(),
                collected_revenue=F.col("total_paid"),
                credited_amount=F.col("total_credited"),
            ))
        )
    rows = reduce(DataFrame.unionByName, parts)
    return _rates(_summed(rows.where(F.col(key).isNotNull()), key).orderBy(key), key)


def realization_grains(tables: Tables) -> DataFrame:
    """All three grains (``grain``, ``billing_period``, ``merchant_id``) from one reading of the facts.

    The facts are summed by month and merchant, and grouping sets roll these sums up.  What
    is paid or credited on no known invoice has neither key: it is in the overall row alone.
    """
    def keyed(date: str) -> list[Column]:
        return [month_label(F.col(date)).alias("billing_period"), F.col("merchant_id")]

    nowhere = [F.lit(None).cast("string").alias("billing_period"), F.lit(None).cast(
        tables["invoices"].schema["merchant_id"].dataType
    ).alias("merchant_id")]
    # settled amounts meet their invoices; those without one stay, keyless
    settled = tables["invoices"].join(settlements(tables), "invoice_id", "full_outer").select(*_measures(
        keyed("billing_period_start"),
        **{name: zero(value) for name, value in _invoiced().items()},
        collected_revenue=zero(F.col("total_paid")),
        credited_amount=zero(F.col("total_credited")),
    ))
    homeless = F.col("invoice_id").isNull()
    parts = [
        _traded(tables, keyed), settled,
        successful(tables["payments"]).where(homeless).select(
            *_measures(nowhere, collected_revenue=zero(F.col("payment_amount")))
        ),
        counted_credits(tables["credit_notes"]).where(homeless).select(
            *_measures(nowhere, credited_amount=zero(F.col("credit_amount")))
        ),
    ]
    cells = _summed(reduce(DataFrame.unionByName, parts), "billing_period", "merchant_id")
    month, merchant = F.col("billing_period"), F.col("merchant_id")
    totals = cells.groupingSets([[month], [merchant], []], month, merchant).agg(
        *[F.sum(m).alias(m) for m in _MEASURES], F.grouping_id().alias("_grouping")
    )
    # the bits of the keys that a set leaves out
    grain = F.element_at(F.array(*map(F.lit, ("month", "merchant", "overall"))), F.col("_grouping").cast("int"))
    named = totals.withColumn("grain", grain)
    keyless = ((F.col("grain") == "month") & month.isNull()) | ((F.col("grain") == "merchant") & merchant.isNull())
    return _rates(named.where(~keyless), "grain", "billing_period", "merchant_id")


def realization_of(grains: DataFrame, grain: str) -> DataFrame:
    """One grain of ``realization_grains`` in the form of ``revenue_realization``."""
    key = KEYS[grain]
    rows = grains.where(F.col("grain") == grain)
    if grain == "overall":
        rows = rows.withColumn(key, F.lit("total"))
    spare = {"grain", "billing_period", "merchant_id"} - {key}
    return rows.select(key, *[c for c in grains.columns if c not in spare and c != key]).orderBy(key)


def funnel(overall: DataFrame) -> DataFrame:
    """The overall row turned into ordered funnel steps."""
    steps = (
        ("Gross Transaction Value", "gross_transaction_value"),
        ("Expected Revenue", "expected_revenue"),
        ("Billed Revenue", "billed_revenue"),
        ("Collected Revenue", "collected_revenue"),
    )
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("step"), F.lit(label).alias("stage"),
            F.col(column).cast("decimal(38,2)").alias("amount"),
        )
        for n, (label, column) in enumerate(steps, start=1)
    ])
    return overall.select(F.inline(rows))
