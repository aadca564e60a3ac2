"""The nine-table finance model: types, keys, domains and quality rules.

Money is DECIMAL(18,2) so that sums do not depend on partitioning; rates are
DECIMAL(9,4).  Identifiers are declared STRING for files, but no operator
relies on that: any orderable key type works.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Tables = Mapping[str, DataFrame]

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableSpec:
    """What one table looks like and what must hold for its rows."""

    columns: str  # DDL, types as loaded
    key: str
    # quality checks on raw input
    required: tuple[str, ...]
    dates: tuple[str, ...]
    non_negative: tuple[str, ...] = ()
    ordered_dates: tuple[tuple[str, str], ...] = ()
    ranges: tuple[tuple[str, int, int], ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    business_key: tuple[str, ...] = ()
    # constraints of the loaded model
    not_null: tuple[str, ...] = ()
    checked_non_negative: tuple[str, ...] = ()
    checked_positive: tuple[str, ...] = ()
    checked_domains: dict[str, tuple[object, ...]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# Columns that reading a raw extract adds: names of cells that did not fit their type, and the
# row's place in the source.
UNREADABLE = "_unreadable"
SOURCE_ORDER = "_source_order"

# Label domains of the finance model.
SEGMENTS = ("Enterprise", "Mid-Market", "SMB", "Long-tail")
MERCHANT_STATUSES = ("Active", "Churned", "Suspended")
CONTRACT_STATUSES = ("Active", "Superseded", "Terminated")
RAW_TRANSACTION_STATUSES = ("Success", "Failed", "Pending")
TRANSACTION_STATUSES = ("Success", "Failed", "Pending", "Unknown")
ORDER_STATUSES = ("Delivered", "Cancelled", "Returned", "Processing")
INVOICE_STATUSES = ("Draft", "Issued", "Paid", "Overdue", "Void")
INVOICE_PAYMENT_STATUSES = ("Unpaid", "Partially Paid", "Paid")
PAYMENT_STATUSES = ("Success", "Failed", "Pending")
REFUND_STATUSES = ("Processed", "Pending", "Rejected")
CREDIT_NOTE_STATUSES = ("Issued", "Applied", "Pending")
ACTIVITY_TYPES = (
    "Email", "Phone", "Reminder", "Escalation", "Payment Promise", "Dispute", "Resolution",
)
RESOLUTION_STATUSES = ("Open", "Resolved", "Rejected", "Escalated")

# Plausible date range and fee-rate range of raw input.
EARLIEST_DATE = "2020-01-01"
LATEST_DATE = "2027-12-31"
FEE_RATE_RANGE = (0, 15)

_MERCHANT = Reference("merchant_id", "merchants", "merchant_id")
_INVOICE = Reference("invoice_id", "invoices", "invoice_id")
_TRANSACTION = Reference("transaction_id", "transactions", "transaction_id")

# Parents come before children: this is also the load order.
TABLES: dict[str, TableSpec] = {
    "merchants": TableSpec(
        columns=(
            "merchant_id string, merchant_name string, industry string, merchant_segment string, "
            "city string, state string, country string, onboarding_date date, "
            "account_manager string, pricing_plan string, contract_start_date date, "
            f"contract_end_date date, agreed_fee_percent {RATE}, "
            f"monthly_subscription_fee {MONEY}, payment_terms_days int, merchant_status string"
        ),
        key="merchant_id",
        required=(
            "merchant_id", "merchant_name", "onboarding_date", "merchant_status",
            "agreed_fee_percent",
        ),
        dates=("onboarding_date", "contract_start_date"),
        non_negative=("agreed_fee_percent", "monthly_subscription_fee", "payment_terms_days"),
        ranges=(("agreed_fee_percent", *FEE_RATE_RANGE),),
        domains={"merchant_segment": SEGMENTS, "merchant_status": MERCHANT_STATUSES},
        not_null=(
            "merchant_name", "industry", "merchant_segment", "onboarding_date",
            "agreed_fee_percent", "payment_terms_days", "merchant_status",
        ),
        checked_non_negative=("agreed_fee_percent",),
        checked_positive=("payment_terms_days",),
        checked_domains={"merchant_segment": SEGMENTS, "merchant_status": MERCHANT_STATUSES},
    ),
    "contracts": TableSpec(
        columns=(
            "contract_id string, merchant_id string, effective_from date, effective_to date, "
            f"pricing_plan string, transaction_fee_percent {RATE}, "
            f"fixed_transaction_fee {MONEY}, subscription_fee {MONEY}, payment_terms_days int, "
            f"discount_percent {RATE}, minimum_monthly_fee {MONEY}, contract_status string"
        ),
        key="contract_id",
        required=("contract_id", "merchant_id", "effective_from", "transaction_fee_percent"),
        dates=("effective_from",),
        ordered_dates=(("effective_from", "effective_to"),),
        non_negative=(
            "fixed_transaction_fee", "subscription_fee", "minimum_monthly_fee", "discount_percent",
        ),
        ranges=(("transaction_fee_percent", *FEE_RATE_RANGE),),
        domains={"contract_status": CONTRACT_STATUSES},
        references=(_MERCHANT,),
        not_null=(
            "merchant_id", "effective_from", "transaction_fee_percent", "payment_terms_days",
            "contract_status",
        ),
        checked_non_negative=("transaction_fee_percent",),
        checked_positive=("payment_terms_days",),
        checked_domains={"contract_status": CONTRACT_STATUSES},
    ),
    "transactions": TableSpec(
        columns=(
            "transaction_id string, merchant_id string, transaction_date date, order_id string, "
            f"transaction_amount {MONEY}, transaction_fee_percent {RATE}, "
            f"expected_platform_fee {MONEY}, payment_method string, payment_status string, "
            f"order_status string, refund_amount {MONEY}, discount_amount {MONEY}, "
            "currency string, created_timestamp timestamp_ntz"
        ),
        key="transaction_id",
        required=(
            "transaction_id", "merchant_id", "transaction_date", "transaction_amount",
            "payment_status",
        ),
        dates=("transaction_date",),
        non_negative=(
            "transaction_amount", "refund_amount", "discount_amount", "expected_platform_fee",
        ),
        ranges=(("transaction_fee_percent", *FEE_RATE_RANGE),),
        domains={"payment_status": RAW_TRANSACTION_STATUSES, "order_status": ORDER_STATUSES},
        references=(_MERCHANT,),
        business_key=("merchant_id", "order_id", "transaction_date", "transaction_amount"),
        not_null=("merchant_id", "transaction_date", "transaction_amount", "payment_status"),
        checked_non_negative=("transaction_amount",),
        checked_domains={"payment_status": TRANSACTION_STATUSES},
    ),
    "invoices": TableSpec(
        columns=(
            "invoice_id string, merchant_id string, billing_period_start date, "
            f"billing_period_end date, invoice_date date, due_date date, subtotal {MONEY}, "
            f"discount {MONEY}, taxable_amount {MONEY}, tax_rate {RATE}, tax_amount {MONEY}, "
            f"total_invoice_amount {MONEY}, currency string, invoice_status string, "
            f"payment_status string, expected_fee {MONEY}, billed_fee {MONEY}, "
            "invoice_error_flag int"
        ),
        key="invoice_id",
        required=("invoice_id", "merchant_id", "invoice_date", "due_date", "total_invoice_amount"),
        dates=("invoice_date", "due_date"),
        ordered_dates=(("invoice_date", "due_date"),),
        non_negative=("subtotal", "tax_amount", "total_invoice_amount"),
        domains={"invoice_status": INVOICE_STATUSES, "payment_status": INVOICE_PAYMENT_STATUSES},
        references=(_MERCHANT,),
        not_null=(
            "merchant_id", "billing_period_start", "billing_period_end", "invoice_date",
            "due_date", "total_invoice_amount", "invoice_status", "payment_status",
            "invoice_error_flag",
        ),
        checked_domains={
            "invoice_status": INVOICE_STATUSES,
            "payment_status": INVOICE_PAYMENT_STATUSES,
            "invoice_error_flag": (0, 1),
        },
    ),
    "payments": TableSpec(
        columns=(
            "payment_id string, invoice_id string, merchant_id string, payment_date date, "
            f"payment_amount {MONEY}, payment_method string, payment_reference string, "
            "payment_status string, bank_reference string, settlement_date date"
        ),
        key="payment_id",
        required=("payment_id", "payment_date", "payment_amount", "payment_status"),
        dates=("payment_date",),
        non_negative=("payment_amount",),
        domains={"payment_status": PAYMENT_STATUSES},
        references=(_MERCHANT,),
        not_null=("merchant_id", "payment_date", "payment_amount", "payment_status"),
        checked_non_negative=("payment_amount",),
        checked_domains={"payment_status": PAYMENT_STATUSES},
    ),
    "refunds": TableSpec(
        columns=(
            "refund_id string, transaction_id string, merchant_id string, refund_date date, "
            f"refund_amount {MONEY}, refund_reason string, refund_status string"
        ),
        key="refund_id",
        required=("refund_id", "transaction_id", "merchant_id", "refund_amount"),
        dates=("refund_date",),
        non_negative=("refund_amount",),
        domains={"refund_status": REFUND_STATUSES},
        references=(_TRANSACTION, _MERCHANT),
        not_null=("transaction_id", "merchant_id", "refund_date", "refund_amount"),
        checked_non_negative=("refund_amount",),
        checked_domains={"refund_status": REFUND_STATUSES},
    ),
    "credit_notes": TableSpec(
        columns=(
            "credit_note_id string, invoice_id string, merchant_id string, "
            f"credit_note_date date, credit_amount {MONEY}, reason string, status string"
        ),
        key="credit_note_id",
        required=("credit_note_id", "invoice_id", "credit_amount"),
        dates=("credit_note_date",),
        non_negative=("credit_amount",),
        domains={"status": CREDIT_NOTE_STATUSES},
        references=(_INVOICE, _MERCHANT),
        not_null=("invoice_id", "merchant_id", "credit_note_date", "credit_amount"),
        checked_non_negative=("credit_amount",),
        checked_domains={"status": CREDIT_NOTE_STATUSES},
    ),
    "collection_activity": TableSpec(
        columns=(
            "collection_id string, merchant_id string, invoice_id string, activity_date date, "
            "activity_type string, contact_channel string, collector string, outcome string, "
            f"promised_payment_date date, promised_amount {MONEY}, notes string"
        ),
        key="collection_id",
        required=("collection_id", "merchant_id", "activity_date", "activity_type"),
        dates=("activity_date",),
        domains={"activity_type": ACTIVITY_TYPES},
        references=(_MERCHANT, _INVOICE),
        not_null=("merchant_id", "activity_date", "activity_type"),
        checked_domains={"activity_type": ACTIVITY_TYPES},
    ),
    "disputes": TableSpec(
        columns=(
            "dispute_id string, merchant_id string, invoice_id string, dispute_date date, "
            f"dispute_type string, disputed_amount {MONEY}, resolution_status string, "
            f"resolution_date date, resolution_amount {MONEY}"
        ),
        key="dispute_id",
        required=("dispute_id", "merchant_id", "invoice_id", "disputed_amount"),
        dates=("dispute_date",),
        non_negative=("disputed_amount",),
        domains={"resolution_status": RESOLUTION_STATUSES},
        references=(_MERCHANT, _INVOICE),
        not_null=("merchant_id", "invoice_id", "dispute_date"),
        checked_non_negative=("disputed_amount",),
        checked_domains={"resolution_status": RESOLUTION_STATUSES},
    ),
}

# Foreign keys enforced after load; payments may lack an invoice but a given one must exist.
LOADED_REFERENCES: dict[str, tuple[Reference, ...]] = {
    **{name: spec.references for name, spec in TABLES.items()},
    "payments": (_INVOICE, _MERCHANT),
}
