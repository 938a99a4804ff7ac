"""Fixed values of the financial contract, and the Spark types of its six datasets.

System names and the contract version are product naming and can be changed here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CONTRACT_VERSION = "financial_contract_v1"
SHOP, PROVIDER = "shop", "provider"
CURRENCY = "EUR"
TIME_ZONE = "Europe/Berlin"
MANIFEST_SCHEMA_VERSION, FILE_SCHEMA_VERSION = 1, "1"
MONEY = T.DecimalType(18, 2)

# Contractual fee = fixed part + rate * amount.
FEE_SCHEDULE = {"CARD": ("0.20", "0.018"), "WALLET": ("0.25", "0.020")}

# Report type -> (entity, system, local hour of the next day at which it is due).
REPORTS = {
    "fees": ("FEE", PROVIDER, 12),
    "orders": ("ORDER", SHOP, 1),
    "payments": ("PAYMENT", PROVIDER, 2),
    "payouts": ("PAYOUT", PROVIDER, 12),
    "refunds": ("REFUND", PROVIDER, 2),
    "settlement_lines": ("SETTLEMENT_LINE", PROVIDER, 12),
}
REPORT_OF = {entity: report for report, (entity, _, _) in REPORTS.items()}
#: Reports that must be complete before a transaction or a payout can be judged.
TRANSACTION_REPORTS = ("orders", "payments", "refunds", "fees")
PAYOUT_REPORTS = ("payments", "refunds", "fees", "settlement_lines", "payouts")

# Closed sets.
ORDER_STATUS = ("PAYMENT_PENDING", "PAID", "CANCELLED")
PAYMENT_STATUS = ("FAILED", "CAPTURED")
REFUND_STATUS = ("FAILED", "SUCCEEDED")
PAYMENT_METHOD = ("CARD", "WALLET")
FEE_TYPE = ("PROCESSING",)
MOVEMENT_TYPE = ("CAPTURE", "REFUND", "FEE")
STATES = ("PENDING", "INCOMPLETE", "RECONCILED", "EXCEPTION")
DISPOSITIONS = ("ACCEPTED", "STALE", "DUPLICATE", "CONFLICTED", "QUARANTINED")

# Exception type -> the rule that finds it.
RULE_OF = {
    "ORPHAN_PAYMENT": "payment.order_exists",
    "CAPTURE_FOR_NON_PAYABLE_ORDER": "payment.order_is_payable",
    "ORPHAN_REFUND": "refund.captured_payment_exists",
    "REFUND_CURRENCY_MISMATCH": "refund.currency_matches_payment",
    "EXCESS_REFUND": "refund.total_within_capture",
    "MISSING_FEE": "fee.processing_fee_exists",
    "FEE_MISMATCH": "fee.amount_matches_schedule",
    "UNEXPECTED_FEE": "fee.belongs_to_capture",
    "MISSING_PAYMENT": "order.payment_exists",
    "PAYMENT_AMOUNT_MISMATCH": "order.collection_matches_total",
    "MULTIPLE_CAPTURE": "order.maximum_one_capture",
    "DUPLICATE_SETTLEMENT_MOVEMENT": "settlement.unique_movement_allocation",
    "MISSING_SETTLEMENT_LINE": "settlement.expected_movement_exists",
    "SETTLEMENT_LINE_AMOUNT_MISMATCH": "settlement.amount_matches_reported_source_movement",
    "PAYOUT_TOTAL_MISMATCH": "payout.header_matches_settlement_lines",
    "CONFLICTING_SOURCE_VERSION": "canonicalization.same_version_conflict",
}

# The keys of a report's manifest in its contract form.
MANIFEST_KEYS = "batch_id:text source_system:enum report_type:enum business_date:date schema_version:version generated_at_utc:ts row_count:count sha256:sha256"


@dataclass(frozen=True)
class Field:
    """A payload field: text, int, count (>= 0), version, sha256, ts, date, money (> 0), money0 (>= 0), signed, currency or enum."""

    name: str
    kind: str
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Entity:
    """An entity's fields in the order in which they are checked.

    ``first`` are checked before the others; ``dated`` (status value): the field
    ``available_on`` must be there with that status and must be absent otherwise.
    """

    name: str
    id_field: str
    fields: tuple[Field, ...]
    first: tuple[str, ...] = ()
    dated: str | None = None

    @property
    def system(self) -> str:
        return REPORTS[REPORT_OF[self.name]][1]


def _f(spec: str, **enums) -> tuple[Field, ...]:
    return tuple(Field(n, k, enums.get(n, ())) for n, k in (x.split(":") for x in spec.split()))


ENTITIES = {
    e.name: e
    for e in (
        Entity(
            "ORDER", "order_id",
            _f(
                "order_id:text created_at_utc:ts status:enum currency:currency order_total:money source_version:int",
                status=ORDER_STATUS
            )
        ),
        Entity(
            "PAYMENT", "payment_id",
            _f(
                "payment_id:text order_id:text attempt_number:int payment_method:enum status:enum amount:money currency:currency effective_at_utc:ts available_on:date source_version:int",
                payment_method=PAYMENT_METHOD, status=PAYMENT_STATUS
            ),
            ("status", "available_on"), "CAPTURED"
        ),
        Entity(
            "REFUND", "refund_id",
            _f(
                "refund_id:text payment_id:text status:enum amount:money currency:currency effective_at_utc:ts available_on:date source_version:int",
                status=REFUND_STATUS
            ),
            ("status", "available_on"), "SUCCEEDED"
        ),
        Entity(
            "FEE", "fee_id",
            _f(
                "fee_id:text payment_id:text fee_type:enum amount:money currency:currency effective_at_utc:ts available_on:date source_version:int",
                fee_type=FEE_TYPE
            )
        ),
        Entity(
            "SETTLEMENT_LINE", "settlement_line_id",
            _f(
                "settlement_line_id:text payout_id:text movement_type:enum movement_id:text signed_amount:signed currency:currency source_version:int",
                movement_type=MOVEMENT_TYPE
            ),
            ("movement_type", "signed_amount")
        ),
        Entity(
            "PAYOUT", "payout_id",
            _f("payout_id:text payout_date:date currency:currency reported_net_amount:money0 source_version:int")
        ),
    )
}
_TYPES = {
    "text": T.StringType(), "int": T.LongType(), "ts": T.TimestampType(), "date": T.DateType(), "money": MONEY,
    "money0": MONEY, "signed": MONEY, "currency": T.StringType(), "enum": T.StringType()
}


def record_type(entity: str) -> T.StructType:
    """The validated record of an entity; ``attempt_number`` is an int, other whole numbers are long."""
    return T.StructType(
        [T.StructField(f.name, T.IntegerType() if f.name == "attempt_number" else _TYPES[f.kind]) for f in ENTITIES[entity].fields]
    )


#: The contract form of a manifest; its version and checksum are looked at first.
MANIFEST = Entity(
    "MANIFEST", "batch_id", _f(MANIFEST_KEYS, source_system=(PROVIDER, SHOP), report_type=tuple(REPORTS)),
    ("schema_version", "sha256")
)
