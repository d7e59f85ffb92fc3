"""The eight source entities: columns, keys, casts and row rules. Data, not logic."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidemark.functions.commerce import STATE_NAMES
from tidemark.operators.quality import (
    Reference,
    Rule,
    between,
    in_domain,
    non_negative,
    not_null,
    null_or_positive,
    positive,
)

# The change envelope, its operations and the domains of coded columns.
OP = "OP"
COMMIT_TS = "AR_H_COMMIT_TIMESTAMP"
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
STATES = tuple(sorted(STATE_NAMES))
MISSPELLED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

ENVELOPE = T.StructType([T.StructField(OP, T.StringType()), T.StructField(COMMIT_TS, T.TimestampNTZType())])
DAY_PARTS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")])


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _columns(**types: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[ddl]) for name, ddl in types.items()])


@dataclass(frozen=True)
class Entity:
    name: str
    keys: tuple[str, ...]
    columns: T.StructType
    rules: tuple[Rule, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    partition_by: str | None = None
    #: Other entities that rows refer to; checked only where a run or a caller asks for it.
    references: tuple[Reference, ...] = ()

    @property
    def change_schema(self) -> T.StructType:
        """A change row: the entity's columns and the envelope."""
        return T.StructType(self.columns.fields + ENVELOPE.fields)

    @property
    def landing_schema(self) -> T.StructType:
        """A change row with the day folders it lies in."""
        return T.StructType(self.change_schema.fields + DAY_PARTS.fields)


_OF_ORDER = Reference("unknown_order", "order_id", "orders")

_ALL = (
    Entity(
        "customers",
        ("customer_id",),
        _columns(
            customer_id="string",
            customer_unique_id="string",
            customer_zip_code_prefix="bigint",
            customer_city="string",
            customer_state="string",
        ),
        (in_domain("customer_state", STATES, "invalid_state"),),
        partition_by="customer_state",
    ),
    Entity(
        "sellers",
        ("seller_id",),
        _columns(seller_id="string", seller_zip_code_prefix="bigint", seller_city="string", seller_state="string"),
        (in_domain("seller_state", STATES, "invalid_state"),),
        partition_by="seller_state",
    ),
    Entity(
        "products",
        ("product_id",),
        _columns(
            product_id="string",
            product_category_name="string",
            product_name_lenght="double",
            product_description_lenght="double",
            product_photos_qty="double",
            product_weight_g="double",
            product_length_cm="double",
            product_height_cm="double",
            product_width_cm="double",
        ),
        (
            null_or_positive("product_weight_g", "non_positive_weight"),
            null_or_positive("product_length_cm", "non_positive_length"),
            null_or_positive("product_height_cm", "non_positive_height"),
            null_or_positive("product_width_cm", "non_positive_width"),
        ),
        dict.fromkeys(
            (
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
            "double",
        ),
        partition_by="product_category_name",
    ),
    Entity(
        "product_category_name_translation",
        ("product_category_name",),
        _columns(product_category_name="string", product_category_name_english="string"),
    ),
    Entity(
        "orders",
        ("order_id",),
        _columns(
            order_id="string",
            customer_id="string",
            order_status="string",
            order_purchase_timestamp="timestamp_ntz",
            order_approved_at="timestamp_ntz",
            order_delivered_carrier_date="timestamp_ntz",
            order_delivered_customer_date="timestamp_ntz",
            order_estimated_delivery_date="timestamp_ntz",
        ),
        (
            in_domain("order_status", ORDER_STATUSES, "invalid_order_status"),
            not_null("order_purchase_timestamp", "null_purchase_timestamp"),
            not_null("customer_id", "null_customer_id"),
        ),
        dict.fromkeys(
            (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            "timestamp_ntz",
        ),
        partition_by="purchase_date",
    ),
    Entity(
        "order_items",
        ("order_id", "order_item_id"),
        _columns(
            order_id="string",
            order_item_id="int",
            product_id="string",
            seller_id="string",
            shipping_limit_date="timestamp_ntz",
            price="double",
            freight_value="double",
        ),
        (
            non_negative("price", "negative_price"),
            non_negative("freight_value", "negative_freight_value"),
            not_null("order_id", "null_order_id"),
            not_null("product_id", "null_product_id"),
            not_null("seller_id", "null_seller_id"),
        ),
        {
            "order_item_id": "int",
            "shipping_limit_date": "timestamp_ntz",
            "price": "double",
            "freight_value": "double",
        },
        references=(_OF_ORDER,),
    ),
    Entity(
        "payments",
        ("order_id", "payment_sequential"),
        _columns(
            order_id="string",
            payment_sequential="int",
            payment_type="string",
            payment_installments="int",
            payment_value="double",
        ),
        (
            in_domain("payment_type", PAYMENT_TYPES, "invalid_payment_type"),
            non_negative("payment_value", "negative_payment_value"),
            positive("payment_installments", "invalid_installments"),
        ),
        {"payment_sequential": "int", "payment_installments": "int", "payment_value": "double"},
        references=(_OF_ORDER,),
    ),
    Entity(
        "reviews",
        ("review_id", "order_id"),
        _columns(
            review_id="string",
            order_id="string",
            review_score="int",
            review_comment_title="string",
            review_comment_message="string",
            review_creation_date="date",
            review_answer_timestamp="timestamp_ntz",
        ),
        (between("review_score", 1, 5, "invalid_review_score"),),
        {"review_score": "int", "review_creation_date": "date", "review_answer_timestamp": "timestamp_ntz"},
        references=(_OF_ORDER,),
    ),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in _ALL}
