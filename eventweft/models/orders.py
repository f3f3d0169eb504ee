"""A model over order events: the worked example, and what the checks run on."""

from __future__ import annotations

from dataclasses import replace

from eventweft.functions.text import abbreviate_name, normalise_code
from eventweft.spec import Column, Entity, ForeignKey, Link, Model, Reject, Source

STATUS_LABELS = {"o": "Open", "f": "Fulfilled", "p": "Pending"}

ALIASES = {"orderModify": "orderCreate"}

CUSTOMER = Entity(
    "customer",
    (
        Column("custKey", "bigint", True),
        Column("name", required=True),
        Column("segment"),
        Column("vip", "boolean"),
        Column("nation_name"),
    ),
    key=("custKey", "name", "segment"),
    sources=(
        Source(
            "orderCreate",
            "order.customer",
            {
                "custKey": "order.customer.custKey",
                "name": "order.customer.name",
                "segment": "order.customer.segment",
                "vip": "order.customer.vip",
                "nation_name": "order.customer.nation.name",
            },
        ),
        Source(
            "orderCancel",
            "cancellation.customer",
            {"custKey": "cancellation.customer.custKey", "name": "cancellation.customer.name"},
        ),
    ),
    rejects=(Reject("name", "007"),),
)

PURCHASE = Entity(
    "purchase",
    (
        Column("eventInfo_name"),
        Column("orderKey", "bigint", True),
        Column("customer_id", required=True),
        Column("placed_date", "date"),
        Column("placed_priority"),
        Column("total", "decimal(12,2)"),
        Column("reason"),
    ),
    key=("orderKey", "customer_id", "eventInfo_name", "placed_date", "total"),
    sources=(
        Source(
            "orderCreate",
            "",
            {
                "eventInfo_name": "eventInfo.name",
                "orderKey": "order.orderKey",
                "placed_date": "order.placed.date",
                "placed_priority": "order.placed.priority",
                "total": "order.total",
            },
        ),
        Source(
            "orderCancel",
            "",
            {
                "eventInfo_name": "eventInfo.name",
                "orderKey": "cancellation.order.orderKey",
                "reason": "cancellation.reason",
            },
        ),
    ),
)

ITEM = Entity(
    "item",
    (
        Column("orderKey", "bigint", True),
        Column("line", "int", True),
        Column("partKey", "bigint", True),
        Column("suppKey", "bigint"),
        Column("qty", "int"),
        Column("price", "decimal(12,2)", True),
        Column("ship_date", "date"),
        Column("return_flag"),
    ),
    key=("orderKey", "line", "partKey", "suppKey", "qty", "price"),
    sources=(
        Source(
            "orderCreate",
            "order.items[]",
            {
                "orderKey": "order.orderKey",
                "line": "order.items[].line",
                "partKey": "order.items[].partKey",
                "suppKey": "order.items[].suppKey",
                "qty": "order.items[].qty",
                "price": "order.items[].price",
                "ship_date": "order.items[].ship.date",
                "return_flag": "order.items[].ship.flags[0]",
            },
        ),
    ),
)

CHARGE = Entity(
    "charge",
    (Column("kind", required=True), Column("amount", "decimal(5,2)", True)),
    key=("kind", "amount"),
    sources=(
        Source(
            "orderCreate",
            "order.items[].charges[]",
            {"kind": "order.items[].charges[].kind", "amount": "order.items[].charges[].amount"},
        ),
    ),
)

REFERENCE = Entity(
    "reference",
    (Column("number", required=True), Column("source", required=True)),
    key=("number", "source"),
    sources=(
        Source("orderCreate", "order.refs[]", {"number": "order.refs[].number", "source": "order.refs[].source"}),
    ),
)

STATUS = Entity(
    "statusChange",
    (Column("orderKey", "bigint", True), Column("code", required=True), Column("at", "timestamp", True)),
    key=("orderKey", "at", "code"),
    sources=(
        Source(
            "orderCreate",
            "order.statuses[]",
            {"orderKey": "order.orderKey", "code": "order.statuses[].code", "at": "order.statuses[].at"},
        ),
        Source(
            "orderCancel",
            "cancellation.status",
            {
                "orderKey": "cancellation.order.orderKey",
                "code": "cancellation.status.code",
                "at": "cancellation.status.at",
            },
        ),
    ),
    time_column="at",
    derived={"code": ("code", lambda c: normalise_code(c, STATUS_LABELS))},
)

PRODUCT = Entity(
    "product",
    (
        Column("partKey", "bigint", True),
        Column("name", required=True),
        Column("name_abbrev"),
        Column("size", "int"),
        Column("retail", "decimal(12,2)"),
    ),
    key=("partKey", "name"),
    sources=(
        Source(
            "partUpdate",
            "part",
            {"partKey": "part.partKey", "name": "part.name", "size": "part.size", "retail": "part.retail"},
        ),
    ),
    derived={"name_abbrev": ("name", abbreviate_name)},
)

ORDERS = Model(
    entities=(CUSTOMER, REFERENCE, STATUS, ITEM, CHARGE, PRODUCT, PURCHASE),
    foreign_keys=(ForeignKey("purchase", "customer", "customer_id"),),
    links=(
        Link("purchaseItemLink", "purchase", "item", "purchase_id", "item_id"),
        Link("purchaseReferenceLink", "purchase", "reference", "purchase_id", "reference_id"),
        Link("purchaseStatusLink", "purchase", "statusChange", "purchase_id", "status_id"),
        Link("itemChargeLink", "item", "charge", "item_id", "charge_id", scope="path"),
    ),
    aliases=ALIASES,
)

ORDERS_CASCADING = replace(ORDERS, cascade=True)
