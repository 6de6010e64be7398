"""Declared schemas and keys: the only source of column names, order and types."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(14, 2)
# Type of a summed amount: wide enough for any number of rows in one order.
AMOUNT_SUM = T.DecimalType(24, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


OUTLET_MASTER = _schema(
    outlet_id=T.IntegerType(),
    outlet_name=T.StringType(),
    city=T.StringType(),
    region_tier=T.StringType(),
    created_at=T.TimestampType(),
    updated_at=T.TimestampType(),
)

MENU_MASTER = _schema(
    menu_id=T.LongType(),
    menu_name=T.StringType(),
    category=T.StringType(),
    base_price=PRICE,
    price_tier_1=PRICE,
    price_tier_2=PRICE,
    price_tier_3=PRICE,
    is_promo_active=T.StringType(),
    updated_at=T.TimestampType(),
)

ORDERS = _schema(
    order_id=T.LongType(),
    outlet_id=T.IntegerType(),
    cashier_id=T.IntegerType(),
    total_amount=AMOUNT,
    payment_method=T.StringType(),
    created_at=T.TimestampType(),
)

ORDER_ITEMS = _schema(
    item_id=T.LongType(),
    order_id=T.LongType(),
    menu_id=T.LongType(),
    quantity=T.IntegerType(),
    price_per_item=PRICE,
    subtotal=AMOUNT,
)

MASTERS = {"menu_master": MENU_MASTER, "outlet_master": OUTLET_MASTER}
TRANSACTIONS = {"orders": ORDERS, "order_items": ORDER_ITEMS}
TABLES = {**MASTERS, **TRANSACTIONS}

DAY_FIELDS = _schema(year=T.StringType(), month=T.StringType(), day=T.StringType())

SILVER_ORDERS = T.StructType(ORDERS.fields + [T.StructField("data_quality_status", T.StringType(), True)])

MALFORMED_LINE = T.StructField("malformed_line", T.StringType(), True)

MALFORMED_ROWS = T.StructType([T.StructField("table_name", T.StringType(), True), MALFORMED_LINE])

CHECKED_ORDERS = T.StructType(
    ORDERS.fields
    + [
        MALFORMED_LINE,
        T.StructField("calculated_total", AMOUNT_SUM, True),
        T.StructField("data_quality_status", T.StringType(), True),
    ]
)

BAD_ITEMS = T.StructType(
    [
        *ORDER_ITEMS.fields,
        *[field for field in MENU_MASTER.fields if field.dataType == PRICE],
        T.StructField("price_valid", T.BooleanType(), True),
        T.StructField("menu_known", T.BooleanType(), True),
    ]
)

DUPLICATE_ORDERS = _schema(order_id=T.LongType(), count=T.LongType())

CASHIER_COUNTS = _schema(cashier_id=T.IntegerType(), tx_count=T.LongType())

FACT = _schema(
    item_id=T.LongType(),
    order_id=T.LongType(),
    menu_id=T.LongType(),
    quantity=T.IntegerType(),
    price_per_item=PRICE,
    subtotal=AMOUNT,
    outlet_id=T.IntegerType(),
    cashier_id=T.IntegerType(),
    total_amount=AMOUNT,
    payment_method=T.StringType(),
    order_date=T.DateType(),
    created_at=T.TimestampType(),
)


def with_days(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + DAY_FIELDS.fields)


RULE_COUNTS = _schema(
    year=T.StringType(), month=T.StringType(), day=T.StringType(), rule=T.StringType(), violations=T.LongType()
)

PRIMARY_KEYS = {
    "outlet_master": "outlet_id",
    "menu_master": "menu_id",
    "orders": "order_id",
    "order_items": "item_id",
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("orders", "outlet_id", "outlet_master", "outlet_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "menu_id", "menu_master", "menu_id"),
]

# Every source column is declared NOT NULL.
NOT_NULL = {name: schema.fieldNames() for name, schema in TABLES.items()}
