"""The same results as plain SQL over the raw test tables, for DuckDB."""

from __future__ import annotations

from tillhouse.samples import FIRST_DAY, LAST_DAY

VIEWS = {
    "fx_outlet_master": """
SELECT CAST(s.s_suppkey AS INT) AS outlet_id, s.s_name AS outlet_name, n.n_name AS city,
       CASE CAST(s.s_suppkey % 5 AS INT) WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3'
            WHEN 3 THEN 'Tier 1' ELSE 'Tier 2' END AS region_tier,
       DATE '2025-01-01' AS created_at, DATE '2025-01-01' AS updated_at
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "fx_menu_master": """
SELECT p_partkey AS menu_id, p_name AS menu_name,
       CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN 'Coffee' WHEN 1 THEN 'Non-Coffee' WHEN 2 THEN 'Pastry'
            WHEN 3 THEN 'Heavy Meal' ELSE 'Merch' END AS category,
       CAST(1000 * (3 + p_partkey % 20) AS DECIMAL(12,2)) AS base_price,
       CAST(1000 * (3 + p_partkey % 20) + 9000 AS DECIMAL(12,2)) AS price_tier_1,
       CAST(1000 * (3 + p_partkey % 20) + 6000 AS DECIMAL(12,2)) AS price_tier_2,
       CAST(1000 * (3 + p_partkey % 20) + 3000 AS DECIMAL(12,2)) AS price_tier_3,
       CASE WHEN p_size % 4 = 0 THEN 'true' ELSE 'false' END AS is_promo_active,
       DATE '2025-01-01' AS updated_at
FROM part""",
    "fx_order_items": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS item_id, l.l_orderkey AS order_id,
       CASE WHEN l.l_orderkey % 97 = 0 THEN -1 ELSE l.l_partkey END AS menu_id,
       CAST(l.l_quantity AS INT) AS quantity,
       CAST(1000 * (3 + l.l_partkey % 20)
            + CASE WHEN l.l_quantity = 50 THEN 1 ELSE 3000 * (l.l_linenumber % 4) END AS DECIMAL(12,2)) AS price_per_item,
       CAST(CAST(l.l_quantity AS INT) * (1000 * (3 + l.l_partkey % 20)
            + CASE WHEN l.l_quantity = 50 THEN 1 ELSE 3000 * (l.l_linenumber % 4) END) AS DECIMAL(14,2)) AS subtotal,
       CAST(DATE '2025-01-01' + CAST(l.l_orderkey % 740 AS INT) AS DATE) AS order_date
FROM lineitem l""",
    "fx_orders_one": """
SELECT o.o_orderkey AS order_id,
       CAST(CASE WHEN o.o_orderkey % 101 = 0 THEN -1 ELSE o.o_custkey % 10 END AS INT) AS outlet_id,
       CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN 100 ELSE 101 + o.o_custkey % 29 END AS INT) AS cashier_id,
       TRY_CAST(COALESCE(t.s, 0) + CASE WHEN o.o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS DECIMAL(14,2)) AS total_amount,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'QRIS' WHEN '2-HIGH' THEN 'Cash' WHEN '3-MEDIUM' THEN 'GoPay'
            WHEN '5-LOW' THEN 'cash'
            ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'OVO' ELSE NULL END END AS payment_method,
       CAST(DATE '2025-01-01' + CAST(o.o_orderkey % 740 AS INT) AS DATE) AS created_at
FROM orders o
LEFT JOIN (SELECT order_id, SUM(subtotal) AS s FROM fx_order_items GROUP BY order_id) t ON o.o_orderkey = t.order_id""",
    "fx_orders": """
SELECT * FROM fx_orders_one UNION ALL SELECT * FROM fx_orders_one WHERE order_id % 1000 = 7""",
    "items": """
SELECT item_id, order_id, menu_id, quantity, price_per_item, subtotal FROM fx_order_items""",
    "totals": """
SELECT order_id, CAST(SUM(subtotal) AS DECIMAL(24,2)) AS calculated_total FROM fx_order_items GROUP BY order_id""",
    "calc": """
SELECT o.*, t.calculated_total FROM fx_orders o LEFT JOIN totals t ON o.order_id = t.order_id""",
    "checked": """
SELECT *, CASE WHEN total_amount = calculated_total THEN 'valid' ELSE 'MISMATCH TOTAL AMOUNT' END AS data_quality_status
FROM calc""",
    "stg_orders": """
SELECT order_id, outlet_id, cashier_id, total_amount, payment_method, created_at, data_quality_status,
       CAST(EXTRACT(year FROM created_at) AS STRING) AS year,
       LPAD(CAST(EXTRACT(month FROM created_at) AS STRING), 2, '0') AS month,
       LPAD(CAST(EXTRACT(day FROM created_at) AS STRING), 2, '0') AS day
FROM checked""",
    "stg_order_items": """
SELECT item_id, order_id, menu_id, quantity, price_per_item, subtotal,
       CAST(EXTRACT(year FROM order_date) AS STRING) AS year,
       LPAD(CAST(EXTRACT(month FROM order_date) AS STRING), 2, '0') AS month,
       LPAD(CAST(EXTRACT(day FROM order_date) AS STRING), 2, '0') AS day
FROM fx_order_items""",
    "fact": """
SELECT i.item_id, i.order_id, i.menu_id, i.quantity, i.price_per_item, i.subtotal, o.outlet_id, o.cashier_id,
       o.total_amount, o.payment_method, o.created_at AS order_date, o.created_at, i.year, i.month, i.day
FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id
WHERE o.data_quality_status = 'valid'""",
    "menu_prices": """
SELECT i.*, m.base_price, m.price_tier_1, m.price_tier_2, m.price_tier_3,
       i.price_per_item = m.base_price OR i.price_per_item = m.price_tier_1
       OR i.price_per_item = m.price_tier_2 OR i.price_per_item = m.price_tier_3 AS price_valid
FROM items i LEFT JOIN fx_menu_master m ON i.menu_id = m.menu_id""",
    "orphan_items": """
SELECT * FROM items WHERE menu_id NOT IN (SELECT menu_id FROM fx_menu_master)""",
    "orphan_orders": """
SELECT * FROM fx_orders WHERE outlet_id NOT IN (SELECT outlet_id FROM fx_outlet_master)""",
    "invalid_payments": """
SELECT * FROM fx_orders
WHERE payment_method NOT IN ('Cash', 'Credit Card', 'Debit Card', 'GoPay', 'OVO', 'QRIS')""",
    "duplicates": """
SELECT order_id, COUNT(*) AS count FROM fx_orders GROUP BY order_id HAVING COUNT(*) > 1""",
    "per_cashier": """
SELECT cashier_id, COUNT(order_id) AS tx_count FROM fx_orders GROUP BY cashier_id""",
    "outliers": """
SELECT * FROM per_cashier
WHERE tx_count > (SELECT AVG(tx_count) + 3 * STDDEV_SAMP(tx_count) FROM per_cashier)""",
    # Items of the source come through their order, so a repeated order repeats its items.
    "source_items": """
SELECT i.item_id, i.order_id, i.menu_id, i.quantity, i.price_per_item, i.subtotal, o.created_at
FROM fx_order_items i JOIN fx_orders o ON i.order_id = o.order_id""",
    "source_totals": """
SELECT order_id, created_at, CAST(SUM(subtotal) AS DECIMAL(24,2)) AS calculated_total
FROM source_items GROUP BY order_id, created_at""",
    "source_checked": """
SELECT o.*, t.calculated_total,
       CASE WHEN o.total_amount = t.calculated_total THEN 'valid' ELSE 'MISMATCH TOTAL AMOUNT' END AS data_quality_status
FROM fx_orders o LEFT JOIN source_totals t ON o.order_id = t.order_id AND o.created_at = t.created_at""",
    "source_cashiers": """
SELECT created_at, cashier_id, COUNT(order_id) AS tx_count FROM fx_orders GROUP BY created_at, cashier_id""",
    "source_outliers": """
SELECT c.* FROM source_cashiers c
JOIN (SELECT created_at, AVG(tx_count) + 3 * STDDEV_SAMP(tx_count) AS threshold
      FROM source_cashiers GROUP BY created_at) s ON c.created_at = s.created_at
WHERE c.tx_count > s.threshold""",
    "source_rules": """
SELECT created_at, 'orders_without_items' AS rule FROM source_checked WHERE calculated_total IS NULL
UNION ALL SELECT created_at, 'orders_discrepancies' FROM source_checked WHERE total_amount <> calculated_total
UNION ALL SELECT created_at, 'invalid_payments' FROM invalid_payments
UNION ALL SELECT created_at, 'null_payments' FROM fx_orders WHERE payment_method IS NULL
UNION ALL SELECT created_at, 'orphan_orders' FROM orphan_orders
UNION ALL SELECT created_at, 'orphan_items' FROM source_items
          WHERE menu_id NOT IN (SELECT menu_id FROM fx_menu_master)
UNION ALL SELECT i.created_at, 'invalid_prices' FROM source_items i JOIN fx_menu_master m ON i.menu_id = m.menu_id
          WHERE i.price_per_item NOT IN (m.base_price, m.price_tier_1, m.price_tier_2, m.price_tier_3)
UNION ALL SELECT created_at, 'duplicate_orders' FROM fx_orders GROUP BY created_at, order_id HAVING COUNT(*) > 1
UNION ALL SELECT created_at, 'anomaly_cashiers' FROM source_outliers""",
    # Ten days of which nine are stored, two of them not as they are now.
    "early_orders": """
SELECT *, CASE created_at WHEN DATE '2026-04-22' THEN COALESCE(payment_method <> 'GoPay', TRUE) WHEN DATE '2026-04-29' THEN FALSE
       ELSE TRUE END AS stored,
       COALESCE(CASE created_at WHEN DATE '2026-04-27' THEN payment_method <> UPPER(payment_method) END, FALSE) AS other
FROM fx_orders WHERE created_at BETWEEN DATE '2026-04-22' AND DATE '2026-05-01'""",
    "menu_2": """
SELECT menu_id, menu_name, category,
       CAST(CASE WHEN menu_id % 10 = 0 THEN base_price + 500 ELSE base_price END AS DECIMAL(12,2)) AS base_price,
       price_tier_1, price_tier_2, price_tier_3, is_promo_active,
       CASE WHEN menu_id % 10 = 0 THEN DATE '2025-03-01' ELSE updated_at END AS updated_at
FROM fx_menu_master WHERE menu_id % 50 <> 7
UNION ALL
SELECT -100 - menu_id, menu_name, category, base_price, price_tier_1, price_tier_2, price_tier_3,
       is_promo_active, DATE '2025-03-02'
FROM fx_menu_master WHERE menu_id < 5""",
    "outlet_2": """
SELECT outlet_id, outlet_name, city, CASE WHEN outlet_id % 4 = 1 THEN '1' ELSE region_tier END AS region_tier,
       created_at, CASE WHEN outlet_id % 4 = 1 THEN DATE '2025-06-15' ELSE updated_at END AS updated_at
FROM fx_outlet_master WHERE outlet_id % 25 <> 4
UNION ALL
SELECT -100 - outlet_id, outlet_name, city, region_tier, DATE '2025-06-16', DATE '2025-06-16'
FROM fx_outlet_master WHERE outlet_id <= 3""",
    "menu_versions": """
SELECT o.*, CASE WHEN n.updated_at > o.updated_at THEN n.updated_at END AS valid_to
FROM fx_menu_master o LEFT JOIN menu_2 n ON o.menu_id = n.menu_id
UNION ALL
SELECT n.*, CAST(NULL AS DATE)
FROM menu_2 n LEFT JOIN fx_menu_master o ON o.menu_id = n.menu_id
WHERE o.menu_id IS NULL OR n.updated_at > o.updated_at""",
    "outlet_versions": """
SELECT o.*, CASE WHEN n.updated_at > o.updated_at THEN n.updated_at END AS valid_to
FROM fx_outlet_master o LEFT JOIN outlet_2 n ON o.outlet_id = n.outlet_id
UNION ALL
SELECT n.*, CAST(NULL AS DATE)
FROM outlet_2 n LEFT JOIN fx_outlet_master o ON o.outlet_id = n.outlet_id
WHERE o.outlet_id IS NULL OR n.updated_at > o.updated_at""",
    "order_days": """
SELECT CAST(UNNEST(GENERATE_SERIES(first, last, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT MIN(created_at) AS first, MAX(created_at) AS last FROM fx_orders)""",
    "calendar": """
SELECT CAST(UNNEST(GENERATE_SERIES(DATE '2025-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS date""",
}

_UNPADDED = """
       CAST(EXTRACT(year FROM updated_at) AS STRING) AS year, CAST(EXTRACT(month FROM updated_at) AS STRING) AS month,
       CAST(EXTRACT(day FROM updated_at) AS STRING) AS day"""
_MENU = "menu_name, category, base_price, price_tier_1, price_tier_2, price_tier_3, is_promo_active, updated_at"
_OUTLET = "outlet_name, city, region_tier, created_at, updated_at"
_DIM_MENU = """
SELECT CAST(menu_id AS STRING) AS menu_id, menu_name, category,
       CASE WHEN category IN ('Pastry', 'Heavy Meal') THEN 'Makanan'
            WHEN category IN ('Coffee', 'Non-Coffee') THEN 'Minuman' ELSE 'Lainnya' END AS category_group,
       base_price, price_tier_1, price_tier_2, price_tier_3,
       CASE WHEN base_price <= 10000 THEN 'Value' WHEN base_price <= 17000 THEN 'Core'
            ELSE 'Signature' END AS price_segment,
       CASE WHEN is_promo_active = 'true' THEN 'Active' ELSE 'Inactive' END AS promo_status,
       updated_at, updated_at AS row_start_date, valid_to AS row_end_date, valid_to IS NULL AS is_current_active
FROM """
_ORDER = "order_id, outlet_id, cashier_id, total_amount, payment_method, created_at"
_ORDER_TEXT = """order_id, outlet_id, cashier_id, CAST(total_amount AS STRING) AS total_amount, payment_method,
       CAST(created_at AS STRING) AS created_at"""
_ITEM_TEXT = """item_id, order_id, menu_id, quantity, CAST(price_per_item AS STRING) AS price_per_item,
       CAST(subtotal AS STRING) AS subtotal"""
_RUN_DAY = "DATE '2026-05-01'"


def _dim_outlet(versions: str, tier: str) -> str:
    return f"""
SELECT CAST(outlet_id AS STRING) AS outlet_id, outlet_name, city, region_tier,
       CASE {tier} WHEN '1' THEN 'Prime' WHEN '2' THEN 'Secondary' WHEN '3' THEN 'Tier 3'
            ELSE 'Unknown' END AS region_label,
       created_at, updated_at, updated_at AS row_start_date, valid_to AS row_end_date,
       valid_to IS NULL AS is_current_active
FROM {versions}"""


def _constraint(kind: str, table: str, column: str, violations: str) -> str:
    return (
        f"SELECT '{kind}' AS constraint_kind, '{table}' AS table_name, '{column}' AS column_name, "
        f"CAST(({violations}) AS BIGINT) AS violations"
    )


_COLUMNS = {
    "outlet_master": ("fx_outlet_master", ["outlet_id", "outlet_name", "city", "region_tier", "created_at", "updated_at"]),
    "menu_master": (
        "fx_menu_master",
        ["menu_id", "menu_name", "category", "base_price", "price_tier_1", "price_tier_2", "price_tier_3",
         "is_promo_active", "updated_at"],
    ),
    "orders": ("fx_orders", ["order_id", "outlet_id", "cashier_id", "total_amount", "payment_method", "created_at"]),
    "order_items": ("items", ["item_id", "order_id", "menu_id", "quantity", "price_per_item", "subtotal"]),
}


def _constraints() -> str:
    parts = []
    for table, (view, columns) in _COLUMNS.items():
        key = columns[0]
        for column in columns:
            parts.append(_constraint("not_null", table, column, f"SELECT COUNT(*) FROM {view} WHERE {column} IS NULL"))
        parts.append(
            _constraint(
                "unique", table, key,
                f"SELECT COUNT(*) FROM (SELECT {key} FROM {view} GROUP BY {key} HAVING COUNT(*) > 1)",
            )
        )
    for child, column, parent in (
        ("orders", "outlet_id", "outlet_master"),
        ("order_items", "order_id", "orders"),
        ("order_items", "menu_id", "menu_master"),
    ):
        parts.append(
            _constraint(
                "foreign_key", child, column,
                f"SELECT COUNT(*) FROM {_COLUMNS[child][0]} "
                f"WHERE {column} NOT IN (SELECT {column} FROM {_COLUMNS[parent][0]})",
            )
        )
    return " UNION ALL ".join(parts)


def _test(name: str, violations: str) -> str:
    return (
        f"SELECT '{name}' AS test_name, n AS violations, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status "
        f"FROM (SELECT COUNT(*) AS n FROM ({violations}))"
    )


def _tests() -> str:
    nulls = "SELECT 1 FROM {} WHERE {} IS NULL"
    twice = "SELECT 1 FROM {0} WHERE {1} IS NOT NULL GROUP BY {1} HAVING COUNT(*) > 1"
    return " UNION ALL ".join(
        [
            _test("not_null_stg_orders_order_id", nulls.format("stg_orders", "order_id")),
            _test("not_null_stg_order_items_item_id", nulls.format("stg_order_items", "item_id")),
            _test("not_null_snp_menu_master_menu_id", nulls.format("fx_menu_master", "menu_id")),
            _test("not_null_snp_outlet_master_outlet_id", nulls.format("fx_outlet_master", "outlet_id")),
            _test("not_null_fact_item_id", nulls.format("fact", "item_id")),
            _test("not_null_dim_menu_menu_id", nulls.format("fx_menu_master", "menu_id")),
            _test("not_null_dim_date_date", nulls.format("calendar", "date")),
            _test("not_null_dim_outlet_outlet_id", nulls.format("fx_outlet_master", "outlet_id")),
            _test("unique_fact_item_id", twice.format("fact", "item_id")),
            _test("unique_dim_date_date", twice.format("calendar", "date")),
            _test(
                "relationships_fact_order_date",
                "SELECT 1 FROM fact WHERE order_date NOT IN (SELECT date FROM calendar)",
            ),
        ]
    )


_RULES = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, COUNT(*) AS violations FROM {rows}"
    for rule, rows in (
        ("orders_without_items", "calc WHERE calculated_total IS NULL"),
        ("orders_discrepancies", "calc WHERE total_amount <> calculated_total"),
        ("invalid_payments", "invalid_payments"),
        ("null_payments", "fx_orders WHERE payment_method IS NULL"),
        ("orphan_orders", "orphan_orders"),
        ("orphan_items", "orphan_items"),
        ("invalid_prices", "menu_prices WHERE NOT price_valid"),
        ("duplicate_orders", "duplicates"),
        ("anomaly_cashiers", "outliers"),
    )
)

_DAY_KEYS_OF = """CAST(EXTRACT(year FROM created_at) AS STRING) AS year,
       LPAD(CAST(EXTRACT(month FROM created_at) AS STRING), 2, '0') AS month,
       LPAD(CAST(EXTRACT(day FROM created_at) AS STRING), 2, '0') AS day"""

_RULE_NAMES = (
    "orders_without_items orders_discrepancies invalid_payments null_payments orphan_items invalid_prices "
    "duplicate_orders anomaly_cashiers orphan_orders malformed_rows"
).split()


def _rules_on(days: str) -> str:
    """Violations of every rule on each of the days."""
    names = ", ".join(f"('{name}')" for name in _RULE_NAMES)
    return f"""SELECT {_DAY_KEYS_OF}, rule, (SELECT COUNT(*) FROM source_rules s
        WHERE s.created_at = g.created_at AND s.rule = g.rule) AS violations
        FROM (SELECT d.created_at, r.rule FROM ({days}) d, (VALUES {names}) r(rule)) g"""


_DIM_DATE = """
SELECT date, CAST(EXTRACT(year FROM date) AS INT) AS year, CAST(EXTRACT(month FROM date) AS INT) AS month,
       CAST(EXTRACT(day FROM date) AS INT) AS day, CAST(EXTRACT(quarter FROM date) AS INT) AS quarter,
       CAST(EXTRACT(week FROM date) AS INT) AS week_of_year, CAST(EXTRACT(isodow FROM date) AS INT) AS day_of_week,
       DAYNAME(date) AS day_name, MONTHNAME(date) AS month_name,
       CASE WHEN EXTRACT(isodow FROM date) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend,
       CAST(EXTRACT(year FROM date) AS STRING) || '-' || LPAD(CAST(EXTRACT(month FROM date) AS STRING), 2, '0')
           AS year_month
FROM order_days"""

_FACT = "SELECT * FROM fact"
_SILVER_DAYS = f"""SELECT {_ORDER}, data_quality_status, {_DAY_KEYS_OF} FROM source_checked"""

SELECTS = {
    "scan_source": f"SELECT {_ITEM_TEXT} FROM fx_order_items",
    "extract_master_full": """SELECT menu_id, menu_name, category, CAST(base_price AS STRING) AS base_price,
        CAST(price_tier_1 AS STRING) AS price_tier_1, CAST(price_tier_2 AS STRING) AS price_tier_2,
        CAST(price_tier_3 AS STRING) AS price_tier_3, is_promo_active, CAST(updated_at AS STRING) AS updated_at
        FROM fx_menu_master""",
    "extract_outlet_full": """SELECT outlet_id, outlet_name, city, region_tier, CAST(created_at AS STRING) AS created_at,
        CAST(updated_at AS STRING) AS updated_at FROM fx_outlet_master""",
    "extract_orders_day": f"SELECT {_ORDER_TEXT} FROM fx_orders WHERE created_at = {_RUN_DAY}",
    "extract_items_day": f"SELECT {_ITEM_TEXT} FROM source_items WHERE created_at = {_RUN_DAY}",
    "bronze_csv_roundtrip": "SELECT * FROM fx_orders",
    "bronze_partition_layout": """SELECT 'year=' || STRFTIME(created_at, '%Y') || '/month=' || STRFTIME(created_at, '%m')
        || '/day=' || STRFTIME(created_at, '%d') AS partition_path, COUNT(*) AS row_count FROM fx_orders GROUP BY 1""",
    "scan_csv_schema": "SELECT * FROM items",
    # Header lines sort after the digits every data line starts with.
    "scan_csv_preview": """SELECT CAST(item_id AS STRING) AS _c0, CAST(order_id AS STRING) AS _c1,
        CAST(menu_id AS STRING) AS _c2, CAST(quantity AS STRING) AS _c3, CAST(price_per_item AS STRING) AS _c4,
        CAST(subtotal AS STRING) AS _c5 FROM items ORDER BY 1, 2, 3, 4, 5, 6 LIMIT 5""",
    "silver_master_load": "SELECT * FROM fx_menu_master",
    "silver_outlet_load": "SELECT * FROM fx_outlet_master",
    "silver_partition_overwrite": f"""SELECT * REPLACE (CASE WHEN created_at = {_RUN_DAY} THEN UPPER(payment_method)
        ELSE payment_method END AS payment_method) FROM stg_orders""",
    "quarantine_write": f"SELECT *, {_DAY_KEYS_OF} FROM invalid_payments WHERE created_at <> {_RUN_DAY}",
    "scan_silver_partitioned": "SELECT * FROM stg_order_items",
    "catalog_external_table": """SELECT year, month, day, COUNT(*) AS order_count,
        CAST(SUM(total_amount) AS DECIMAL(24,2)) AS total_amount FROM stg_orders GROUP BY year, month, day""",
    "partition_projection": """SELECT CAST(y AS STRING) AS year, LPAD(CAST(m AS STRING), 2, '0') AS month,
        LPAD(CAST(d AS STRING), 2, '0') AS day, (SELECT COUNT(*) FROM stg_orders o WHERE o.year = CAST(y AS STRING)
        AND o.month = LPAD(CAST(m AS STRING), 2, '0') AND o.day = LPAD(CAST(d AS STRING), 2, '0')) AS order_count
        FROM RANGE(2026, 2028) a(y), RANGE(1, 13) b(m), RANGE(1, 32) c(d)""",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": "SELECT * FROM stg_order_items",
    "fact_incremental_overwrite": f"SELECT * FROM fact WHERE NOT (order_date = {_RUN_DAY} AND cashier_id = 100)",
    "insert_if_absent": f"""SELECT DISTINCT * FROM fx_orders WHERE created_at < DATE '2026-01-01'
        UNION ALL
        SELECT {_ORDER} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY outlet_id, cashier_id,
            total_amount NULLS FIRST, payment_method NULLS FIRST, created_at) AS n FROM fx_orders)
        WHERE n = 1 AND order_id NOT IN (SELECT order_id FROM fx_orders WHERE created_at < DATE '2026-01-01')""",
    "dq_orders_without_items": f"SELECT {_ORDER} FROM calc WHERE calculated_total IS NULL",
    "dq_order_discrepancies": "SELECT * FROM calc WHERE total_amount <> calculated_total",
    "dq_orphan_items": "SELECT * FROM orphan_items",
    "dq_orphan_orders": "SELECT * FROM orphan_orders",
    "dq_invalid_payments": "SELECT * FROM invalid_payments",
    "dq_invalid_prices": "SELECT * FROM menu_prices WHERE NOT price_valid",
    "dq_duplicate_orders": "SELECT * FROM duplicates",
    "dq_duplicate_orders_daily": f"""SELECT {_DAY_KEYS_OF}, order_id, COUNT(*) AS count FROM fx_orders
        GROUP BY created_at, order_id HAVING COUNT(*) > 1""",
    "dq_anomaly_cashiers": "SELECT * FROM outliers",
    "dq_anomaly_cashiers_daily": f"SELECT {_DAY_KEYS_OF}, cashier_id, tx_count FROM source_outliers",
    "dq_anomaly_cashiers_window": """SELECT c.created_at AS date, c.cashier_id, c.tx_count FROM source_cashiers c
        JOIN (SELECT d.created_at, AVG(w.tx_count) + 3 * STDDEV_SAMP(w.tx_count) AS threshold
              FROM (SELECT DISTINCT created_at FROM source_cashiers) d
              JOIN source_cashiers w ON w.created_at BETWEEN d.created_at - 27 AND d.created_at GROUP BY d.created_at) s
        ON c.created_at = s.created_at WHERE c.tx_count > s.threshold""",
    "run_anomaly_cashiers_window": f"""SELECT created_at AS date, cashier_id, tx_count FROM source_cashiers
        WHERE created_at = {_RUN_DAY} AND tx_count > (SELECT AVG(tx_count) + 3 * STDDEV_SAMP(tx_count) FROM source_cashiers
            WHERE created_at BETWEEN {_RUN_DAY} - 9 AND {_RUN_DAY})""",
    "dq_anomaly_outlet_cashiers": """SELECT * FROM (SELECT outlet_id, cashier_id, COUNT(order_id) AS tx_count
        FROM fx_orders GROUP BY outlet_id, cashier_id) WHERE tx_count > (SELECT AVG(n) + 3 * STDDEV_SAMP(n)
        FROM (SELECT COUNT(order_id) AS n FROM fx_orders GROUP BY outlet_id, cashier_id))""",
    "silver_orders": f"SELECT {_ORDER}, data_quality_status FROM checked",
    "silver_order_items": "SELECT * FROM items",
    "dq_summary": _RULES,
    "dq_sample_bad_rows": """SELECT item_id, menu_id, price_per_item, base_price, price_tier_1, price_tier_2, price_tier_3
        FROM menu_prices WHERE NOT price_valid ORDER BY 1, 2, 3, 4, 5, 6, 7 LIMIT 5""",
    "join_orders_item_totals": "SELECT * FROM calc",
    "join_items_menu": "SELECT * FROM menu_prices",
    "agg_order_item_totals": "SELECT * FROM totals",
    "agg_cashier_tx_count": "SELECT * FROM per_cashier",
    "agg_cashier_stats": """SELECT CAST(AVG(tx_count) AS DECIMAL(18,4)) AS mean_tx,
        CAST(STDDEV_SAMP(tx_count) AS DECIMAL(18,4)) AS stddev_tx,
        CAST(AVG(tx_count) + 3 * STDDEV_SAMP(tx_count) AS DECIMAL(18,4)) AS threshold FROM per_cashier""",
    "agg_max_id": "SELECT COALESCE(MAX(order_id), 0) AS max_id FROM fx_orders",
    "partition_columns": f"""SELECT order_id, created_at, year, month, day,
        'year=' || year || '/month=' || month || '/day=' || day AS partition_path FROM stg_orders""",
    "date_range": "SELECT CAST(date AS STRING) AS run_date FROM order_days",
    "scd2_initial": f"""SELECT CAST(menu_id AS STRING) AS menu_id, {_MENU}, {_UNPADDED}, updated_at AS valid_from,
        CAST(NULL AS DATE) AS valid_to FROM fx_menu_master""",
    "scd2_menu": f"""SELECT CAST(menu_id AS STRING) AS menu_id, {_MENU}, {_UNPADDED}, updated_at AS valid_from, valid_to
        FROM menu_versions""",
    "scd2_outlet": f"""SELECT CAST(outlet_id AS STRING) AS outlet_id, {_OUTLET}, {_UNPADDED}, updated_at AS valid_from,
        valid_to FROM outlet_versions""",
    "stamp_updated_at": """SELECT n.* REPLACE (CASE WHEN o.menu_id IS NULL OR n.base_price <> o.base_price
        THEN DATE '2025-04-01' ELSE o.updated_at END AS updated_at)
        FROM menu_2 n LEFT JOIN fx_menu_master o ON n.menu_id = o.menu_id""",
    "dim_date": _DIM_DATE,
    "dim_menu": _DIM_MENU + "(SELECT *, CAST(NULL AS DATE) AS valid_to FROM fx_menu_master)",
    "dim_menu_versions": _DIM_MENU + "menu_versions",
    "dim_outlet": _dim_outlet("(SELECT *, CAST(NULL AS DATE) AS valid_to FROM fx_outlet_master)", "region_tier"),
    "dim_outlet_versions": _dim_outlet("outlet_versions", "REPLACE(region_tier, 'Tier ', '')"),
    "fact_order_items": _FACT,
    "fact_order_items_day": f"SELECT * FROM fact WHERE order_date = {_RUN_DAY}",
    "test_not_null": "SELECT * FROM fx_orders WHERE payment_method IS NULL",
    "test_unique": "SELECT item_id, COUNT(*) AS n_records FROM items GROUP BY item_id HAVING COUNT(*) > 1",
    "test_unique_recent": """SELECT item_id, COUNT(*) AS n_records FROM fact
        WHERE order_date >= DATE '2026-12-28' GROUP BY item_id HAVING COUNT(*) > 1""",
    "test_relationships": "SELECT * FROM fact WHERE order_date NOT IN (SELECT date FROM calendar)",
    "test_freshness": """SELECT 'orders' AS table_name, newest AS newest_day, hours AS age_hours,
        CASE WHEN hours > 48 THEN 'error' WHEN hours > 24 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT newest, DATE_DIFF('hour', CAST(newest AS TIMESTAMP), TIMESTAMP '2027-01-11 12:00:00') AS hours
              FROM (SELECT MAX(created_at) AS newest FROM fx_orders))""",
    "test_column_count": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {len(columns)} AS expected_columns, {len(columns)} AS found_columns, "
        f"COUNT(*) AS row_count FROM {view}"
        for table, (view, columns) in _COLUMNS.items()
    ),
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS row_count FROM {view}" for table, (view, _) in _COLUMNS.items()
    ),
    "test_constraints": _constraints(),
    "test_summary": _tests(),
    "silver_day_run": _rules_on(f"SELECT {_RUN_DAY} AS created_at"),
    "backfill_run": _rules_on(
        f"SELECT CAST(UNNEST(GENERATE_SERIES(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS created_at"
    ),
    "backfill_gap_days": f"""{_SILVER_DAYS} WHERE created_at BETWEEN DATE '2026-04-29' AND {_RUN_DAY}
        AND (created_at <> DATE '2026-04-30' OR payment_method IS NULL OR payment_method <> 'GoPay')""",
    "csv_odd_text": """SELECT * REPLACE (CASE WHEN order_id % 7 = 0 THEN '<nil>' ELSE ' ' || CHR(9) || ' ' || payment_method
        || CHR(10) || '"x\\n", ' || CHR(13) || '\\ ' || CHR(9) || ' ' END AS payment_method) FROM fx_orders""",
    "dq_malformed_rows": f"""SELECT order_id || ',' || CASE order_id % 50 WHEN 11 THEN 'x1' ELSE CAST(outlet_id AS STRING) END
        || ',' || cashier_id || ',' || CASE order_id % 50 WHEN 3 THEN 'oops' ELSE COALESCE(CAST(total_amount AS STRING), '<nil>') END
        || ',' || COALESCE(payment_method, '<nil>') || ',' || CASE order_id % 50 WHEN 17 THEN '2026-13-45 00:00:00'
        ELSE STRFTIME(created_at, '%Y-%m-%d 00:00:00') END AS malformed_line, {_DAY_KEYS_OF}
        FROM fx_orders WHERE order_id % 50 IN (3, 11, 17)""",
    "changed_days": """SELECT o.created_at AS day, orders_before, COALESCE(items_before, 0) AS items_before, orders_now,
        COALESCE(items_now, 0) AS items_now
        FROM (SELECT created_at, COUNT(*) FILTER (stored) AS orders_before, COUNT(*) AS orders_now, BOOL_OR(other OR NOT stored) AS differs
              FROM early_orders GROUP BY created_at) o
        LEFT JOIN (SELECT e.created_at, COUNT(*) FILTER (stored) AS items_before, COUNT(*) AS items_now FROM early_orders e
              JOIN fx_order_items i ON i.order_id = e.order_id GROUP BY e.created_at) i
        ON i.created_at = o.created_at WHERE differs""",
    "unique_over_days": f"""SELECT item_id, COUNT(*) AS n_records FROM (
            SELECT item_id FROM fact UNION ALL SELECT item_id FROM fact WHERE item_id % 1000 = 11
        ) WHERE item_id IN (SELECT item_id FROM fact WHERE order_date = {_RUN_DAY} OR item_id % 1000 = 11)
        GROUP BY item_id HAVING COUNT(*) > 1""",
    "run_quarantine": f"""SELECT rule, row_key, value, {_DAY_KEYS_OF} FROM (
        SELECT 'orphan_items' AS rule, CAST(item_id AS STRING) AS row_key, CAST(menu_id AS STRING) AS value, created_at
        FROM source_items WHERE menu_id NOT IN (SELECT menu_id FROM fx_menu_master)
        UNION ALL SELECT 'invalid_payments', CAST(order_id AS STRING), payment_method, created_at FROM invalid_payments
        UNION ALL SELECT 'invalid_prices', CAST(item_id AS STRING), CAST(price_per_item AS STRING), created_at
        FROM source_items i JOIN fx_menu_master m ON i.menu_id = m.menu_id
        WHERE price_per_item NOT IN (base_price, price_tier_1, price_tier_2, price_tier_3)
        UNION ALL SELECT 'duplicate_orders', CAST(order_id AS STRING), CAST(COUNT(*) AS STRING), created_at FROM fx_orders
        GROUP BY created_at, order_id HAVING COUNT(*) > 1
        UNION ALL SELECT 'anomaly_cashiers', CAST(cashier_id AS STRING), CAST(tx_count AS STRING), created_at FROM source_outliers
        UNION ALL SELECT 'orders_discrepancies', CAST(order_id AS STRING), CAST(calculated_total AS STRING), created_at
        FROM source_checked WHERE total_amount <> calculated_total
        ) WHERE created_at BETWEEN {_RUN_DAY} - 2 AND {_RUN_DAY}""",
    "run_history": f"""SELECT CAST(menu_id AS STRING) AS menu_id, {_MENU}, {_UNPADDED}, updated_at AS valid_from, valid_to
        FROM menu_versions""",
    "stream_ledger": f"""SELECT created_at AS day, COUNT(*) FILTER (created_at <> {_RUN_DAY} OR payment_method IS NULL
        OR payment_method <> 'QRIS') AS row_count FROM fx_orders GROUP BY created_at""",
    "stream_rerun_day": f"""SELECT * REPLACE (CASE WHEN created_at = {_RUN_DAY} THEN UPPER(payment_method)
        ELSE payment_method END AS payment_method), {_DAY_KEYS_OF} FROM fx_orders""",
    "run_dim_menu": _DIM_MENU + "(SELECT *, CAST(NULL AS DATE) AS valid_to FROM fx_menu_master)",
    "run_dim_outlet": _dim_outlet("(SELECT *, CAST(NULL AS DATE) AS valid_to FROM fx_outlet_master)", "region_tier"),
    "late_lookback": f"{_SILVER_DAYS} WHERE created_at BETWEEN DATE '2026-04-29' AND {_RUN_DAY}",
    "daily_run": f"""SELECT i.item_id, i.order_id, i.menu_id, i.quantity, i.price_per_item, i.subtotal, o.outlet_id,
        o.cashier_id, o.total_amount, o.payment_method, o.created_at AS order_date, o.created_at,
        '2026' AS year, '05' AS month, '01' AS day
        FROM source_checked o JOIN source_items i ON o.order_id = i.order_id AND o.created_at = i.created_at
        WHERE o.data_quality_status = 'valid' AND o.created_at = {_RUN_DAY}""",
    "stream_bronze_ingest": f"SELECT *, {_DAY_KEYS_OF} FROM fx_orders",
}


def statements() -> dict[str, str]:
    views = ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items())
    return {name: f"WITH {views}\n{select}" for name, select in SELECTS.items()}
