"""The reference SQL of each registered query, written over the views of ``oracle``."""

from __future__ import annotations

from bazaarlake import schema
from bazaarlake.oracle import CLEAN, DATE_KEY, VIEWS, complete, raw_select

QUERIES: dict[str, str] = {}
for _t in schema.TABLES:
    QUERIES[f"silver_{_t}"] = f"SELECT * FROM silver_{_t}"
for _t in schema.REFRESH_TABLES:
    QUERIES[f"bronze_{_t}"] = f"SELECT * FROM bronze_{_t}"
    QUERIES[f"raw_{_t}"] = f"SELECT * FROM raw_{_t}"
for _t in (
    "dim_customer", "dim_vendor", "category_parent", "dim_product", "dim_location",
    "fact_sales", "fact_payments", "fact_purchases", "fact_inventory",
    "active_customers", "active_products", "sales",
):
    QUERIES[_t] = f"SELECT * FROM {_t}"


def _latest(rel: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn FROM {rel}) WHERE rn = 1"""


def _share(groups: str, column: str) -> str:
    return f"""SELECT {column}, row_count,
           CAST(floor(1000.0 * row_count / sum(row_count) OVER () + 0.5) / 10 AS DECIMAL(5,1)) AS pct
    FROM (SELECT {column}, count(*) AS row_count FROM {groups} GROUP BY {column})"""


def _fan_out(table: str, key: str, what: str) -> str:
    return f"""SELECT min(n) AS min_{what}, CAST(floor(100.0 * sum(n) / count(*) + 0.5) / 100 AS DECIMAL(18,2)) AS avg_{what},
           max(n) AS max_{what} FROM (SELECT count(*) AS n FROM src_{table} GROUP BY {key})"""


def _missing(child: str, fk: str, parent: str) -> str:
    return f"""(SELECT count(*) FROM src_{child} c WHERE c.{fk} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM src_{parent} p WHERE p.id = c.{fk}))"""


def _repeats(table: str, key: tuple[str, ...]) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return f"(SELECT count(*) - count(DISTINCT ({', '.join(key)})) FROM src_{table} WHERE {known})"


def _rules(rules) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{label}' AS rule, (SELECT count(*) FROM src_{t} WHERE NOT ({ok})) AS bad_rows"
        for t, label, ok in rules
    )


def _sum(c: str) -> str:
    return f"CAST(coalesce(sum({c}), 0) AS DECIMAL(24,4))"


# Full refresh and flat variants.
QUERIES |= {
    "locations": """
    SELECT l.id AS location_id, l.name AS location_name, coalesce(l.code, '') AS location_code,
           coalesce(l.location_type, '') AS location_type, coalesce(c.name, '') AS city_name,
           coalesce(m.name, '') AS muhafaza_name
    FROM bronze_stock_location l LEFT JOIN bronze_cities c ON l.city_id = c.id
    LEFT JOIN bronze_muhafazat m ON l.muhafaza_id = m.id""",
    "fact_sales_simple": f"""
    SELECT sale_line_id, order_id, customer_id, product_id, location_id, {DATE_KEY.format('date_order')} AS date_key,
           order_state, product_uom_qty, price_unit, discount, price_subtotal, price_total FROM sales""",
    "fact_dim_gap": """
    SELECT 'customers' AS dimension, customer_id AS missing_key, count(*) AS fact_rows FROM sales
    WHERE customer_id NOT IN (SELECT customer_id FROM active_customers) GROUP BY customer_id
    UNION ALL
    SELECT 'products', product_id, count(*) FROM sales
    WHERE product_id NOT IN (SELECT product_id FROM active_products) GROUP BY product_id""",
    "dim_customers_via_city": """
    SELECT p.id AS customer_id, p.name AS customer_name, p.email, p.phone, c.name AS city_name, m.name AS governorate_name
    FROM raw_res_partner p LEFT JOIN raw_cities c ON p.city_id = c.id LEFT JOIN raw_muhafazat m ON c.muhafaza_id = m.id""",
    "dim_products_flat": """
    SELECT p.id AS product_id, t.name AS product_name, c.name AS category_name, t.list_price AS unit_price,
           t.type AS product_type
    FROM raw_product_product p LEFT JOIN raw_product_template t ON p.product_tmpl_id = t.id
    LEFT JOIN raw_product_category c ON t.categ_id = c.id""",
    "dim_locations_flat": """
    SELECT id AS location_id, name AS location_name, code || ' / ' || name AS full_location_path, location_type
    FROM raw_stock_location""",
    "fact_sales_flat": """
    SELECT l.id AS line_id, o.id AS order_id, o.partner_id AS customer_id, l.product_id, o.location_id,
           l.product_uom_qty AS quantity, l.price_unit, l.price_subtotal AS subtotal_amount,
           l.price_total AS total_amount, o.state AS order_status, o.date_order AS order_date
    FROM raw_sale_order o JOIN raw_sale_order_line l ON o.id = l.order_id""",
    "dim_date": """
    SELECT d.*, coalesce(n, 0) AS fact_rows FROM calendar d
    LEFT JOIN (SELECT date_key + 200000 AS k, count(*) AS n FROM fact_sales GROUP BY k) ON k = d.date_key
    WHERE d.year >= 2015""",
    "dim_date_iso": f"""
    SELECT c.*, coalesce(n, 0) AS fact_rows
    FROM (SELECT {DATE_KEY.format('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
                 CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
                 CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
                 isodow(d) IN (6, 7) AS is_weekend
          FROM (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS DATE) AS d)) c
    LEFT JOIN (SELECT {DATE_KEY.format("coalesce(payment_date, create_date) + INTERVAL 25 YEAR")} AS k, count(*) AS n
               FROM silver_account_payment GROUP BY k) ON k = date_key""",
}

for _name, _calendar, _fact in (
    ("dim_date_in_use", "SELECT * FROM calendar", "fact_sales"),
    ("dim_date_iso_in_use", """SELECT date_key, date AS full_date, year, quarter, month, month_name, day, day_of_week, day_name,
        day_of_week IN (6, 7) AS is_weekend FROM calendar""", "fact_payments"),
):
    QUERIES[_name] = f"""
    SELECT d.*, coalesce(n, 0) AS fact_rows FROM ({_calendar}) d
    LEFT JOIN (SELECT date_key AS k, count(*) AS n FROM {_fact} GROUP BY k) ON k = d.date_key
    WHERE d.year BETWEEN (SELECT min(date_key) // 10000 FROM {_fact}) AND (SELECT max(date_key) // 10000 FROM {_fact})"""

# The sales fact over a log with corrections (batch 2) and a stale replay (batch 3).
_LINE_LOG = """(SELECT *, 1 AS batch FROM silver_sale_order_line
        UNION ALL SELECT * REPLACE (CAST(50 AS DECIMAL(9,4)) AS discount), 2 FROM silver_sale_order_line WHERE id % 10 = 5)"""
_ORDER_LOG = """(SELECT *, 1 AS batch FROM silver_sale_order
        UNION ALL SELECT * REPLACE ('cancel' AS state, write_date + INTERVAL 1 DAY AS write_date), 2
                  FROM silver_sale_order WHERE id % 10 = 3
        UNION ALL SELECT * REPLACE ('stale' AS state, write_date - INTERVAL 1 DAY AS write_date), 3
                  FROM silver_sale_order WHERE id % 10 = 4)"""
_NEWEST = "write_date DESC, batch DESC"
QUERIES["fact_sales_final"] = f"""
    SELECT l.id AS sale_line_key, o.id AS order_id, o.name AS order_name, {DATE_KEY.format('o.date_order')} AS date_key,
           o.partner_id AS customer_key, l.product_id AS product_key, o.location_id AS location_key,
           o.state AS order_state, l.product_uom_qty AS quantity, l.price_unit AS unit_price, l.discount AS discount_pct,
           l.price_subtotal AS amount_untaxed, CAST(l.price_total - l.price_subtotal AS DECIMAL(18,4)) AS tax_amount,
           l.price_total AS amount_total
    FROM ({_latest(_LINE_LOG, _NEWEST)}) l JOIN ({_latest(_ORDER_LOG, _NEWEST)}) o ON l.order_id = o.id"""

# Profile.
_STATUS = """(SELECT CASE WHEN paid IS NULL OR paid = 0 THEN 'unpaid' WHEN paid >= amount_total - 0.01 THEN 'paid_full'
                   ELSE 'partial' END AS payment_status
            FROM src_sale_order o LEFT JOIN (SELECT sale_order_id, sum(amount) AS paid FROM src_account_payment
                                             GROUP BY sale_order_id) p ON p.sale_order_id = o.id)"""
QUERIES |= {
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM src_{t}) AS row_count" for t in schema.TABLES
    ),
    "partner_counts": """
    SELECT count(*) FILTER (WHERE partner_type = 'customer') AS customers,
           count(*) FILTER (WHERE partner_type = 'vendor') AS vendors,
           count(*) FILTER (WHERE active) AS active_partners FROM src_res_partner""",
    "variants_per_template": _fan_out("product_product", "product_tmpl_id", "variants"),
    "vendors_per_product": _fan_out("product_supplierinfo", "product_id", "vendors"),
    "order_time_span": """
    SELECT min(date_order) AS earliest_order, max(date_order) AS latest_order,
           CAST(date_diff('second', min(date_order), max(date_order)) AS BIGINT) AS span_seconds FROM src_sale_order""",
    "sale_state_dist": _share("src_sale_order", "state"),
    "purchase_state_dist": _share("src_purchase_order", "state"),
    "payment_coverage": _share(_STATUS, "payment_status"),
    "top_governorates": """
    SELECT m.name AS governorate, count(*) AS customers FROM src_res_partner p JOIN src_muhafazat m ON m.id = p.muhafaza_id
    WHERE p.partner_type = 'customer' GROUP BY m.name ORDER BY customers DESC, governorate LIMIT 10""",
    "inventory_position": """
    SELECT count(*) AS quant_rows, CAST(round(sum(quantity), 0) AS DECIMAL(18,0)) AS total_on_hand,
           CAST(round(sum(reserved_quantity), 0) AS DECIMAL(18,0)) AS total_reserved,
           CAST(round(sum(quantity - reserved_quantity), 0) AS DECIMAL(18,0)) AS total_available FROM src_stock_quant""",
    "inventory_value_top": """
    SELECT m.name AS governorate, CAST(round(sum(q.quantity * t.standard_price), 2) AS DECIMAL(18,2)) AS inventory_value
    FROM src_stock_quant q JOIN src_stock_location l ON l.id = q.location_id JOIN src_muhafazat m ON m.id = l.muhafaza_id
    JOIN src_product_product p ON p.id = q.product_id JOIN src_product_template t ON t.id = p.product_tmpl_id
    GROUP BY m.name ORDER BY inventory_value DESC, governorate LIMIT 5""",
    "duplicate_emails": """
    SELECT count(*) AS emails, count(DISTINCT lower(trim(email))) AS distinct_emails,
           count(*) - count(DISTINCT lower(trim(email))) AS duplicate_emails
    FROM src_res_partner WHERE email IS NOT NULL""",
}

# Quality.
QUERIES |= {
    "fk_check": " UNION ALL ".join(
        f"SELECT '{c}' AS table_name, '{fk}' AS column_name, '{p}' AS parent, {_missing(c, fk, p)} AS bad_rows"
        for c, fk, p in schema.FOREIGN_KEYS
    ),
    "orphan_check": " UNION ALL ".join(
        f"SELECT '{label}' AS check_name, (SELECT count(*) FROM src_{c} c LEFT JOIN src_{p} p ON p.id = c.{fk} WHERE p.id IS NULL) AS bad_rows"
        for label, c, fk, p in (
            ("sale_orders_without_partner", "sale_order", "partner_id", "res_partner"),
            ("sale_lines_without_order", "sale_order_line", "order_id", "sale_order"),
            ("sale_lines_without_product", "sale_order_line", "product_id", "product_product"),
            ("purchase_orders_without_vendor", "purchase_order", "partner_id", "res_partner"),
            ("purchase_lines_without_order", "purchase_order_line", "order_id", "purchase_order"),
        )
    ),
    "unique_check": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{', '.join(k)}' AS key_columns, {_repeats(t, k)} AS bad_rows"
        for t, k in schema.UNIQUE_KEYS
    ),
    "value_check": _rules(schema.VALUE_CHECKS),
    "state_check": _rules((t, c, f"{c} IN {values}") for t, c, values in schema.ACCEPTED_STATES),
    "not_null_check": _rules(
        (t, c.name, f"{c.name} IS NOT NULL") for t in schema.TABLES for c in schema.columns(t) if c.required
    ),
    "total_reconciliation": """
    SELECT count(*) AS compared_orders, count(*) FILTER (WHERE amount_total <> round(t, 2)) AS mismatched_orders
    FROM src_sale_order JOIN (SELECT order_id, sum(price_total) AS t FROM src_sale_order_line GROUP BY order_id) ON order_id = id""",
    "dirtiness_sample": """
    SELECT count(*) FILTER (WHERE email IS NULL) AS partners_null_email,
           count(*) FILTER (WHERE phone IS NULL) AS partners_null_phone,
           count(*) FILTER (WHERE city_id IS NULL) AS partners_null_city_id,
           count(*) FILTER (WHERE name <> trim(name)) AS names_with_padding,
           count(email) - count(DISTINCT lower(trim(email))) AS duplicate_emails FROM src_res_partner""",
}

QUERIES["fk_check_bitmaps"] = QUERIES["fk_check"]

# Star-schema questions.
QUERIES |= {
    "kpi_sales_by_governorate": f"""
    SELECT coalesce(governorate, '') AS governorate, coalesce(city, '') AS city, count(DISTINCT customer_key) AS customers,
           CAST(sum(lines) AS BIGINT) AS sale_lines,
           {_sum('net')} AS amount_untaxed, {_sum('total')} AS amount_total, {_sum('paid')} AS amount_paid
    FROM (
      SELECT customer_key AS k, 1 AS lines, amount_untaxed AS net, amount_total AS total, NULL AS paid FROM fact_sales
      UNION ALL SELECT customer_key, 0, NULL, NULL, amount FROM fact_payments
      UNION ALL SELECT customer_key, 0, NULL, NULL, NULL FROM dim_customer) facts LEFT JOIN dim_customer ON customer_key = k GROUP BY ALL""",
    "kpi_open_balance": f"""
    SELECT customer_key, orders, ordered, paid, CAST(ordered - paid AS DECIMAL(24,4)) AS open_balance
    FROM (SELECT partner_id AS customer_key, count(*) AS orders, {_sum('amount_total')} AS ordered, {_sum('p.paid')} AS paid
          FROM silver_sale_order LEFT JOIN (SELECT order_id, sum(amount) AS paid FROM fact_payments GROUP BY order_id) p
            ON p.order_id = id
          WHERE state <> 'cancel' GROUP BY partner_id) WHERE ordered > paid""",
    "kpi_inventory": f"""
    SELECT *, CAST(floor(CAST(10000 * reserved AS DOUBLE) / CAST(on_hand AS DOUBLE) + 0.5) / 10000 AS DECIMAL(9,4)) AS reserved_ratio
    FROM (SELECT count(*) AS lots, {_sum('on_hand_qty')} AS on_hand, {_sum('reserved_qty')} AS reserved,
                 {_sum('available_qty')} AS available, {_sum('inventory_value')} AS inventory_value FROM fact_inventory)""",
    "kpi_stock_distribution": f"""
    SELECT coalesce(governorate, '') AS governorate, coalesce(location_code, '') AS location_code,
           coalesce(CASE WHEN parent_category = '' THEN category_name ELSE parent_category END, '') AS category,
           {_sum('on_hand_qty')} AS on_hand, {_sum('inventory_value')} AS inventory_value
    FROM fact_inventory f LEFT JOIN dim_product p ON p.product_key = f.product_key
    LEFT JOIN dim_location l ON l.location_key = f.location_key GROUP BY ALL""",
    "kpi_monthly_sales": f"""
    SELECT coalesce(year, f.date_key // 10000) AS year, coalesce(month, f.date_key // 100 % 100) AS month,
           coalesce(month_name, '') AS month_name, count(*) AS sale_lines,
           {_sum("CASE WHEN order_state <> 'cancel' THEN amount_total END")} AS amount_total,
           {_sum("CASE WHEN order_state = 'cancel' THEN amount_total END")} AS cancelled_total,
           {_sum("CASE WHEN order_state <> 'cancel' AND is_weekend = 1 THEN amount_total END")} AS weekend_total
    FROM fact_sales f LEFT JOIN calendar d ON d.date_key = f.date_key GROUP BY ALL""",
}

QUERIES["kpi_stock_levels"] = f"""
    SELECT governorate, location_code, category,
           CAST(grouping(governorate) + grouping(location_code) + grouping(category) AS INTEGER) AS level, count(*) AS groups,
           {_sum('on_hand')} AS on_hand, {_sum('inventory_value')} AS inventory_value
    FROM ({QUERIES['kpi_stock_distribution']}) GROUP BY ROLLUP (governorate, location_code, category)"""

# The KPIs again over corrected orders, lines and payments, without the lines that are gone.
_CORRECTED = {
    "fact_sales": """(SELECT * REPLACE (CASE WHEN order_id % 10 = 3 THEN 'cancel' ELSE order_state END AS order_state,
                                  CASE WHEN sale_line_key % 10 = 5 THEN amount_untaxed * 2 ELSE amount_untaxed END AS amount_untaxed,
                                  CASE WHEN sale_line_key % 10 = 5 THEN amount_total * 2 ELSE amount_total END AS amount_total)
                FROM fact_sales WHERE sale_line_key % 50 <> 11) AS corrected_sales""",
    "fact_payments": """(SELECT * REPLACE (CASE WHEN payment_key % 10 = 7 THEN amount * 3 ELSE amount END AS amount)
                   FROM fact_payments) AS corrected_payments""",
}


def _over_corrected(sql: str) -> str:
    for table, rows in _CORRECTED.items():
        sql = sql.replace(f"FROM {table} f ", f"FROM {rows.rpartition(' AS ')[0]} f ").replace(f"FROM {table}\n", f"FROM {rows}\n")
    return sql


QUERIES["kpi_monthly_sales_by_deltas"] = _over_corrected(QUERIES["kpi_monthly_sales"])
QUERIES["kpi_sales_by_governorate_by_deltas"] = _over_corrected(QUERIES["kpi_sales_by_governorate"])

# Extracts and stored tables.
QUERIES |= {
    "extract_full": "SELECT * FROM src_account_payment",
    "extract_inferred": "SELECT * FROM orders",
    "extract_incremental": "SELECT * FROM feed WHERE write_date > TIMESTAMP '2024-01-15 12:00:00'",
    "extract_lookback": "SELECT * FROM feed WHERE write_date > TIMESTAMP '2024-01-13 12:00:00'",
    "extract_ranges": "SELECT o_orderkey, o_orderkey * o_orderkey AS far, o_custkey, o_orderstatus FROM orders",
    "raw_typed": raw_select("stock_quant"),
    "bronze_conform": """
    SELECT * REPLACE (CASE WHEN id % 6 = 0 THEN '' ELSE name END AS name,
                      CASE WHEN id % 6 = 0 THEN NULL ELSE muhafaza_id END AS muhafaza_id,
                      CASE WHEN id % 6 = 0 THEN false ELSE is_company END AS is_company,
                      CASE WHEN id % 6 = 0 THEN NULL ELSE partner_type END AS partner_type) FROM bronze_res_partner""",
    "fact_layout": "SELECT * FROM fact_sales",
    "fact_sales_stored": "SELECT * FROM fact_sales",
    "insert_if_absent": """
    SELECT id, CASE WHEN id % 3 = 0 THEN name || '-new' ELSE name END AS name, state FROM src_order_headers""",
    "seed_dims": """
    SELECT m.id AS muhafaza_id, zone, currency, coalesce(n, 0) AS partners
    FROM (VALUES ('R-0', 'south', 'EGP'), ('R-1', 'west', 'USD'), ('R-2', 'east', 'EGP'), ('R-3', 'north', 'EUR'),
                 ('R-9', 'unused', 'EGP')) AS z(mcode, zone, currency)
    JOIN src_muhafazat m ON m.code = z.mcode
    LEFT JOIN (SELECT muhafaza_id, count(*) AS n FROM src_res_partner GROUP BY muhafaza_id) p ON p.muhafaza_id = m.id""",
    "location_city_lookup": """
    SELECT p.id AS partner_id, p.muhafaza_id,
           (SELECT c.id FROM src_cities c WHERE c.muhafaza_id = p.muhafaza_id AND lower(c.name) = p.city) AS city_id
    FROM silver_res_partner p""",
}

# Mirror.
_FEED_LATEST = _latest("feed", "write_date DESC, event_id DESC")
QUERIES |= {
    "latest_by_key": _FEED_LATEST,
    "mirror_upsert": _FEED_LATEST,
    "mirror_replay": _FEED_LATEST,
    "mirror_compact": _FEED_LATEST,
    "mirror_stream": _FEED_LATEST,
    "mirror_buckets": _FEED_LATEST,
    "mirror_stream_buckets": _FEED_LATEST,
    "mirror_reconcile": f"""
    SELECT l.* FROM ({_FEED_LATEST}) l
    WHERE NOT EXISTS (SELECT 1 FROM feed gone WHERE gone.id % 7 = 3 AND gone.id = l.id)""",
    "mirror_backfill": "SELECT * FROM feed",
    "mirror_full_refresh": "SELECT * FROM src_stock_quant",
    "checkpoint_log": " UNION ALL ".join(
        f"""SELECT 'user_events' AS table_name, (SELECT max(write_date) FROM feed WHERE write_date < TIMESTAMP '{to}') AS last_write_date,
            (SELECT count(*) FROM feed WHERE write_date >= TIMESTAMP '{frm}' AND write_date < TIMESTAMP '{to}') AS rows_loaded"""
        for frm, to in (
            ("1970-01-01", "2024-01-11"),
            ("2024-01-11", "2024-01-21"),
            ("2024-01-21", "9999-01-01"),
            ("9999-01-01", "9999-01-01"),
        )
    ),
    "checkpoint_read": "SELECT max(write_date) AS last_write_date FROM feed WHERE write_date < TIMESTAMP '2024-01-21'",
    "batch_high_water": """
    SELECT max(write_date) AS last_write_date, count(*) AS rows_loaded FROM feed
    WHERE write_date > TIMESTAMP '2024-01-15 12:00:00'""",
}

# Single expressions and operators.
_SUBSET_STEP = "(product_id * 6151 + partner_id % 1000003) % 1000003"


def _subset_draw(i: int) -> str:
    """The i-th choice of a request: a number up to m - k + i, or that itself if the number is taken."""
    taken = f"list_contains([{', '.join(f'c{j}' for j in range(i))}], drawn)" if i else "false"
    mixed = f"((order_id % 2147483647) * 48271 + {i * 1664525 + 1}) % 2147483647"
    return f"""(SELECT *, CASE WHEN {taken} THEN m - k + {i} ELSE drawn END AS c{i}
        FROM (SELECT * EXCLUDE (drawn), (mixed * 48271 + mixed // 65536) % 2147483647 % greatest(m - k + {i + 1}, 1) AS drawn
              FROM (SELECT * EXCLUDE (mixed), {mixed} AS mixed FROM <rows>)))"""


def _subset_draws() -> str:
    sql = """(SELECT id AS order_id, partner_id, m, least(1 + id % 5, m) AS k, 0::BIGINT AS mixed, 0::BIGINT AS drawn
        FROM src_purchase_order JOIN (SELECT partner_id, count(*) AS m FROM src_product_supplierinfo GROUP BY partner_id) USING (partner_id))"""
    for i in range(5):
        sql = _subset_draw(i).replace("<rows>", sql)
    return sql


_STEP = "((product_id % 1000003) * 6007 + (partner_id % 1000003) * 90001) % 1000003"
QUERIES |= {
    **{f"clean_{c}": f"SELECT id, {c} AS raw, {rule} AS cleaned FROM src_res_partner" for c, rule in CLEAN.items()},
    "partner_union": "SELECT id, name, partner_type, city_id, muhafaza_id FROM src_res_partner",
    "date_key": f"""
    SELECT id, {DATE_KEY.format('date_order')} AS date_key, CAST(isodow(date_order) AS INTEGER) AS day_of_week
    FROM src_order_headers""",
    "line_amounts": """
    SELECT id, CAST(round(net, 2) AS DECIMAL(14,2)) AS price_subtotal,
           CAST(round(net * CAST(1 + (id % 16) * 0.01 AS DECIMAL(4,2)), 2) AS DECIMAL(14,2)) AS price_total
    FROM (SELECT id, product_uom_qty * price_unit * CAST(1 - discount * 0.01 AS DECIMAL(5,4)) AS net FROM src_sale_order_line)""",
    "payment_date_offset": """
    SELECT id, CAST(k AS INTEGER) AS k, date_order + to_days(CAST(k * 14 + id % 9 AS INTEGER)) AS due
    FROM src_order_headers, LATERAL (SELECT unnest(generate_series(1, id % 3)) AS k)""",
    "code_format": """
    SELECT id, name AS code, left(name, 3) AS head, right(name, 4) AS tail, lower(name) AS lowered FROM src_order_headers""",
    "category_path": "SELECT p_type || ' / ' || p_brand AS path, count(*) AS parts FROM part GROUP BY 1",
    "variant_name": "SELECT id, name, color, size FROM src_product_product",
    "explode_series": """
    SELECT id, CAST(k AS INTEGER) AS k FROM src_order_headers, LATERAL (SELECT unnest(generate_series(1, id % 3)) AS k)""",
    "sample_k_per_group": f"""
    SELECT order_id, r.partner_id, CAST(pick AS INTEGER) AS pick, i.product_id, i.price
    FROM (SELECT id AS order_id, partner_id, m, (id % 1000003) * 6007 % 1000003 AS start,
                 unnest(generate_series(1, least(1 + id % 5, m))) AS pick
          FROM src_purchase_order JOIN (SELECT partner_id, count(*) AS m FROM src_product_supplierinfo GROUP BY partner_id)
          USING (partner_id)) r
    JOIN (SELECT *, row_number() OVER (PARTITION BY partner_id ORDER BY {_STEP} % 64, {_STEP}, product_id) AS pos
          FROM src_product_supplierinfo) i
      ON i.partner_id = r.partner_id AND i.pos = (r.start + r.pick - 1) % r.m + 1""",
    "sample_k_subset": f"""
    SELECT order_id, r.partner_id, CAST(pick AS INTEGER) AS pick, i.product_id, i.price
    FROM (SELECT order_id, partner_id, unnest(generate_series(1, k)) AS pick, [c0, c1, c2, c3, c4] AS chosen FROM {_subset_draws()}) r
    JOIN (SELECT *, row_number() OVER (PARTITION BY partner_id ORDER BY {_SUBSET_STEP} % 64, {_SUBSET_STEP}, product_id) AS pos
          FROM src_product_supplierinfo) i
      ON i.partner_id = r.partner_id AND i.pos = r.chosen[r.pick] + 1""",
    "order_rollup": "SELECT id, amount_untaxed, amount_tax, amount_total FROM src_sale_order",
    "purchase_rollup": "SELECT id, amount_untaxed, amount_tax, amount_total FROM src_purchase_order",
}


def all_queries() -> dict[str, str]:
    return {name: complete(sql) for name, sql in QUERIES.items()}
