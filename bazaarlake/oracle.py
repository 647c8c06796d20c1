"""Reference SQL (DuckDB dialect) for every registered query, on the same parquet tables.

``VIEWS`` repeats the source formulas, the mirror rules and the tables built on them. ``complete`` puts the views
a statement mentions in front of it; the statements are in ``oracle_queries``.
"""

from __future__ import annotations

import re

from bazaarlake import schema

BASE = "TIMESTAMP '1995-01-01 00:00:00'"
VENDOR = "1000000000000000"


def _days(n: str) -> str:
    return f"({BASE} + to_days(CAST({n} AS INTEGER)))"


def _pad(prefix: str, number: str, width: int) -> str:
    return (
        f"'{prefix}' || lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR)))"
        f" AS INTEGER), '0')"
    )


def _initcap(s: str) -> str:
    words = f"regexp_extract_all(lower({s}), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


def _phone(c: str) -> str:
    d = _digits(c)
    return f"""CASE WHEN {d} LIKE '20%' AND length({d}) = 12 THEN '+' || {d}
                    WHEN {d} LIKE '0%' AND length({d}) = 11 THEN '+20' || substr({d}, 2)
                    WHEN {d} LIKE '1%' AND length({d}) = 10 THEN '+20' || {d} END"""


CLEAN = {
    "name": _initcap(r"trim(regexp_replace(name, '\s+', ' ', 'g'))"),
    "email": "nullif(lower(trim(email)), '')",
    "phone": _phone("phone"),
    "street": "nullif(trim(street), '')",
    "city": "nullif(lower(trim(city)), '')",
}


def _columns(table: str, mirror: bool) -> str:
    out = []
    for c in schema.columns(table):
        value = CLEAN.get(c.name, c.name) if mirror and table == "res_partner" else c.name
        out.append(f"CAST({value} AS {c.mirror_type if mirror else c.type}) AS {c.name}")
    return ", ".join(out)


# What stands for NULL in columns that bronze declares NOT NULL.
_BRONZE_DEFAULTS = {
    "muhafazat": {"name": "''"},
    "cities": {"muhafaza_id": "0"},
    "res_partner": {"name": "''", "is_company": "false", "active": "false"},
    "product_category": {"name": "''"},
    "product_template": {"name": "''"},
    "product_product": {"product_tmpl_id": "0"},
    "stock_location": {"name": "''"},
    "sale_order": {"name": "''", "partner_id": "0", "location_id": "0", "state": "''"}
    | {c: "0" for c in ("amount_untaxed", "amount_tax", "amount_total")},
    "sale_order_line": {c: "0" for c in ("order_id", "product_id", "product_uom_qty", "price_unit", "discount")}
    | {c: "0" for c in ("price_subtotal", "price_total")},
}


def _bronze(table: str) -> str:
    out = []
    defaults = _BRONZE_DEFAULTS[table]
    for c in schema.columns(table):
        value = f"coalesce({c.name}, {defaults[c.name]})" if c.name in defaults else c.name
        out.append(f"CAST({value} AS {c.type}) AS {c.name}")
    return f"SELECT {', '.join(out)} FROM src_{table}"


def raw_select(table: str) -> str:
    def loose(t: str) -> str:
        if t in ("int", "bigint"):
            return "BIGINT"
        return "DOUBLE" if t.startswith("decimal") else t

    cols = ", ".join(f"CAST({c.name} AS {loose(c.type)}) AS {c.name}" for c in schema.columns(table))
    return f"SELECT {cols} FROM src_{table}"


_LINE_AMOUNTS = """
    SELECT *, CAST(round(net * (1.00 + tax), 2) AS DECIMAL(14,2)) AS total,
           CAST(CAST((CAST(net * 100 AS BIGINT) * 2 + qty) // (qty * 2) AS DECIMAL(14,0)) * 0.01 AS DECIMAL(12,2)) AS unit
    FROM (SELECT row_number() OVER () AS id, *, CAST(l_extendedprice AS DECIMAL(14,2)) AS net,
                 CAST(l_quantity AS BIGINT) AS qty, CAST(l_tax AS DECIMAL(5,2)) AS tax FROM lineitem)"""

VIEWS = {
    "src_muhafazat": f"""
    SELECT r_regionkey AS id, r_name AS name, r_name AS name_ar, 'R-' || r_regionkey AS code,
           {BASE} AS create_date, {BASE} AS write_date FROM region""",
    "src_cities": f"""
    SELECT n_nationkey AS id, n_regionkey AS muhafaza_id, n_name AS name,
           CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS name_ar,
           {BASE} AS create_date, {BASE} AS write_date FROM nation""",
    "src_customers": f"""
    SELECT c_custkey AS id, CASE WHEN shouted THEN upper(full_name) ELSE full_name END AS name,
           CASE WHEN cents % 11 <> 0 THEN indent || CASE WHEN shouted THEN upper(mailbox) ELSE mailbox END END AS email,
           CASE n_nationkey % 4 WHEN 0 THEN '010' || number
                WHEN 1 THEN '+20 10 ' || left(number, 4) || ' ' || right(number, 4)
                WHEN 2 THEN '010-' || left(number, 4) || '-' || right(number, 4) END AS phone,
           CASE WHEN cents % 7 = 0 THEN indent ELSE n_name || ' road ' || (c_custkey % 90 + 1) END AS street,
           CASE n_regionkey WHEN 0 THEN lower(n_name) WHEN 1 THEN indent || n_name WHEN 2 THEN NULL ELSE n_name END AS city,
           CASE WHEN cents % 4 <> 1 THEN n_nationkey END AS city_id, n_regionkey AS muhafaza_id,
           c_acctbal >= 5000 AS is_company, 'customer' AS partner_type, c_mktsegment AS segment, cents % 10 <> 3 AS active,
           {_days('c_custkey % 1500')} AS create_date, {_days('c_custkey % 1500 + cents % 365')} AS write_date
    FROM (SELECT *, n_nationkey % 2 = 1 AS shouted,
                 indent || lower(c_mktsegment) || gap || 'buyer' || gap || c_custkey || indent AS full_name,
                 'desk' || (c_custkey // 3) || '@' || lower(c_mktsegment) || '.example' AS mailbox,
                 lpad(CAST((c_custkey * 31 + cents) % 100000000 AS VARCHAR), 8, '0') AS number
          FROM (SELECT *, CASE WHEN cents % 3 = 0 THEN '   ' ELSE ' ' END AS gap,
                       CASE WHEN cents % 2 = 0 THEN '  ' ELSE '' END AS indent
                FROM (SELECT *, CAST(abs(round(c_acctbal * 100)) AS BIGINT) AS cents
                      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)))""",
    "src_vendors": f"""
    SELECT s_suppkey + {VENDOR} AS id, lower(replace(s_name, '#', ' no. ')) AS name,
           'orders@' || lower(replace(s_name, '#', '')) || '.example' AS email,
           '0' || (40 + n_nationkey) || ' ' || lpad(CAST(cents % 10000000 AS VARCHAR), 7, '0') AS phone,
           'Dock ' || (s_suppkey % 12 + 1) || ', ' || n_name AS street, n_name AS city, n_nationkey AS city_id,
           n_regionkey AS muhafaza_id, true AS is_company, 'vendor' AS partner_type, CAST(NULL AS VARCHAR) AS segment,
           cents % 40 <> 7 AS active, {_days('s_suppkey % 1500')} AS create_date,
           {_days('s_suppkey % 1500 + n_nationkey')} AS write_date
    FROM (SELECT *, CAST(abs(round(s_acctbal * 100)) AS BIGINT) AS cents
          FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "src_res_partner": "SELECT * FROM src_customers UNION ALL BY NAME SELECT * FROM src_vendors",
    "src_product_category": f"""
    SELECT *, {BASE} AS create_date, {BASE} AS write_date FROM (
        SELECT CAST(min(p_partkey) * 2 + 1 AS INTEGER) AS id, p_type AS name, CAST(NULL AS INTEGER) AS parent_id,
               p_type AS complete_name FROM part GROUP BY p_type
        UNION ALL
        SELECT CAST(min(p_partkey) * 2 + 2 AS INTEGER), p_brand, CAST(any_value(top) * 2 + 1 AS INTEGER),
               p_type || ' / ' || p_brand
        FROM part JOIN (SELECT p_type, min(p_partkey) AS top FROM part GROUP BY p_type) USING (p_type)
        GROUP BY p_type, p_brand)""",
    "src_parts": """
    SELECT *, p_partkey // 3 AS tmpl, CAST(p_retailprice AS DECIMAL(12,2)) AS own_price,
           row_number() OVER (PARTITION BY p_partkey // 3 ORDER BY p_partkey) AS place,
           first_value(p_name) OVER (PARTITION BY p_partkey // 3 ORDER BY p_partkey) || ' ' || (p_partkey // 3) AS tmpl_name,
           min(CAST(p_retailprice AS DECIMAL(12,2))) OVER (PARTITION BY p_partkey // 3) AS list_price
    FROM part""",
    "src_product_template": f"""
    SELECT tmpl AS id, tmpl_name AS name, c.id AS categ_id, {_pad('M', 'tmpl', 9)} AS default_code, list_price,
           CAST(round(list_price * 0.60, 2) AS DECIMAL(12,2)) AS standard_price, 'product' AS type,
           tmpl % 18 <> 4 AS active, {_days('tmpl % 911')} AS create_date, {_days('tmpl % 911 + tmpl % 37')} AS write_date
    FROM src_parts LEFT JOIN (SELECT id, complete_name FROM src_product_category) c
      ON c.complete_name = CASE WHEN tmpl % 25 = 0 THEN p_type ELSE p_type || ' / ' || p_brand END
    WHERE place = 1""",
    "src_product_product": f"""
    SELECT p_partkey AS id, tmpl AS product_tmpl_id, {_pad('V', 'p_partkey', 9)} AS default_code,
           CASE WHEN p_size % 16 <> 0 THEN {_pad('4', 'p_partkey', 12)} END AS barcode,
           tmpl_name || CASE WHEN color IS NOT NULL THEN ' - ' || color ELSE '' END
                     || CASE WHEN size IS NOT NULL THEN ' / ' || size ELSE '' END AS name,
           color, size, CAST(own_price - list_price AS DECIMAL(12,2)) AS price_extra,
           tmpl % 18 <> 4 AND p_size <> 13 AS active,
           {_days('tmpl % 911')} AS create_date, {_days('tmpl % 911 + tmpl % 37')} AS write_date
    FROM (SELECT *, CASE WHEN p_partkey % 7 <> 0 THEN split_part(p_name, ' ', 1) END AS color,
                 CASE WHEN p_partkey % 5 >= 2 THEN 'SZ' || p_size END AS size FROM src_parts)""",
    "src_amounts": _LINE_AMOUNTS,
    "src_product_supplierinfo": f"""
    SELECT id, l_partkey AS product_id, l_suppkey + {VENDOR} AS partner_id,
           CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.60 * CAST((90 + l_suppkey % 5 * 5) * 0.01 AS DECIMAL(5,2)), 2)
                AS DECIMAL(12,2)) AS price,
           CAST(6 * (1 + l_partkey % 4) AS DECIMAL(12,3)) AS min_qty, CAST(2 + l_suppkey % 21 AS INTEGER) AS delay,
           {BASE} AS create_date, {BASE} AS write_date
    FROM (SELECT min(id) AS id, l_partkey, l_suppkey FROM src_amounts GROUP BY l_partkey, l_suppkey)
    LEFT JOIN part ON l_partkey = p_partkey""",
    "src_stock_location": f"""
    SELECT CAST(r_regionkey * 3 + k AS INTEGER) AS id, r_name || ' ' || kind AS name, prefix || r_regionkey AS code,
           kind AS location_type, r_regionkey AS muhafaza_id,
           CASE k WHEN 0 THEN first_city WHEN 1 THEN last_city END AS city_id,
           {BASE} AS create_date, {BASE} AS write_date
    FROM region LEFT JOIN (SELECT n_regionkey, min(n_nationkey) AS first_city, max(n_nationkey) AS last_city
                           FROM nation GROUP BY n_regionkey) ON n_regionkey = r_regionkey
    CROSS JOIN (VALUES (0, 'warehouse', 'depot-'), (1, 'store', 'shop-'), (2, 'transit', 'van-')) AS t(k, kind, prefix)""",
    "src_stock_quant": f"""
    SELECT p_partkey * 3 + k AS id, p_partkey AS product_id, CAST((p_partkey + k * 4) % 15 AS INTEGER) AS location_id,
           CAST((p_size * 17 + k * 90) % 400 AS DECIMAL(12,3)) AS quantity,
           CAST(CAST((p_size * 17 + k * 90) % 400 AS DECIMAL(12,3)) * 0.25 AS DECIMAL(12,3)) AS reserved_quantity,
           {_days('p_partkey % 911')} AS create_date, {_days('(p_partkey % 911) + k')} AS write_date
    FROM part, LATERAL (SELECT unnest(generate_series(1, 1 + p_size % 3)) AS k)""",
    "src_order_headers": f"""
    SELECT o_orderkey AS id, {_pad('S', 'o_orderkey', 8)} AS name, o_custkey AS partner_id,
           CAST(o_orderkey % 15 AS INTEGER) AS location_id, o_orderdate AS date_order,
           CASE WHEN o_orderkey % 12 = 0 THEN 'cancel' WHEN o_orderkey % 12 = 1 THEN 'sent'
                WHEN o_orderstatus = 'O' THEN 'sale' WHEN o_orderstatus = 'F' THEN 'done' ELSE 'draft' END AS state,
           o_orderdate AS create_date, o_orderdate AS write_date FROM orders""",
    "src_sale_order": """
    SELECT h.*, CAST(coalesce(net, 0) AS DECIMAL(14,2)) AS amount_untaxed,
           CAST(coalesce(total - net, 0) AS DECIMAL(14,2)) AS amount_tax,
           CAST(coalesce(total, 0) AS DECIMAL(14,2)) AS amount_total
    FROM src_order_headers h LEFT JOIN (
        SELECT order_id, CAST(sum(price_subtotal) AS DECIMAL(14,2)) AS net, CAST(sum(price_total) AS DECIMAL(14,2)) AS total
        FROM src_sale_order_line GROUP BY order_id) l ON l.order_id = h.id""",
    "src_sale_order_line": """
    SELECT id, l_orderkey AS order_id, l_partkey AS product_id, CAST(qty AS DECIMAL(12,3)) AS product_uom_qty,
           unit AS price_unit, CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount,
           net AS price_subtotal, total AS price_total, l_shipdate AS create_date, l_shipdate AS write_date
    FROM src_amounts""",
    "src_account_payment": f"""
    SELECT id * 4 + k AS id, {_pad('R', 'id', 8)} || '-' || k AS name, partner_id, id AS sale_order_id,
           CAST(CAST(cents // n_due + CASE WHEN k = n_due THEN cents % n_due ELSE 0 END AS DECIMAL(14,0)) * 0.01
                AS DECIMAL(14,2)) AS amount, 'inbound' AS payment_type, 'customer' AS partner_type,
           CASE WHEN k = 1 THEN 'bank' ELSE 'cash' END AS journal,
           CASE WHEN state = 'done' THEN 'electronic' ELSE 'manual' END AS payment_method,
           CASE WHEN state = 'sent' THEN 'draft' WHEN k < n_due THEN 'posted' ELSE 'reconciled' END AS state,
           CASE WHEN state <> 'sent' THEN date_order + to_days(CAST(k * 30 AS INTEGER)) END AS payment_date,
           create_date, write_date
    FROM (SELECT *, n_pay + CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS n_due
          FROM (SELECT *, CAST(amount_total * 100 AS BIGINT) AS cents,
                       CASE state WHEN 'cancel' THEN 0 WHEN 'draft' THEN 0 WHEN 'sent' THEN id % 2 ELSE id % 4 END AS n_pay
                FROM src_sale_order)), LATERAL (SELECT unnest(generate_series(1, n_pay)) AS k)""",
    "src_purchase_order_line": """
    SELECT id, l_suppkey * 100000 + year(l_shipdate) * 12 + month(l_shipdate) AS order_id, l_partkey AS product_id,
           CAST(qty AS DECIMAL(12,3)) AS product_qty, unit AS price_unit, net AS price_subtotal, total AS price_total,
           l_shipdate AS create_date, l_shipdate AS write_date FROM src_amounts""",
    "src_purchase_order": f"""
    SELECT *, CASE id % 9 WHEN 4 THEN 'cancel' WHEN 5 THEN 'draft' WHEN 6 THEN 'sent'
                   ELSE CASE WHEN id % 2 = 0 THEN 'done' ELSE 'purchase' END END AS state,
           date_order AS create_date, date_order AS write_date
    FROM (SELECT order_id AS id, {_pad('PO', 'order_id', 7)} AS name, any_value(l_suppkey) + {VENDOR} AS partner_id,
                 CASE WHEN order_id % 8 <> 3 THEN CAST(order_id % 15 AS INTEGER) END AS location_id,
                 date_trunc('month', min(l_shipdate))::TIMESTAMP AS date_order,
                 CAST(sum(net) AS DECIMAL(14,2)) AS amount_untaxed,
                 CAST(sum(total) - sum(net) AS DECIMAL(14,2)) AS amount_tax, CAST(sum(total) AS DECIMAL(14,2)) AS amount_total
          FROM (SELECT *, l_suppkey * 100000 + year(l_shipdate) * 12 + month(l_shipdate) AS order_id FROM src_amounts)
          GROUP BY order_id)""",
    "feed": """
    SELECT user_id AS id, ts AS write_date, event_id, event_type, CAST(value AS DECIMAL(18,4)) AS value FROM events""",
}
for _t in schema.TABLES:
    VIEWS[f"silver_{_t}"] = f"SELECT {_columns(_t, True)} FROM src_{_t}"

_PARTNER = """coalesce(nullif(c.name, ''), p.city, '') AS city, coalesce(m.name, '') AS governorate,
           coalesce(m.name_ar, '') AS governorate_ar, coalesce(m.code, '') AS governorate_code
    FROM silver_res_partner p LEFT JOIN silver_cities c ON p.city_id = c.id
    LEFT JOIN silver_muhafazat m ON p.muhafaza_id = m.id"""
DATE_KEY = "CAST(strftime({}, '%Y%m%d') AS INTEGER)"

VIEWS |= {
    "dim_customer": f"""
    SELECT p.id AS customer_key, p.name AS customer_name, p.email, p.phone, p.segment, p.is_company, {_PARTNER}
    WHERE p.partner_type = 'customer'""",
    "dim_vendor": f"""
    SELECT p.id AS vendor_key, p.name AS vendor_name, p.email, p.phone, p.is_company, {_PARTNER}
    WHERE p.partner_type = 'vendor'""",
    "category_parent": """
    SELECT c.id AS category_id, c.name AS category_name, c.complete_name AS category_path,
           coalesce(p.name, '') AS parent_category
    FROM silver_product_category c LEFT JOIN silver_product_category p ON c.parent_id = p.id""",
    "dim_product": """
    SELECT pp.id AS product_key, pp.default_code AS variant_code, pp.barcode, pp.name AS variant_name, pp.color, pp.size,
           coalesce(pt.id, 0) AS template_id, coalesce(pt.name, '') AS template_name, coalesce(pt.type, '') AS product_type,
           CAST(coalesce(pt.list_price, 0) AS DECIMAL(18,4)) AS list_price,
           CAST(coalesce(pt.standard_price, 0) AS DECIMAL(18,4)) AS standard_price,
           CAST(coalesce(pt.list_price, 0) + pp.price_extra AS DECIMAL(18,4)) AS variant_list_price,
           coalesce(category_name, '') AS category_name, coalesce(category_path, '') AS category_path,
           coalesce(parent_category, '') AS parent_category
    FROM silver_product_product pp LEFT JOIN silver_product_template pt ON pp.product_tmpl_id = pt.id
    LEFT JOIN category_parent ON pt.categ_id = category_id""",
    "dim_location": """
    SELECT l.id AS location_key, l.code AS location_code, l.name AS location_name, l.location_type,
           coalesce(c.name, '') AS city, coalesce(m.name, '') AS governorate, coalesce(m.name_ar, '') AS governorate_ar
    FROM silver_stock_location l LEFT JOIN silver_cities c ON l.city_id = c.id
    LEFT JOIN silver_muhafazat m ON l.muhafaza_id = m.id""",
    "calendar": f"""
    SELECT {DATE_KEY.format('d')} AS date_key, d AS date, CAST(day(d) AS INTEGER) AS day,
           CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
           CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
           CAST(isodow(d) IN (5, 6) AS INTEGER) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""",
    "fact_sales": f"""
    SELECT l.id AS sale_line_key, o.id AS order_id, o.name AS order_name, {DATE_KEY.format('o.date_order')} AS date_key,
           o.partner_id AS customer_key, l.product_id AS product_key, o.location_id AS location_key,
           o.state AS order_state, l.product_uom_qty AS quantity, l.price_unit AS unit_price, l.discount AS discount_pct,
           l.price_subtotal AS amount_untaxed, CAST(l.price_total - l.price_subtotal AS DECIMAL(18,4)) AS tax_amount,
           l.price_total AS amount_total
    FROM silver_sale_order_line l JOIN silver_sale_order o ON l.order_id = o.id""",
    "fact_payments": f"""
    SELECT id AS payment_key, name AS payment_name, sale_order_id AS order_id, partner_id AS customer_key,
           {DATE_KEY.format('coalesce(payment_date, create_date)')} AS date_key, amount, payment_type, journal,
           payment_method, state AS payment_state FROM silver_account_payment""",
    "fact_purchases": f"""
    SELECT l.id AS purchase_line_key, o.id AS order_id, o.name AS order_name, {DATE_KEY.format('o.date_order')} AS date_key,
           o.partner_id AS vendor_key, l.product_id AS product_key, o.location_id AS location_key,
           o.state AS order_state, l.product_qty AS quantity, l.price_unit AS unit_cost,
           l.price_subtotal AS amount_untaxed, CAST(l.price_total - l.price_subtotal AS DECIMAL(18,4)) AS tax_amount,
           l.price_total AS amount_total
    FROM silver_purchase_order_line l JOIN silver_purchase_order o ON l.order_id = o.id""",
    "fact_inventory": """
    SELECT q.id AS quant_key, q.product_id AS product_key, q.location_id AS location_key, q.quantity AS on_hand_qty,
           q.reserved_quantity AS reserved_qty, CAST(q.quantity - q.reserved_quantity AS DECIMAL(18,4)) AS available_qty,
           CAST(q.quantity * coalesce(t.standard_price, 0) AS DECIMAL(18,4)) AS inventory_value
    FROM silver_stock_quant q LEFT JOIN silver_product_product p ON q.product_id = p.id
    LEFT JOIN silver_product_template t ON p.product_tmpl_id = t.id""",
}

for _t in schema.REFRESH_TABLES:
    VIEWS[f"bronze_{_t}"] = _bronze(_t)
    VIEWS[f"raw_{_t}"] = raw_select(_t)
VIEWS |= {
    "active_customers": """
    SELECT p.id AS customer_id, p.name AS customer_name, coalesce(p.email, '') AS email, coalesce(p.phone, '') AS phone,
           coalesce(p.street, '') AS street, coalesce(c.name, '') AS city_name, coalesce(m.name, '') AS muhafaza_name,
           p.is_company, p.partner_type, coalesce(p.segment, '') AS segment, p.active
    FROM bronze_res_partner p LEFT JOIN bronze_cities c ON p.city_id = c.id
    LEFT JOIN bronze_muhafazat m ON p.muhafaza_id = m.id WHERE p.active""",
    "active_products": """
    SELECT pp.id AS product_id, coalesce(pt.name, '') AS product_name, coalesce(pp.default_code, '') AS default_code,
           coalesce(pp.barcode, '') AS barcode, coalesce(pp.color, '') AS color, coalesce(pp.size, '') AS size,
           coalesce(pc.name, '') AS category_name, CAST(coalesce(pt.list_price, 0) AS DECIMAL(12,2)) AS list_price,
           CAST(coalesce(pt.standard_price, 0) AS DECIMAL(12,2)) AS standard_price,
           coalesce(pt.type, '') AS product_type, pp.active
    FROM bronze_product_product pp LEFT JOIN bronze_product_template pt ON pp.product_tmpl_id = pt.id
    LEFT JOIN bronze_product_category pc ON pt.categ_id = pc.id WHERE pp.active""",
    "sales": """
    SELECT l.id AS sale_line_id, o.id AS order_id, o.partner_id AS customer_id, o.location_id, o.date_order,
           o.state AS order_state, l.product_id, l.product_uom_qty, l.price_unit, l.discount, l.price_subtotal, l.price_total
    FROM bronze_sale_order_line l JOIN bronze_sale_order o ON l.order_id = o.id""",
}


def complete(sql: str) -> str:
    """The statement preceded by the views it mentions, directly or through other views."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        for word in set(re.findall(r"\w+", todo.pop())) & VIEWS.keys() - needed:
            needed.add(word)
            todo.append(VIEWS[word])
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in _ordered(needed)) + "\n" + sql


def _ordered(names: set[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for word in re.findall(r"\w+", VIEWS[name]):
            if word in names and word != name:
                visit(word)
        done.append(name)

    for name in VIEWS:
        if name in names:
            visit(name)
    return done
