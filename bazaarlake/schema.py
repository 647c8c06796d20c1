"""The 14 source tables: columns, mirror types, keys and constraints.

A column is written ``name type`` with ``!`` for NOT NULL. Every table also carries ``create_date`` and
``write_date``; ``write_date`` is the incremental cursor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names, types and nullability of the source tables.
SOURCE_COLUMNS = {
    "muhafazat": "id int!, name string!, name_ar string!, code string!",
    "cities": "id int!, muhafaza_id int!, name string!, name_ar string",
    "res_partner": (
        "id bigint!, name string!, email string, phone string, street string, city string, city_id int, "
        "muhafaza_id int!, is_company boolean!, partner_type string!, segment string, active boolean!"
    ),
    "product_category": "id int!, name string!, parent_id int, complete_name string!",
    "product_template": (
        "id bigint!, name string!, categ_id int!, default_code string!, list_price decimal(12,2)!, "
        "standard_price decimal(12,2)!, type string!, active boolean!"
    ),
    "product_product": (
        "id bigint!, product_tmpl_id bigint!, default_code string!, barcode string, name string!, color string, "
        "size string, price_extra decimal(12,2)!, active boolean!"
    ),
    "product_supplierinfo": (
        "id bigint!, product_id bigint!, partner_id bigint!, price decimal(12,2)!, min_qty decimal(12,3)!, delay int!"
    ),
    "stock_location": (
        "id int!, name string!, code string!, location_type string!, muhafaza_id int, city_id int"
    ),
    "stock_quant": (
        "id bigint!, product_id bigint!, location_id int!, quantity decimal(12,3)!, reserved_quantity decimal(12,3)!"
    ),
    "sale_order": (
        "id bigint!, name string!, partner_id bigint!, location_id int!, date_order timestamp!, state string!, "
        "amount_untaxed decimal(14,2)!, amount_tax decimal(14,2)!, amount_total decimal(14,2)!"
    ),
    "sale_order_line": (
        "id bigint!, order_id bigint!, product_id bigint!, product_uom_qty decimal(12,3)!, price_unit decimal(12,2)!, "
        "discount decimal(5,2)!, price_subtotal decimal(14,2)!, price_total decimal(14,2)!"
    ),
    "account_payment": (
        "id bigint!, name string!, partner_id bigint!, sale_order_id bigint!, amount decimal(14,2)!, "
        "payment_type string!, partner_type string!, journal string!, payment_method string!, state string!, "
        "payment_date timestamp"
    ),
    "purchase_order": (
        "id bigint!, name string!, partner_id bigint!, location_id int, date_order timestamp!, state string!, "
        "amount_untaxed decimal(14,2)!, amount_tax decimal(14,2)!, amount_total decimal(14,2)!"
    ),
    "purchase_order_line": (
        "id bigint!, order_id bigint!, product_id bigint!, product_qty decimal(12,3)!, price_unit decimal(12,2)!, "
        "price_subtotal decimal(14,2)!, price_total decimal(14,2)!"
    ),
}
AUDIT_COLUMNS = "create_date timestamp!, write_date timestamp!"

# The nine tables of the full-refresh and inferred-raw variants.
REFRESH_TABLES = (
    "sale_order",
    "sale_order_line",
    "res_partner",
    "product_product",
    "product_template",
    "product_category",
    "stock_location",
    "cities",
    "muhafazat",
)

# What the bronze tables declare NOT NULL, apart from the id; everything else there may be NULL.
BRONZE_REQUIRED = {
    "muhafazat": ("name",),
    "cities": ("muhafaza_id",),
    "res_partner": ("name", "is_company", "active"),
    "product_category": ("name",),
    "product_template": ("name",),
    "product_product": ("product_tmpl_id",),
    "stock_location": ("name",),
    "sale_order": (
        "name", "partner_id", "location_id", "date_order", "state", "amount_untaxed", "amount_tax", "amount_total",
        "create_date", "write_date",
    ),
    "sale_order_line": (
        "order_id", "product_id", "product_uom_qty", "price_unit", "discount", "price_subtotal", "price_total",
        "create_date", "write_date",
    ),
}

# Mirror types: money and quantities widen to (18,4), the discount percent to (9,4).
MIRROR_DECIMAL = "decimal(18,4)"
MIRROR_DISCOUNT = "decimal(9,4)"


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool

    @property
    def mirror_type(self) -> str:
        if self.name == "discount":
            return MIRROR_DISCOUNT
        return MIRROR_DECIMAL if self.type.startswith("decimal") else self.type


def columns(table: str) -> list[Column]:
    out = []
    for item in f"{SOURCE_COLUMNS[table]}, {AUDIT_COLUMNS}".split(", "):
        name, type_ = item.split(" ")
        out.append(Column(name, type_.rstrip("!"), type_.endswith("!")))
    return out


def struct(table: str, mirror: bool = False) -> T.StructType:
    return T.StructType(
        [
            T.StructField(c.name, T.DataType.fromDDL(c.mirror_type if mirror else c.type), not c.required)
            for c in columns(table)
        ]
    )


TABLES = tuple(SOURCE_COLUMNS)

CHECKPOINT_SCHEMA = "table_name string, last_write_date timestamp, rows_loaded bigint, run_ts timestamp"

# Declared constraints.
FOREIGN_KEYS = (
    ("cities", "muhafaza_id", "muhafazat"),
    ("res_partner", "city_id", "cities"),
    ("res_partner", "muhafaza_id", "muhafazat"),
    ("product_category", "parent_id", "product_category"),
    ("product_template", "categ_id", "product_category"),
    ("product_product", "product_tmpl_id", "product_template"),
    ("product_supplierinfo", "product_id", "product_product"),
    ("product_supplierinfo", "partner_id", "res_partner"),
    ("stock_location", "muhafaza_id", "muhafazat"),
    ("stock_location", "city_id", "cities"),
    ("stock_quant", "product_id", "product_product"),
    ("stock_quant", "location_id", "stock_location"),
    ("sale_order", "partner_id", "res_partner"),
    ("sale_order", "location_id", "stock_location"),
    ("sale_order_line", "order_id", "sale_order"),
    ("sale_order_line", "product_id", "product_product"),
    ("account_payment", "partner_id", "res_partner"),
    ("account_payment", "sale_order_id", "sale_order"),
    ("purchase_order", "partner_id", "res_partner"),
    ("purchase_order", "location_id", "stock_location"),
    ("purchase_order_line", "order_id", "purchase_order"),
    ("purchase_order_line", "product_id", "product_product"),
)

UNIQUE_KEYS = tuple((t, ("id",)) for t in TABLES) + (
    ("muhafazat", ("code",)),
    ("cities", ("muhafaza_id", "name")),
    ("product_category", ("complete_name",)),
    ("product_template", ("default_code",)),
    ("product_product", ("default_code",)),
    ("product_product", ("barcode",)),
    ("product_supplierinfo", ("product_id", "partner_id")),
    ("stock_location", ("code",)),
    ("sale_order", ("name",)),
    ("account_payment", ("name",)),
    ("purchase_order", ("name",)),
)

# (table, label, condition that must hold; NULL passes as in a SQL CHECK)
VALUE_CHECKS = (
    ("res_partner", "partner_type", "partner_type IN ('customer', 'vendor')"),
    ("product_template", "list_price", "list_price >= 0"),
    ("product_template", "standard_price", "standard_price >= 0"),
    ("product_supplierinfo", "price", "price >= 0"),
    ("stock_quant", "quantity", "quantity >= 0"),
    ("sale_order_line", "product_uom_qty", "product_uom_qty > 0"),
    ("sale_order_line", "price_unit", "price_unit >= 0"),
    ("sale_order_line", "discount", "discount BETWEEN 0 AND 100"),
    ("account_payment", "amount", "amount >= 0"),
    ("purchase_order_line", "product_qty", "product_qty > 0"),
    ("purchase_order_line", "price_unit", "price_unit >= 0"),
)

# Accepted values the source names only in comments.
ACCEPTED_STATES = (
    ("stock_location", "location_type", ("warehouse", "store", "transit")),
    ("sale_order", "state", ("draft", "sent", "sale", "done", "cancel")),
    ("account_payment", "state", ("draft", "posted", "sent", "reconciled", "cancelled")),
    ("purchase_order", "state", ("draft", "sent", "purchase", "done", "cancel")),
)
