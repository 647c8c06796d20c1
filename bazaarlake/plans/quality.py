"""Data-quality checks. Each gives one row per rule with the number of offending rows, 0 included.

``tables`` is a function from table name to a source frame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake import schema
from bazaarlake.operators.key_bitmaps import KeyBitmaps, has_bit
from bazaarlake.operators.rollup import line_totals, union_all

Tables = Callable[[str], DataFrame]


def _per_rule(rules: list, found: DataFrame, labels: dict[str, Callable]) -> DataFrame:
    """A row per rule: its labels and the offending rows found, 0 included."""
    spark = found.sparkSession
    names = [tuple([i, *(label(r) for label in labels.values())]) for i, r in enumerate(rules)]
    listed = spark.createDataFrame(names, ", ".join(["_rule int", *(f"{c} string" for c in labels)]))
    counted = found.groupBy("_rule").agg(F.sum("rows").alias("rows"))
    return listed.join(counted, "_rule", "left").select(*labels, F.coalesce("rows", F.lit(0).cast("bigint")).alias("bad_rows"))


def _keys_of_rules(tables: Tables, by_table: dict[str, list]) -> DataFrame:
    """The keys that all rules look at, each table read once: one struct per row and rule."""
    return union_all(tables(t).select(F.explode(F.array(*keys)).alias("k")).select("k.*") for t, keys in by_table.items())


def _asked_keys(tables: Tables, keys: list, null_is_missing: bool = False) -> tuple[list[str], DataFrame]:
    """The parents, and child rows counted per rule and key: a key is looked up once however often it occurs."""
    parents = list(dict.fromkeys(parent for _, _, parent in keys))
    by_child: dict[str, list] = {}
    for i, (child, fk, parent) in enumerate(keys):
        number = F.lit(parents.index(parent)).alias("_parent")
        pair = F.struct(F.lit(i).alias("_rule"), number, F.col(fk).cast("bigint").alias("_key"))
        by_child.setdefault(child, []).append(pair)
    asked = _keys_of_rules(tables, by_child)
    if not null_is_missing:
        asked = asked.where("_key IS NOT NULL")
    return parents, asked.groupBy("_rule", "_parent", "_key").agg(F.count(F.lit(1)).alias("rows"))


def _missing_rows(tables: Tables, keys: list, null_is_missing: bool = False) -> DataFrame:
    """Child rows without a parent per (child, key column, parent). Each child and each parent is read once."""
    parents, asked = _asked_keys(tables, keys, null_is_missing)
    known = union_all(tables(p).select(F.lit(i).alias("_parent"), F.col("id").cast("bigint").alias("_key")) for i, p in enumerate(parents))
    return asked.join(known, ["_parent", "_key"], "left_anti").select("_rule", "rows")


def fk_check(tables: Tables, keys=schema.FOREIGN_KEYS) -> DataFrame:
    """Child rows whose key has no parent; NULL keys pass."""
    labels = {"table_name": lambda r: r[0], "column_name": lambda r: r[1], "parent": lambda r: r[2]}
    return _per_rule(list(keys), _missing_rows(tables, list(keys)), labels)


def fk_check_by_bitmaps(tables: Tables, bitmaps: KeyBitmaps, keys=schema.FOREIGN_KEYS) -> DataFrame:
    """``fk_check`` against stored key sets: children are read, parents are not."""
    parents, asked = _asked_keys(tables, list(keys))
    held = union_all(bitmaps.bits(p).select(F.lit(i).alias("_p"), "bucket", "bits") for i, p in enumerate(parents))
    found = asked.join(held, (F.col("_parent") == F.col("_p")) & (F.bitmap_bucket_number("_key") == F.col("bucket")), "left")
    missing = found.where(~has_bit(F.col("bits"), F.bitmap_bit_position("_key"))).select("_rule", "rows")
    labels = {"table_name": lambda r: r[0], "column_name": lambda r: r[1], "parent": lambda r: r[2]}
    return _per_rule(list(keys), missing, labels)


# The five orphan checks and their names.
ORPHANS = (
    ("sale_orders_without_partner", "sale_order", "partner_id", "res_partner"),
    ("sale_lines_without_order", "sale_order_line", "order_id", "sale_order"),
    ("sale_lines_without_product", "sale_order_line", "product_id", "product_product"),
    ("purchase_orders_without_vendor", "purchase_order", "partner_id", "res_partner"),
    ("purchase_lines_without_order", "purchase_order_line", "order_id", "purchase_order"),
)


def orphan_check(tables: Tables) -> DataFrame:
    """Rows without a parent; unlike in ``fk_check`` a NULL key has none."""
    found = _missing_rows(tables, [rule[1:] for rule in ORPHANS], null_is_missing=True)
    return _per_rule(list(ORPHANS), found, {"check_name": lambda r: r[0]})


def unique_check(tables: Tables, keys=schema.UNIQUE_KEYS) -> DataFrame:
    """Rows beyond the first of each key; keys with a NULL part are not compared. Each table is read once.

    A key's numbers and texts have columns of their own type, as many as the widest key needs; ids travel as eight bytes. The
    last number is cut into a block of 64 and a bit within it, so that a block of serial ids is one group, before the shuffle
    already, and different keys are counted as the bits set. Ids far apart are a group each.
    """
    frames = {t: tables(t) for t in dict.fromkeys(t for t, _ in keys)}
    split = []
    for table, key in keys:
        whole_numbers = {f.name for f in frames[table].schema if isinstance(f.dataType, T.IntegralType)}
        split.append(([c for c in key if c in whole_numbers], [c for c in key if c not in whole_numbers]))
    kinds = [("_n", "bigint", max(len(n) for n, _ in split)), ("_s", "string", max(len(s) for _, s in split))]
    places = [f"{kind}{j}" for kind, _, width in kinds for j in range(width)]
    by_table: dict[str, list] = {}
    for i, ((table, key), parts) in enumerate(zip(keys, split, strict=True)):
        slots = [
            (F.col(own[j]) if j < len(own) else F.lit(None)).cast(type_).alias(f"{kind}{j}")
            for own, (kind, type_, width) in zip(parts, kinds, strict=True)
            for j in range(width)
        ]
        bit = F.lit(1).cast("bigint")
        if parts[0]:
            last, number = len(parts[0]) - 1, F.col(parts[0][-1]).cast("bigint")
            slots[last] = F.shiftright(number, 6).alias(f"_n{last}")
            bit = F.call_function("shiftleft", bit, number.bitwiseAND(63).cast("int"))
        known = F.lit(True)
        for c in key:
            known = known & F.col(c).isNotNull()
        by_table.setdefault(table, []).append(F.when(known, F.struct(F.lit(i).alias("_rule"), *slots, bit.alias("_bit"))))
    whole = _keys_of_rules(frames.get, by_table).where("_rule IS NOT NULL")
    repeats = F.count(F.lit(1)) - F.bit_count(F.bit_or("_bit"))
    groups = whole.groupBy("_rule", *places).agg(repeats.alias("rows")).where("rows > 0")
    labels = {"table_name": lambda r: r[0], "key_columns": lambda r: ", ".join(r[1])}
    return _per_rule(list(keys), groups, labels)


def _counted(tables: Tables, rules: Iterable[tuple[str, str, object]]) -> DataFrame:
    """(table, label, offending condition) rules, counted in one pass per table, one row per rule."""
    by_table: dict[str, list] = {}
    for table, label, bad in rules:
        by_table.setdefault(table, []).append((label, bad))

    def one(table: str, checks: list) -> DataFrame:
        counts = tables(table).agg(*[F.count_if(bad).alias(label) for label, bad in checks])
        pairs = F.array(*[F.struct(F.lit(label).alias("rule"), F.col(label).alias("bad_rows")) for label, _ in checks])
        return counts.select(F.explode(pairs).alias("r")).select(F.lit(table).alias("table_name"), "r.rule", "r.bad_rows")

    return union_all(one(t, c) for t, c in by_table.items())


def value_check(tables: Tables) -> DataFrame:
    return _counted(tables, ((t, label, ~F.expr(ok)) for t, label, ok in schema.VALUE_CHECKS))


def state_check(tables: Tables) -> DataFrame:
    return _counted(tables, ((t, c, ~F.col(c).isin(*values)) for t, c, values in schema.ACCEPTED_STATES))


def not_null_check(tables: Tables) -> DataFrame:
    return _counted(
        tables,
        ((t, c.name, F.col(c.name).isNull()) for t in schema.TABLES for c in schema.columns(t) if c.required),
    )


def total_reconciliation(tables: Tables) -> DataFrame:
    """Orders whose total differs from the sum of their lines; orders without lines are not compared."""
    totals = line_totals(tables("sale_order_line"))
    return (
        tables("sale_order")
        .join(totals, F.col("id") == F.col("_header"))
        .agg(
            F.count(F.lit(1)).alias("compared_orders"),
            F.count_if(F.col("amount_total") != F.col("_total")).alias("mismatched_orders"),
        )
    )


def dirtiness_sample(tables: Tables) -> DataFrame:
    """How dirty the partner table is, in two passes: plain counts, and e-mails per normalised address."""
    partners = tables("res_partner")
    counts = partners.agg(
        F.count_if(F.col("email").isNull()).alias("partners_null_email"),
        F.count_if(F.col("phone").isNull()).alias("partners_null_phone"),
        F.count_if(F.col("city_id").isNull()).alias("partners_null_city_id"),
        F.count_if(F.col("name") != F.trim(F.col("name"))).alias("names_with_padding"),
    )
    mail = F.lower(F.trim(F.col("email")))
    repeats = (
        partners.where(F.col("email").isNotNull())
        .groupBy(mail.alias("m"))
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_emails"))
    )
    return counts.withColumn("duplicate_emails", repeats.scalar())
