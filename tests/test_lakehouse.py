from conftest import same_rows
from pyspark.sql import functions as F

from bazaarlake.lakehouse import Lakehouse
from bazaarlake.plans import gold, refresh
from bazaarlake.plans.silver import Silver
from bazaarlake.session import work_dir


class Changed:
    """A source whose templates got dearer after the first load."""

    def __init__(self, source):
        self.source = source

    def table(self, name):
        df = self.source.table(name)
        if name != "product_template":
            return df
        return df.withColumns(
            {"standard_price": F.lit(1).cast("decimal(12,2)"), "write_date": F.expr("write_date + interval 10 years")}
        )


def test_mirror_then_star_then_change(spark, source):
    house = Lakehouse(spark, work_dir(spark, "house"), buckets=4)
    loaded = house.load_silver(source)
    assert loaded["sale_order_line"] == source.table("sale_order_line").count()
    house.build_gold()
    assert same_rows(house.gold("fact_sales"), gold.fact_sales(Silver(source)))
    assert same_rows(house.gold("dim_customer"), gold.dim_customer(Silver(source)))

    house.compact()
    again = house.load_silver(Changed(source))
    assert again.pop("product_template") > 0 and set(again.values()) == {0}
    house.build_gold()
    stock = house.gold("fact_inventory")
    assert stock.where("inventory_value <> on_hand_qty").isEmpty()
    assert same_rows(stock.drop("inventory_value"), gold.fact_inventory(Silver(source)).drop("inventory_value"))


def test_full_refresh(spark, source):
    house = Lakehouse(spark, work_dir(spark, "copies"))
    house.refresh_bronze(source)
    house.refresh_bronze(source)
    assert same_rows(refresh.sales(house.bronze), refresh.sales(refresh.bronze_of(source)))
