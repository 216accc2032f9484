"""The generic test tables seen as shop entities.

Orders, lines, products and customers come from the order tables; change logs,
outbox rows, counters and requests from the event table. Money is doubles with
two decimals there; here it becomes whole cents or decimals, before anything is added up.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import rules
from orderloom.functions.amounts import cents, discount_cents, from_cents
from orderloom.schemas import BOUND
from orderloom.sources.tables import scan

STATUS_OF_CODE = {"F": "delivered", "P": "pending", "O": "processing"}
# The day the second customer snapshot was taken, and the first one.
FIRST_LOAD, SECOND_LOAD = "1995-01-01", "1998-01-01"
# Just after the last order; "now" for everything that depends on the clock.
AS_OF = "2001-08-02 00:00:00"

def money(column: Column | str, digits: int = 14) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(f"decimal({digits},2)")


class Tables:
    """Lazily opened tables of one data folder, raw and as shop entities."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.folder}/{name}.parquet", BOUND[name])

    region = cached_property(lambda self: self.table("region"))
    nation = cached_property(lambda self: self.table("nation"))
    customer = cached_property(lambda self: self.table("customer"))
    supplier = cached_property(lambda self: self.table("supplier"))
    part = cached_property(lambda self: self.table("part"))
    orders = cached_property(lambda self: self.table("orders"))
    lineitem = cached_property(lambda self: self.table("lineitem"))
    events = cached_property(lambda self: self.table("events"))

    @cached_property
    def shop_orders(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("order_nk"),
            F.col("o_custkey").alias("customer_nk"),
            rules.lookup(F.col("o_orderstatus"), STATUS_OF_CODE).alias("order_status"),
            money("o_totalprice").alias("total_amount"),
            cents("o_totalprice").alias("amount_cents"),
            F.col("o_orderpriority").alias("order_source"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )

    @cached_property
    def delivered_orders(self) -> DataFrame:
        """Filtered on the stored code, so that the filter reaches the scan."""
        return self.orders.filter("o_orderstatus = 'F'").select(
            F.col("o_orderkey").alias("order_nk"),
            F.col("o_custkey").alias("customer_nk"),
            money("o_totalprice").alias("total_amount"),
            cents("o_totalprice").alias("amount_cents"),
            F.col("o_orderpriority").alias("order_source"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def shop_items(self) -> DataFrame:
        """Order lines. The table has no key of its own: it gets a hash of the whole row."""
        gross, rate = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
        gross_cents = cents("l_extendedprice")
        off_cents = discount_cents(gross_cents, F.col("l_discount"))
        quantity = F.col("l_quantity").cast("long")
        return self.lineitem.select(
            F.md5(
                F.concat_ws(
                    "|",
                    "l_orderkey",
                    "l_linenumber",
                    "l_partkey",
                    "l_suppkey",
                    quantity,
                    gross,
                    rate,
                    F.col("l_tax").cast("decimal(4,2)"),
                    "l_returnflag",
                    "l_linestatus",
                    F.date_format("l_shipdate", "yyyy-MM-dd"),
                )
            ).alias("order_item_nk"),
            F.col("l_orderkey").alias("order_nk"),
            F.col("l_partkey").alias("product_nk"),
            F.col("l_suppkey").alias("supplier_nk"),
            quantity.alias("quantity"),
            F.round(gross / quantity, 2).cast("decimal(12,2)").alias("unit_price"),
            gross_cents.alias("gross_cents"),
            off_cents.alias("discount_cents"),
            gross.alias("gross_revenue"),
            from_cents(off_cents).alias("discount_amount"),
            F.col("l_shipdate").alias("shipped_at"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
        )

    @cached_property
    def shop_products(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("product_nk"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("brand"),
            money("p_retailprice", 12).alias("unit_price"),
            F.col("p_size").alias("stock_quantity"),
        )

    @cached_property
    def located_customers(self) -> DataFrame:
        """Customers with nation as city and region as country."""
        places = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        return self.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_nk"),
            F.col("c_name").alias("full_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.col("c_mktsegment").alias("segment"),
            money("c_acctbal").alias("balance"),
        )

    @cached_property
    def customers_before(self) -> DataFrame:
        """First customer snapshot: those with a high balance have not joined yet."""
        return self.located_customers.filter("balance <= 9500")

    @cached_property
    def customers_after(self) -> DataFrame:
        """Second snapshot: all customers bar those deep in debt; one segment was renamed."""
        renamed = F.when(F.col("segment") == "BUILDING", "MACHINERY").otherwise(F.col("segment"))
        return self.located_customers.filter("balance >= -900").withColumn("segment", renamed)
