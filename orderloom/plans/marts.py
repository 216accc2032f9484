"""Segments, read models and summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import rules
from orderloom.functions.amounts import total_cents
from orderloom.operators.ranking import with_ntiles
from orderloom.session import cut


def rfm_measures(sales: DataFrame, customer: str, as_of: Column) -> DataFrame:
    """Recency, frequency and monetary value per customer, from one row per order."""
    measured = sales.groupBy(customer).agg(
        F.count(F.lit(1)).alias("frequency"),
        total_cents("gross_cents").alias("monetary"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
    )
    return measured.withColumn("recency_days", F.datediff(as_of, "last_order_date"))


def rfm_segments(measures: DataFrame, customer: str) -> DataFrame:
    """Scores by fifths, cell, total and segment; the customer key breaks ties."""
    scored = with_ntiles(
        cut(measures, "rfm"),
        {
            "r_score": ([("recency_days", True), (customer, False)], 5),
            "f_score": ([("frequency", False), (customer, False)], 5),
            "m_score": ([("monetary", False), (customer, False)], 5),
        },
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumns(
        {
            "rfm_cell": F.concat(r.cast("string"), f.cast("string"), m.cast("string")),
            "rfm_total": r + f + m,
            "segment": rules.rfm_segment(r, f, m),
            "segment_vi": rules.lookup(rules.rfm_segment(r, f, m), rules.RFM_NAMES_VI),
        }
    )


def customer_summary(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Read model per customer, including those without orders.

    Orders are added up before the join, so one busy customer is one row in it.
    """
    per_customer = orders.groupBy("customer_nk").agg(
        F.count(F.lit(1)).alias("total_orders"),
        total_cents("amount_cents").alias("total_spent"),
        F.max("created_at").alias("last_order_at"),
    )
    return customers.join(per_customer, "customer_nk", "left").select(
        "customer_nk",
        "full_name",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("total_spent", F.lit(0)).cast("decimal(20,2)").alias("total_spent"),
        "last_order_at",
    )


def value_segments(orders: DataFrame, customers: DataFrame, vip, regular) -> DataFrame:
    revenue = orders.groupBy("customer_nk").agg(
        F.count(F.lit(1)).alias("orders"), total_cents("amount_cents").alias("revenue")
    )
    classed = revenue.withColumn("segment", rules.value_segment(F.col("revenue"), vip, regular))
    return classed.join(customers.select("customer_nk", "full_name"), "customer_nk")


def order_summary(
    orders: DataFrame, items: DataFrame, customers: DataFrame, payments: DataFrame | None = None
) -> DataFrame:
    """Per order: customer, number of lines and units; with ``payments`` status and method of the latest one, NULL without any."""
    counted = items.groupBy("order_nk").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("quantity").alias("units")
    )
    summed = orders.join(counted, "order_nk").join(customers.select("customer_nk", "full_name"), "customer_nk")
    if payments is None:
        return summed
    latest = payments.groupBy(F.col("order_id").alias("order_nk")).agg(
        F.max_by(F.struct("status", "method"), F.struct("created_at", "id")).alias("_paid")
    )
    paid = {"payment_status": F.col("_paid.status"), "payment_method": F.col("_paid.method")}
    return summed.join(latest, "order_nk", "left").withColumns(paid).drop("_paid")
