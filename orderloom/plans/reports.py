"""Reports.

``sales`` has one row per delivered order, ``lines`` one per line of them.
Everything a report needs per customer, product or day is added up before the
dimension joins, so that the joins see one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import dates
from orderloom.functions.amounts import as_double, from_cents, total_cents
from orderloom.operators import windows
from orderloom.operators.ranking import with_ranks
from orderloom.operators.skew import hot_keys


def _by_day(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy("order_date", *keys).agg(
        F.sum("gross_cents").alias("gross"),
        F.sum("net_cents").alias("net"),
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("n"),
    )


def _with_calendar(df: DataFrame, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """The calendar's columns per order date. A date that it does not hold is spelled out by itself and
    has -1 as its key, like a missing date, so no row is lost."""
    day = F.col("order_date")
    own = {
        "date_key": F.lit(-1),
        "year": F.year(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_name_vi": dates.pick(F.month(day), dates.MONTH_NAMES_VI),
    }
    days = calendar.select(F.col("full_date").alias("order_date"), *columns)
    return df.join(days, "order_date", "left").withColumns({c: F.coalesce(F.col(c), own[c]) for c in columns})


def monthly_revenue(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Gross, net, orders and customers per month.

    Distinct customers are found by grouping, first to one row per customer and
    month: a busy month is spread over its customers.
    """
    months = ["year", "month", "month_name_vi"]
    dated = _with_calendar(sales, calendar, months)
    per_customer = dated.groupBy(*months, "customer_nk").agg(
        F.sum("gross_cents").alias("gross"), F.sum("net_cents").alias("net"), F.count(F.lit(1)).alias("orders")
    )
    return (
        per_customer.groupBy(*months)
        .agg(
            total_cents("gross").alias("gross_revenue"),
            total_cents("net").alias("net_revenue"),
            F.sum("orders").alias("orders"),
            F.count(F.lit(1)).alias("unique_customers"),
        )
        .orderBy("year", "month")
    )


def monthly_by_customer(sales: DataFrame, calendar: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per month and customer with Vietnamese column names."""
    dated = _with_calendar(sales, calendar, ["year", "month", "month_name_vi"])
    summed = dated.groupBy("year", "month", "month_name_vi", "customer_nk").agg(
        total_cents("gross_cents").alias("doanh_thu_gop"),
        total_cents("net_cents").alias("doanh_thu_thuan"),
        F.sum("quantity").alias("so_luong"),
    )
    return (
        summed.join(customers.select("customer_nk", "full_name"), "customer_nk")
        .select(
            "year",
            "month",
            F.col("month_name_vi").alias("thang"),
            F.col("full_name").alias("khach_hang"),
            "doanh_thu_gop",
            "doanh_thu_thuan",
            "so_luong",
        )
        .orderBy("year", "month", F.desc("doanh_thu_gop"), "khach_hang")
    )


def monthly_by_category(lines: DataFrame, calendar: DataFrame, products: DataFrame, year: int) -> DataFrame:
    in_year = lines.filter(dates.year_range(F.col("order_date"), year))
    dated = _with_calendar(in_year, calendar, ["year", "month", "month_name"])
    per_product = dated.groupBy("year", "month", "month_name", "product_nk").agg(
        F.sum("gross_cents").alias("gross"), F.sum("net_cents").alias("net"), F.sum("quantity").alias("units")
    )
    return (
        per_product.join(products.select("product_nk", "category_name"), "product_nk")
        .groupBy("year", "month", "month_name", "category_name")
        .agg(
            total_cents("gross").alias("gross_revenue"),
            total_cents("net").alias("net_revenue"),
            F.sum("units").alias("units_sold"),
        )
        .orderBy("month", F.desc("gross_revenue"))
    )


def revenue_by_segment(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, revenue and mean line revenue per segment of the current dimension rows."""
    per_customer = sales.groupBy("customer_nk").agg(
        F.sum("net_cents").alias("net"), F.sum("line_count").alias("n")
    )
    current = customers.filter("is_current").select("customer_nk", "segment")
    return (
        per_customer.join(current, "customer_nk")
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            total_cents("net").alias("total_revenue"),
            F.round(F.try_divide(total_cents("net").cast("double"), F.sum("n")), 2).alias("avg_revenue"),
        )
    )


def registration_cohorts(sales: DataFrame, joined_on: DataFrame) -> DataFrame:
    """Active customers and revenue per month of registration; ``joined_on`` has (customer_nk, joined_on)."""
    per_customer = sales.groupBy("customer_nk").agg(F.sum("gross_cents").alias("gross"))
    return (
        per_customer.join(joined_on, "customer_nk")
        .groupBy(dates.month_label(F.col("joined_on")).alias("registration_month"))
        .agg(F.count(F.lit(1)).alias("active_customers"), total_cents("gross").alias("cohort_revenue"))
        .orderBy("registration_month")
    )


def top_products(lines: DataFrame, products: DataFrame, k: int, by: str = "revenue") -> DataFrame:
    """Best ``k`` products by revenue or units; only those are looked up."""
    sold = lines.groupBy("product_nk").agg(
        F.sum("quantity").alias("units_sold"), total_cents("gross_cents").alias("revenue")
    )
    best = sold.orderBy(F.desc(by), "product_nk").limit(k)
    names = products.select("product_nk", "product_name", "category_name")
    return best.join(names, "product_nk").orderBy(F.desc(by), "product_nk")


def order_history(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer, newest first; filter by customer for one history."""
    return (
        orders.join(customers.select("customer_nk", "full_name"), "customer_nk")
        .select("customer_nk", "full_name", "order_nk", "order_status", "total_amount", "created_at")
        .orderBy(F.desc("created_at"), F.desc("order_nk"))
    )


def revenue_by_source(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_source").agg(F.count(F.lit(1)).alias("orders"), total_cents("amount_cents").alias("revenue"))


def month_over_month(orders: DataFrame) -> DataFrame:
    monthly = orders.groupBy(dates.month_label(F.col("created_at")).alias("month")).agg(
        total_cents("amount_cents").alias("revenue")
    )
    before = F.lag("revenue").over(Window.orderBy("month"))  # one row per month
    grown = monthly.withColumn("prev_revenue", before)
    now, then = F.col("revenue").cast("double"), F.col("prev_revenue").cast("double")
    return grown.withColumn("growth_pct", F.round(F.try_divide(now - then, then) * 100, 2)).orderBy("month")


def customer_ranking(orders: DataFrame) -> DataFrame:
    """Per order: rank by value within the customer, running spend, total and share."""
    base = orders.select("order_nk", "customer_nk", "amount_cents", "created_at").withColumn(
        "_most", -F.col("amount_cents")
    )
    hot = hot_keys(base, ["customer_nk"])  # counted once for all three
    ranked = windows.numbered(base, ["customer_nk"], ["_most", "order_nk"], row_number="rank_in_customer", hot=hot)
    summed = windows.running(
        ranked,
        ["customer_nk"],
        ["created_at", "order_nk"],
        {"_spent": F.col("amount_cents")},
        hot=hot,
    )
    if hot is None:  # the rows of a customer are together already
        whole = summed.withColumn("_whole", F.sum("amount_cents").over(Window.partitionBy("customer_nk")))
    else:
        whole = windows.with_total(summed, ["customer_nk"], {"_whole": F.sum("amount_cents")}, hot=hot)
    share = F.try_divide(as_double("amount_cents"), as_double("_whole")) * 100
    return whole.select(
        "order_nk",
        "customer_nk",
        from_cents("amount_cents").alias("total_amount"),
        "rank_in_customer",
        from_cents("_spent", 20).alias("cumulative_spend"),
        from_cents("_whole", 20).alias("customer_total"),
        F.round(share, 2).alias("pct_of_customer_total"),
    )


def product_ranking(lines: DataFrame, tiles: int = 4) -> DataFrame:
    """Units per product with row number, rank, dense rank and tile over all products."""
    sold = lines.groupBy("product_nk").agg(F.sum("quantity").alias("units_sold"))
    return with_ranks(
        sold, "units_sold", "product_nk", True, "row_num", "rank_num", "dense_rank_num", {"quartile": tiles}
    )


def daily_revenue(sales: DataFrame) -> DataFrame:
    per_customer = sales.groupBy("order_date", "customer_nk").agg(
        F.sum("gross_cents").alias("gross"), F.sum("net_cents").alias("net")
    )
    return per_customer.groupBy(dates.date_key(F.col("order_date")).alias("date_key")).agg(
        total_cents("gross").alias("gross_revenue"),
        total_cents("net").alias("net_revenue"),
        F.count(F.lit(1)).alias("unique_customers"),
    )


def sales_by_category(lines: DataFrame, calendar: DataFrame, products: DataFrame) -> DataFrame:
    dated = _with_calendar(_by_day(lines, ["product_nk"]), calendar, ["date_key", "year", "month"])
    label = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return (
        dated.join(products.select("product_nk", "category_name"), "product_nk")
        .groupBy("date_key", label.alias("month_label"), "category_name")
        .agg(total_cents("gross").alias("revenue"), total_cents("net").alias("net_revenue"), F.sum("n").alias("orders"))
    )


def monthly_customer_totals(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivered revenue and orders per month and customer, from orders, lines and customers.

    An order counts once, however many lines it has.
    """
    monthly = sales.groupBy(dates.month_label(F.col("order_date")).alias("month"), "customer_nk").agg(
        total_cents("net_cents").alias("total_revenue"), F.count(F.lit(1)).alias("order_count")
    )
    return (
        monthly.join(customers.select("customer_nk", "full_name"), "customer_nk", "left")
        .select("month", "customer_nk", "full_name", "total_revenue", "order_count")
        .orderBy("month", F.desc("total_revenue"), "customer_nk")
    )


def recent_large_pending(orders: DataFrame, customers: DataFrame, as_of, hours: int, above) -> DataFrame:
    recent = orders.filter(
        (F.col("order_status") == "pending")
        & (F.col("created_at") >= as_of - F.make_interval(hours=F.lit(hours)))
        & (F.col("total_amount") > above)
    )
    return recent.join(customers.select("customer_nk", "full_name"), "customer_nk").select(
        "order_nk", "full_name", "total_amount", "created_at"
    )


def effective_discount(sales: DataFrame) -> DataFrame:
    rate = F.try_divide(total_cents("discount_cents").cast("double"), total_cents("gross_cents").cast("double"))
    return sales.agg(F.round(rate, 6).alias("effective_discount_rate"))


def revenue_by_year(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Year taken from the calendar, after adding up per day."""
    return (
        _with_calendar(_by_day(sales, []), calendar, ["year"])
        .groupBy("year")
        .agg(total_cents("gross").alias("gross_revenue"), F.sum("units").alias("units"))
    )
