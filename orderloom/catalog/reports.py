"""The named reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.bindings import AS_OF, money
from orderloom.catalog.core import DIM_CUSTOMER_CTE, LINES_CTE, PLACES_CTE, query
from orderloom.catalog.relational import dim_customer
from orderloom.functions import dates
from orderloom.functions.amounts import total_cents
from orderloom.operators import joins
from orderloom.plans import marts, reports
from orderloom.plans.warehouse import date_series, dim_date, sales_by_order, sales_lines

MONTH_VI = "'Tháng ' || month(order_date)"


def lines_of(t):
    return sales_lines(t.delivered_orders, t.shop_items)


def sales_of(t):
    return sales_by_order(t.delivered_orders, t.shop_items)


def calendar_of(t):
    """A hundred years, so that no scan is needed to find the first and the last day."""
    return dim_date(date_series(t.spark, "1970-01-01", "2069-12-31"))


def shop_payments(t):
    took = F.make_dt_interval(secs=(F.col("o_custkey") % 600).cast("decimal(18,6)"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "card").otherwise("cod").alias("method"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "stripe").alias("gateway"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("processing").alias("status"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + took).alias("processed_at"),
    )


@query(
    "r1_monthly_revenue",
    f"""
    WITH {LINES_CTE}
    SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, {MONTH_VI} AS month_name_vi,
           CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue, CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS net_revenue,
           COUNT(DISTINCT order_nk) AS orders, COUNT(DISTINCT customer_nk) AS unique_customers
    FROM lines GROUP BY 1, 2, 3 ORDER BY 1, 2
    """,
)
def r1(t):
    return reports.monthly_revenue(sales_of(t), calendar_of(t))


@query(
    "r2_monthly_by_customer",
    f"""
    WITH {LINES_CTE}
    SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, {MONTH_VI} AS thang,
           c_name AS khach_hang, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS doanh_thu_gop,
           CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS doanh_thu_thuan, CAST(SUM(quantity) AS BIGINT) AS so_luong
    FROM lines JOIN customer ON c_custkey = customer_nk GROUP BY 1, 2, 3, customer_nk, c_name
    """,
)
def _(t):
    return reports.monthly_by_customer(sales_of(t), calendar_of(t), t.located_customers)


@query(
    "r3_monthly_by_category",
    f"""
    WITH {LINES_CTE}
    SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
           strftime(order_date, '%B') AS month_name, p_type AS category_name,
           CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
           CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS net_revenue, CAST(SUM(quantity) AS BIGINT) AS units_sold
    FROM lines JOIN part ON p_partkey = product_nk WHERE year(order_date) = 1998 GROUP BY 1, 2, 3, 4
    """,
)
def _(t):
    in_year = t.delivered_orders.filter(dates.year_range(F.col("created_at"), 1998))
    return reports.monthly_by_category(sales_lines(in_year, t.shop_items), calendar_of(t), t.shop_products, 1998)


@query(
    "r4_revenue_by_segment",
    f"""
    WITH {DIM_CUSTOMER_CTE}, {LINES_CTE}
    SELECT segment, COUNT(DISTINCT d.customer_nk) AS customers, CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS total_revenue,
           ROUND(CAST(SUM(net_revenue) AS DOUBLE) / COUNT(*), 2) AS avg_revenue
    FROM lines JOIN dim_customer d ON d.customer_nk = lines.customer_nk AND d.is_current GROUP BY segment
    """,
)
def _(t):
    return reports.revenue_by_segment(sales_of(t), dim_customer(t))


@query(
    "r5_registration_cohorts",
    f"""
    WITH {LINES_CTE}, joined AS (SELECT o_custkey, MIN(o_orderdate) AS joined_on FROM orders GROUP BY o_custkey)
    SELECT strftime(joined_on, '%Y-%m') AS registration_month, COUNT(DISTINCT customer_nk) AS active_customers,
           CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS cohort_revenue
    FROM lines JOIN joined ON o_custkey = customer_nk GROUP BY 1
    """,
)
def _(t):
    """A customer registers with the first order, delivered or not."""
    joined_on = t.orders.groupBy(F.col("o_custkey").alias("customer_nk")).agg(F.min("o_orderdate").alias("joined_on"))
    return reports.registration_cohorts(sales_of(t), joined_on)


@query(
    "r6_top_products_by_revenue",
    f"""
    WITH {LINES_CTE}
    SELECT product_nk, CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS revenue,
           p_name AS product_name, p_type AS category_name
    FROM lines JOIN part ON p_partkey = product_nk GROUP BY product_nk, p_name, p_type ORDER BY revenue DESC, product_nk LIMIT 10
    """,
)
def _(t):
    return reports.top_products(lines_of(t), t.shop_products, 10)


@query(
    "r6_top_products_by_units",
    f"""
    WITH {LINES_CTE}
    SELECT product_nk, CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS revenue,
           p_name AS product_name, p_type AS category_name
    FROM lines JOIN part ON p_partkey = product_nk GROUP BY product_nk, p_name, p_type ORDER BY units_sold DESC, product_nk LIMIT 5
    """,
)
def _(t):
    return reports.top_products(lines_of(t), t.shop_products, 5, "units_sold")


STATUS_CASE = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'pending' WHEN 'O' THEN 'processing' END"


@query(
    "r7_order_history",
    f"""
    SELECT o_custkey AS customer_nk, c_name AS full_name, o_orderkey AS order_nk, {STATUS_CASE} AS order_status,
           CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, o_orderdate AS created_at
    FROM orders JOIN customer ON c_custkey = o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC
    """,
)
def _(t):
    return reports.order_history(t.shop_orders, t.located_customers)


@query(
    "r8_revenue_by_source",
    """
    SELECT o_orderpriority AS order_source, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS revenue
    FROM orders GROUP BY 1
    """,
)
def _(t):
    return reports.revenue_by_source(t.shop_orders)


@query(
    "r9_customer_lifetime_value",
    """
    SELECT c_custkey AS customer_nk, c_name AS full_name, COUNT(o_orderkey) AS total_orders,
           CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(14,2))), 0) AS DECIMAL(20,2)) AS total_spent, MAX(o_orderdate) AS last_order_at
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus <> 'X'
    GROUP BY c_custkey, c_name
    """,
)
def _(t):
    """Over the whole history; cancelled orders do not count."""
    orders = t.shop_orders.filter("order_status <> 'cancelled'")
    return marts.customer_summary(orders, t.located_customers)


@query(
    "r10_order_summary",
    f"""
    SELECT o_orderkey AS order_nk, {STATUS_CASE} AS order_status, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount,
           c_name AS full_name, COUNT(*) AS item_count, CAST(SUM(l_quantity) AS BIGINT) AS units
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3, 4
    """,
)
def _(t):
    summary = marts.order_summary(t.shop_orders, t.shop_items, t.located_customers)
    return summary.select("order_nk", "order_status", "total_amount", "full_name", "item_count", "units")


@query(
    "r10_order_summary_payments",
    f"""
    SELECT o_orderkey AS order_nk, {STATUS_CASE} AS order_status, c_name AS full_name, COUNT(*) AS item_count,
           CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'processing' END AS payment_status,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'card' ELSE 'cod' END AS payment_method
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL
    """,
)
def _(t):
    """Each order has an attempt that failed the day before its payment."""
    paid = shop_payments(t)
    failed = paid.withColumns({"id": -F.col("id"), "status": F.lit("failed"), "created_at": F.col("created_at") - F.expr("INTERVAL 1 DAY")})
    summary = marts.order_summary(t.shop_orders, t.shop_items, t.located_customers, paid.unionByName(failed))
    return summary.select("order_nk", "order_status", "full_name", "item_count", "payment_status", "payment_method")


@query(
    "r10_customer_read_model",
    """
    SELECT c_custkey AS customer_nk, c_name AS full_name, COUNT(o_orderkey) AS total_orders,
           CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(14,2))), 0) AS DECIMAL(20,2)) AS total_spent, MAX(o_orderdate) AS last_order_at
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name
    """,
)
def _(t):
    return marts.customer_summary(t.shop_orders, t.located_customers)


@query(
    "r11_month_over_month",
    """
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS revenue
               FROM orders GROUP BY 1),
         l AS (SELECT *, LAG(revenue) OVER (ORDER BY month) AS prev_revenue FROM m)
    SELECT month, revenue, prev_revenue,
           ROUND((CAST(revenue AS DOUBLE) - CAST(prev_revenue AS DOUBLE)) / CAST(prev_revenue AS DOUBLE) * 100, 2) AS growth_pct FROM l
    """,
)
def _(t):
    return reports.month_over_month(t.shop_orders)


@query(
    "r12_cumulative_orders",
    f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS new_orders,
           CAST(SUM(COUNT(*)) OVER (ORDER BY strftime(o_orderdate, '%Y-%m')) AS BIGINT) AS cumulative_orders
    FROM orders WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 12 MONTH GROUP BY 1
    """,
)
def _(t):
    from orderloom.plans.capacity import cumulative_by_month

    since = dates.instant(AS_OF) - F.expr("INTERVAL 12 MONTHS")
    monthly = t.orders.filter(F.col("o_orderdate") >= since).groupBy(dates.month_label(F.col("o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("new_orders")
    )
    return cumulative_by_month(monthly, "month", "new_orders", "cumulative_orders")


@query(
    "r13_customer_ranking",
    """
    WITH o AS (SELECT o_orderkey AS order_nk, o_custkey AS customer_nk, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, o_orderdate
               FROM orders WHERE o_orderstatus = 'F')
    SELECT order_nk, customer_nk, total_amount,
           ROW_NUMBER() OVER (PARTITION BY customer_nk ORDER BY total_amount DESC, order_nk) AS rank_in_customer,
           CAST(SUM(total_amount) OVER (PARTITION BY customer_nk ORDER BY o_orderdate, order_nk ROWS UNBOUNDED PRECEDING) AS DECIMAL(20,2)) AS cumulative_spend,
           CAST(SUM(total_amount) OVER (PARTITION BY customer_nk) AS DECIMAL(20,2)) AS customer_total,
           ROUND(CAST(total_amount AS DOUBLE) / CAST(SUM(total_amount) OVER (PARTITION BY customer_nk) AS DOUBLE) * 100, 2) AS pct_of_customer_total
    FROM o
    """,
)
def _(t):
    return reports.customer_ranking(t.delivered_orders)


@query(
    "r14_product_ranking",
    f"""
    WITH {LINES_CTE}, sold AS (SELECT product_nk, CAST(SUM(quantity) AS BIGINT) AS units_sold FROM lines GROUP BY 1)
    SELECT product_nk, units_sold, CAST(NTILE(4) OVER (ORDER BY units_sold DESC, product_nk) AS INTEGER) AS quartile,
           ROW_NUMBER() OVER (ORDER BY units_sold DESC, product_nk) AS row_num,
           RANK() OVER (ORDER BY units_sold DESC) AS rank_num, DENSE_RANK() OVER (ORDER BY units_sold DESC) AS dense_rank_num FROM sold
    """,
)
def _(t):
    return reports.product_ranking(lines_of(t))


@query(
    "r15_daily_revenue",
    f"""
    WITH {LINES_CTE}
    SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
           CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS net_revenue, COUNT(DISTINCT customer_nk) AS unique_customers
    FROM lines GROUP BY 1
    """,
)
def _(t):
    return reports.daily_revenue(sales_of(t))


@query(
    "r15_sales_by_category",
    f"""
    WITH {LINES_CTE}
    SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, strftime(order_date, '%Y-%m') AS month_label, p_type AS category_name,
           CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS revenue, CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS net_revenue, COUNT(*) AS orders
    FROM lines JOIN part ON p_partkey = product_nk GROUP BY 1, 2, 3
    """,
)
def _(t):
    return reports.sales_by_category(lines_of(t), calendar_of(t), t.shop_products)


@query(
    "r16_monthly_customer_totals",
    f"""
    WITH {LINES_CTE}
    SELECT strftime(order_date, '%Y-%m') AS month, customer_nk, c_name AS full_name,
           CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS total_revenue, COUNT(DISTINCT order_nk) AS order_count
    FROM lines LEFT JOIN customer ON c_custkey = customer_nk GROUP BY 1, 2, 3
    """,
)
def _(t):
    return reports.monthly_customer_totals(sales_of(t), t.located_customers)


@query(
    "r17_recent_large_pending",
    f"""
    SELECT o_orderkey AS order_nk, c_name AS full_name, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, o_orderdate AS created_at
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 720 HOUR AND o_totalprice > 100000
    """,
)
def _(t):
    return reports.recent_large_pending(t.shop_orders, t.located_customers, dates.instant(AS_OF), 720, 100_000)


@query(
    "r18_active_without_cancelled",
    """
    SELECT o_orderkey AS order_nk, o_custkey AS customer_nk FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
    WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000)
    """,
)
def _(t):
    """Large pending orders stand in for cancelled ones, positive balances for active customers."""
    active = t.customer.filter("c_acctbal > 0").select("c_custkey")
    orders = t.orders.join(active, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_nk"), F.col("o_custkey").alias("customer_nk")
    )
    cancelled = t.orders.filter("o_orderstatus = 'P' AND o_totalprice > 300000")
    return joins.not_in(orders, "customer_nk", cancelled, "o_custkey")


@query(
    "r19_effective_discount",
    f"""
    WITH {LINES_CTE}
    SELECT ROUND(CAST(SUM(discount_amount) AS DOUBLE) / CAST(SUM(gross_revenue) AS DOUBLE), 6) AS effective_discount_rate FROM lines
    """,
)
def _(t):
    return reports.effective_discount(sales_of(t))


@query(
    "r20_revenue_by_year",
    f"""
    WITH {LINES_CTE}
    SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue,
           CAST(SUM(quantity) AS BIGINT) AS units FROM lines GROUP BY 1
    """,
)
def _(t):
    return reports.revenue_by_year(sales_of(t), calendar_of(t))


@query(
    "r20_denormalised_sales",
    f"""
    WITH {LINES_CTE}, {PLACES_CTE}
    SELECT country, p_brand AS brand, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS gross_revenue, COUNT(*) AS line_count
    FROM lines JOIN located ON located.customer_nk = lines.customer_nk JOIN part ON p_partkey = product_nk GROUP BY 1, 2
    """,
)
def _(t):
    """Over the wide table (w24): names are columns of the fact, no join is left in the report itself."""
    from orderloom.catalog.warehouse import wide_sales

    return wide_sales(t).groupBy("country", "brand").agg(
        total_cents("gross_cents").alias("gross_revenue"), F.count(F.lit(1)).alias("line_count")
    )
