"""Scans, filters, joins, aggregates, windows, pages, set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.bindings import money
from orderloom.catalog.core import DIM_CUSTOMER_CTE, LINES_CTE, PLACES_CTE, query
from orderloom.functions import dates, rules
from orderloom.functions.amounts import cents, from_cents, total_cents
from orderloom.functions.text import masked_email
from orderloom.operators import joins, paging, ranking, windows
from orderloom.operators.aggregates import distinct_counts
from orderloom.operators.hierarchy import below, descend
from orderloom.operators.merge import update_where
from orderloom.operators.scd import scd2_initial, scd2_merge
from orderloom.plans.warehouse import days_covering, dim_date, sales_by_order, sales_lines
from orderloom.session import cut, new_folder
from orderloom.sources import tables as files


# ---- scans and sinks ---------------------------------------------------------


@query("s1_scan_orders", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query(
    "s4_extract_window",
    """
    SELECT o_orderkey, o_custkey, c_name, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount, o_orderdate
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01'
    """,
)
def _(t):
    window = files.extract_window(t.orders, "o_orderdate", dt.datetime(1998, 3, 1), dt.datetime(1998, 4, 1))
    who = t.customer.select("c_custkey", "c_name")
    return window.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "c_name", money("o_totalprice").alias("total_amount"), "o_orderdate"
    )


@query(
    "s10_create_table_as",
    """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS line_count,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS gross
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def _(t):
    summary = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("line_count"), total_cents(cents("l_extendedprice")).alias("gross")
    )
    return files.create_table_as(summary, new_folder(t.spark, "ctas"))


@query(
    "s11_insert_select_archive",
    """
    SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
    WHERE o_orderdate < TIMESTAMP '1999-08-02' OR o_orderstatus = 'F'
    """,
)
def _(t):
    """Two appends into one archive: old orders, then delivered newer ones."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    path, limit = new_folder(t.spark, "archive"), dates.instant("1999-08-02 00:00:00")
    files.append(rows.filter(F.col("o_orderdate") < limit), path)
    files.append(rows.filter((F.col("o_orderdate") >= limit) & (F.col("o_orderstatus") == "F")), path)
    return files.scan(t.spark, path, rows.schema)


@query(
    "s12_csv_reference_table",
    """
    SELECT s_nationkey, n_name, COUNT(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2
    """,
)
def _(t):
    """A reference table kept as CSV, read with a declared schema."""
    path = new_folder(t.spark, "nations-csv")
    t.nation.select("n_nationkey", "n_name").write.csv(path, header=True)
    names = files.read_csv(t.spark, path, "n_nationkey int, n_name string")
    counted = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    return counted.join(names, F.col("s_nationkey") == F.col("n_nationkey")).select("s_nationkey", "n_name", "suppliers")


@query(
    "s13_partitioned_write",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, COUNT(*) AS line_count,
           CAST(SUM(l_quantity) AS BIGINT) AS units
    FROM lineitem WHERE year(l_shipdate) BETWEEN 1997 AND 1998 GROUP BY 1
    """,
)
def _(t):
    """Written by year, then read with a filter that skips the other years' directories."""
    path = new_folder(t.spark, "by-year")
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate")
    files.write_by(lines, path, "ship_year", F.year("l_shipdate"))
    return (
        t.spark.read.parquet(path)
        .filter(F.col("ship_year").between(1997, 1998))
        .groupBy("ship_year")
        .agg(F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").cast("long").alias("units"))
    )


# ---- projections and filters -------------------------------------------------


@query(
    "p1_project_rename",
    """
    SELECT o_orderkey AS order_nk, o_custkey AS customer_nk, o_orderstatus AS order_status,
           o_orderdate AS order_created_at FROM orders
    """,
)
def _(t):
    return t.orders.select(
        F.col("o_orderkey").alias("order_nk"),
        F.col("o_custkey").alias("customer_nk"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_created_at"),
    )


@query(
    "p2_derived_amounts",
    LINES_CTE.replace("\nlines AS", "WITH lines AS")
    + """
    SELECT order_item_nk, gross_revenue, discount_amount, CAST(net_revenue AS DECIMAL(14,2)) AS net_revenue,
           CAST(gross_revenue * 100 AS BIGINT) AS gross_cents
    FROM lines
    """,
)
def _(t):
    lines = sales_lines(t.delivered_orders, t.shop_items)
    return lines.select(
        "order_item_nk",
        "gross_revenue",
        "discount_amount",
        "net_revenue",
        (F.col("gross_revenue") * 100).cast("long").alias("gross_cents"),
    )


@query(
    "p3_and_or_comparison",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE (o_orderstatus = 'P' AND o_totalprice > 300000) OR (o_orderstatus = 'O' AND o_totalprice <= 50000)
    """,
)
def _(t):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return t.orders.filter(((status == "P") & (price > 300000)) | ((status == "O") & (price <= 50000))).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


@query(
    "p4_in_list",
    """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')
    """,
)
def _(t):
    wanted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    return t.orders.filter(wanted).select("o_orderkey", "o_orderpriority")


@query(
    "p5_between",
    """
    SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem
    WHERE l_quantity BETWEEN 10 AND 20
      AND l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
    """,
)
def _(t):
    days = F.col("l_shipdate").between(dates.instant("1997-01-01 00:00:00"), dates.instant("1997-12-31 00:00:00"))
    return t.lineitem.filter(F.col("l_quantity").between(10, 20) & days).select("l_orderkey", "l_quantity", "l_shipdate")


@query(
    "p6_is_null",
    """
    SELECT c_custkey, c_name FROM
      (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2001-01-01' END AS deleted_at FROM customer)
    WHERE deleted_at IS NULL
    """,
)
def _(t):
    deleted = F.when(F.col("c_acctbal") < 0, dates.instant("2001-01-01 00:00:00"))
    return t.customer.withColumn("deleted_at", deleted).filter("deleted_at IS NULL").select("c_custkey", "c_name")


@query(
    "p7_half_open_year",
    """
    SELECT o_orderstatus, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS amount
    FROM orders WHERE year(o_orderdate) = 1996 GROUP BY o_orderstatus
    """,
)
def _(t):
    return (
        t.orders.filter(dates.year_range(F.col("o_orderdate"), 1996))
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("orders"), total_cents(cents("o_totalprice")).alias("amount"))
    )


@query("p8_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE 'blue b_lt'")
def _(t):
    return t.part.filter(F.col("p_name").like("%ring%") | F.col("p_name").like("blue b_lt")).select("p_partkey", "p_name")


@query(
    "p9_row_comparison",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate < TIMESTAMP '1996-05-05' OR (o_orderdate = TIMESTAMP '1996-05-05' AND o_orderkey < 7000)
    """,
)
def _(t):
    before = paging.row_before(
        [F.col("o_orderdate"), F.col("o_orderkey")], [dates.instant("1996-05-05 00:00:00"), F.lit(7000)]
    )
    return t.orders.filter(before).select("o_orderkey", "o_orderdate")


@query(
    "p10_case",
    """
    SELECT p_partkey, CASE WHEN p_size = 0 THEN 'out_of_stock' WHEN p_size < 10 THEN 'low_stock'
                           WHEN p_size < 100 THEN 'adequate' ELSE 'well_stocked' END AS stock_status
    FROM part
    """,
)
def _(t):
    return t.part.select("p_partkey", rules.stock_band(F.col("p_size")).alias("stock_status"))


@query(
    "p11_boolean_as_number",
    """
    SELECT c_mktsegment, CAST(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS in_debt, COUNT(*) AS customers
    FROM customer GROUP BY c_mktsegment
    """,
)
def _(t):
    return t.customer.groupBy("c_mktsegment").agg(
        F.sum((F.col("c_acctbal") < 0).cast("int")).alias("in_debt"), F.count(F.lit(1)).alias("customers")
    )


@query("p12_literal_column", "SELECT 'shop' AS origin, s_suppkey, s_name FROM supplier")
def _(t):
    return t.supplier.select(F.lit("shop").alias("origin"), "s_suppkey", "s_name")


@query("p13_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


def tenant_view(df: DataFrame, column: str, tenant) -> DataFrame:
    """All reads of a tenant go through this filter."""
    return df.filter(F.col(column) == tenant)


@query("p14_tenant_view", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey = 7")
def _(t):
    return tenant_view(t.customer, "c_nationkey", 7).select("c_custkey", "c_name", "c_nationkey")


@query(
    "p15_masked_view",
    """
    SELECT c_custkey, c_mktsegment, substr(c_name, 1, 1) || '***@shop.example' AS email FROM customer
    """,
)
def _(t):
    """Allow-listed columns only; the address is masked."""
    email = F.concat("c_name", F.lit("@shop.example"))
    return t.customer.select("c_custkey", "c_mktsegment", masked_email(email).alias("email"))


@query(
    "p16_record_status",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'deleted' ELSE 'active' END AS record_status FROM customer
    """,
)
def _(t):
    deleted = F.when(F.col("c_acctbal") < 0, dates.instant("2001-01-01 00:00:00"))
    return t.customer.select("c_custkey", rules.record_status(deleted).alias("record_status"))


@query(
    "p17_bound_parameters",
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2000-01-01'
    """,
)
def _(t):
    return t.spark.sql(
        "SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderstatus = :status AND o_orderdate >= :since",
        args={"status": "P", "since": dates.instant("2000-01-01 00:00:00")},
        orders=t.orders,
    )


@query(
    "p18_scalar_variable",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT 0.9 * MAX(o_totalprice) FROM orders)
    """,
)
def _(t):
    """A value computed once and used as a variable: a scalar subquery, not a driver round trip."""
    limit = joins.one_value(t.orders.agg(F.max("o_totalprice") * 0.9))
    return t.orders.filter(F.col("o_totalprice") > limit).select("o_orderkey", "o_totalprice")


# ---- joins -------------------------------------------------------------------


@query(
    "j1_inner_join",
    "SELECT o_orderkey, c_name, o_orderstatus FROM orders JOIN customer ON c_custkey = o_custkey",
)
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "o_orderstatus"
    )


@query(
    "j2_left_join_filter_in_on",
    """
    SELECT c_custkey, COUNT(o_orderkey) AS orders,
           CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(14,2))), 0) AS DECIMAL(20,2)) AS amount
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
         AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    GROUP BY c_custkey
    """,
)
def _(t):
    """The right side is filtered and added up before the join; left rows all stay."""
    matching = t.orders.filter(dates.year_range(F.col("o_orderdate"), 1997) & (F.col("o_orderstatus") == "F"))
    per_customer = matching.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), total_cents(cents("o_totalprice")).alias("amount")
    )
    joined = t.customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        "c_custkey",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("amount", F.lit(0)).cast("decimal(20,2)").alias("amount"),
    )


@query(
    "j3_right_join",
    """
    SELECT n_name, s_suppkey, s_name FROM
      (SELECT * FROM supplier WHERE s_acctbal > 5000) s RIGHT JOIN nation ON s_nationkey = n_nationkey
    """,
)
def _(t):
    rich = t.supplier.filter("s_acctbal > 5000")
    return rich.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select(
        "n_name", "s_suppkey", "s_name"
    )


@query(
    "j4_cross_with_list",
    """
    SELECT p_partkey, w.warehouse_code FROM part CROSS JOIN (VALUES ('WH-HN-01'), ('WH-SGN-01')) w(warehouse_code)
    """,
)
def _(t):
    """A product with each entry of a short list: the list travels in the row, no join is needed."""
    warehouses = F.array(F.lit("WH-HN-01"), F.lit("WH-SGN-01"))
    return t.part.select("p_partkey", F.explode(warehouses).alias("warehouse_code"))


@query(
    "j5_self_join_pairs",
    """
    SELECT a.c_nationkey, a.c_mktsegment, COUNT(*) AS pairs FROM customer a
    JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey
    GROUP BY a.c_nationkey, a.c_mktsegment
    """,
)
def _(t):
    """How many pairs a self join with ``a.id < b.id`` finds per key, without emitting them."""
    return joins.count_pairs(t.customer, ["c_nationkey", "c_mktsegment"]).select("c_nationkey", "c_mktsegment", "pairs")


@query(
    "j5_partners_of_one",
    """
    SELECT b.c_custkey, b.c_nationkey, b.c_mktsegment FROM customer a JOIN customer b USING (c_nationkey, c_mktsegment)
    WHERE a.c_custkey = (SELECT MAX(c_custkey) FROM customer) AND b.c_custkey <> a.c_custkey
    """,
)
def _(t):
    """The pairs of one customer, the newest."""
    people = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    newest = people.agg(F.max("c_custkey")).first()[0]
    return joins.partners_of(people, ["c_nationkey", "c_mktsegment"], "c_custkey", newest)


@query(
    "j6_five_table_join",
    """
    SELECT r_name, p_type, COUNT(*) AS line_count, CAST(SUM(l_quantity) AS BIGINT) AS units
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    GROUP BY r_name, p_type
    """,
)
def _(t):
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .groupBy("r_name", "p_type")
        .agg(F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").cast("long").alias("units"))
    )


def dim_customer(t) -> DataFrame:
    """Type 2 customer dimension after two loads."""
    first = scd2_initial(t.customers_before, "customer_nk", F.lit("1995-01-01"), "customer_sk")
    return scd2_merge(first, t.customers_after, "customer_nk", ["segment"], F.lit("1998-01-01"), "customer_sk")


@query(
    "j7_star_join_current",
    f"""
    WITH {DIM_CUSTOMER_CTE}, {LINES_CTE}
    SELECT d.segment, d.country, COUNT(*) AS line_count, CAST(SUM(net_revenue) AS DECIMAL(20,2)) AS net_revenue
    FROM lines JOIN dim_customer d ON d.customer_nk = lines.customer_nk AND d.is_current
    GROUP BY d.segment, d.country
    """,
)
def _(t):
    """Revenue is added up per order, then per customer, before it meets the dimension."""
    sales = sales_by_order(t.delivered_orders, t.shop_items)
    per_customer = sales.groupBy("customer_nk").agg(
        F.sum("line_count").alias("n"), F.sum("net_cents").alias("net")
    )
    current = dim_customer(t).filter("is_current").select("customer_nk", "segment", "country")
    return per_customer.join(current, "customer_nk").groupBy("segment", "country").agg(
        F.sum("n").alias("line_count"), total_cents("net").alias("net_revenue")
    )


@query(
    "j8_join_on_derived_date",
    """
    SELECT CAST(year(d) AS INTEGER) AS year, CASE WHEN isodow(d) >= 6 THEN TRUE ELSE FALSE END AS is_weekend,
           COUNT(*) AS orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY 1, 2
    """,
)
def _(t):
    orders = t.orders.select(F.col("o_orderdate").cast("date").alias("full_date"))
    calendar = dim_date(days_covering(t.orders, "o_orderdate")).select("full_date", "year", "is_weekend")
    per_day = orders.groupBy("full_date").agg(F.count(F.lit(1)).alias("n"))
    return per_day.join(calendar, "full_date").groupBy("year", "is_weekend").agg(F.sum("n").alias("orders"))


@query(
    "j9_two_level_lookup",
    """
    SELECT c_custkey, COALESCE(n_name, 'Uncategorized') AS category_name, COALESCE(r_name, n_name) AS top_category
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA'
    """,
)
def _(t):
    """Own category, then its parent, falling back to the own one where no parent is found."""
    tops = t.region.filter("r_name <> 'ASIA'")
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(tops, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey",
            F.coalesce("n_name", F.lit("Uncategorized")).alias("category_name"),
            F.coalesce("r_name", "n_name").alias("top_category"),
        )
    )


@query(
    "j10_range_join",
    """
    WITH spans AS (
      SELECT o_orderkey AS span_id, o_orderkey AS low, o_orderkey + CAST(o_totalprice / 50000 AS BIGINT) AS high FROM orders
    )
    SELECT span_id, COUNT(*) AS points FROM customer JOIN spans ON c_custkey BETWEEN low AND high GROUP BY span_id
    """,
)
def _(t):
    """Customers whose number lies in a span laid out by each order; no equal key to join on."""
    spans = t.orders.select(
        F.col("o_orderkey").alias("span_id"),
        F.col("o_orderkey").alias("low"),
        (F.col("o_orderkey") + F.round(F.col("o_totalprice") / 50000).cast("long")).alias("high"),
    )
    points = t.customer.select("c_custkey")
    found = joins.range_join(points, spans, "c_custkey", "low", "high", width=16)
    return found.groupBy("span_id").agg(F.count(F.lit(1)).alias("points"))


@query(
    "j11_temporal_join",
    f"""
    WITH {DIM_CUSTOMER_CTE}
    SELECT o_orderkey, d.segment, d.effective_from FROM orders
    LEFT JOIN dim_customer d ON d.customer_nk = o_custkey AND d.effective_from <= CAST(o_orderdate AS DATE)
         AND (d.effective_to IS NULL OR d.effective_to > CAST(o_orderdate AS DATE))
    """,
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    return joins.as_of_dimension(t.orders, dim_customer(t), "o_custkey", "customer_nk", day).select(
        "o_orderkey", "segment", "effective_from"
    )


@query(
    "j12_semi_join",
    """
    SELECT c_custkey, c_name FROM customer WHERE EXISTS
      (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 400000)
    """,
)
def _(t):
    large = t.orders.filter("o_orderstatus = 'F' AND o_totalprice > 400000")
    buyers = large.select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(t.customer.select("c_custkey", "c_name"), ["c_custkey"], buyers)


@query(
    "j13_anti_join",
    """
    SELECT c_custkey, c_name FROM customer LEFT JOIN
      (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') recent ON o_custkey = c_custkey
    WHERE o_custkey IS NULL
    """,
)
def _(t):
    recent = t.orders.filter(F.col("o_orderdate") >= dates.instant("2001-01-01 00:00:00"))
    buyers = recent.select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(t.customer.select("c_custkey", "c_name"), ["c_custkey"], buyers, anti=True)


@query(
    "j14_not_in_subquery",
    """
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN
      (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
    """,
)
def _(t):
    urgent = t.orders.filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return joins.not_in(t.customer.select("c_custkey"), "c_custkey", urgent, "o_custkey")


@query(
    "j14_not_in_with_null",
    """
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN
      (SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey END FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
)
def _(t):
    """One NULL among the values: no row passes."""
    values = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("v")
    )
    return joins.not_in(t.customer.select("c_custkey"), "c_custkey", values, "v")


@query(
    "j15_scalar_subquery",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 30 DAY
    """,
)
def _(t):
    newest = joins.one_value(t.orders.agg(F.max("o_orderdate")))
    return t.orders.filter(F.col("o_orderdate") >= newest - F.expr("INTERVAL 30 DAYS")).select("o_orderkey", "o_orderdate")


@query(
    "j16_derived_table",
    """
    SELECT c_name, top.o_orderkey, top.o_totalprice FROM
      (SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50) top
    JOIN customer ON c_custkey = top.o_custkey
    """,
)
def _(t):
    """Limited before the join, with an order that makes the choice definite."""
    top = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)
    return top.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "o_orderkey", "o_totalprice")


@query(
    "j17_join_using",
    """
    SELECT nation_key, n_name, customers, suppliers FROM
      (SELECT c_nationkey AS nation_key, COUNT(*) AS customers FROM customer GROUP BY 1)
      JOIN (SELECT s_nationkey AS nation_key, COUNT(*) AS suppliers FROM supplier GROUP BY 1) USING (nation_key)
      JOIN (SELECT n_nationkey AS nation_key, n_name FROM nation) USING (nation_key)
    """,
)
def _(t):
    buyers = t.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(F.count(F.lit(1)).alias("customers"))
    sellers = t.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(F.count(F.lit(1)).alias("suppliers"))
    names = t.nation.select(F.col("n_nationkey").alias("nation_key"), "n_name")
    return buyers.join(sellers, "nation_key").join(names, "nation_key").select(
        "nation_key", "n_name", "customers", "suppliers"
    )


@query(
    "j18_batch_lookup",
    """
    SELECT o_orderkey, c_name, COUNT(l_orderkey) AS line_count
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY o_orderkey, c_name
    """,
)
def _(t):
    """Two joins in place of two lookups per order."""
    pending = t.orders.filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        pending.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("o_orderkey", "c_name", F.coalesce("n", F.lit(0)).alias("line_count"))
    )


@query(
    "j19_many_to_many",
    """
    SELECT DISTINCT p_brand, s_nationkey FROM lineitem JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    """,
)
def _(t):
    """Parts and suppliers through the lines that link them, each link once."""
    links = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return (
        links.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("p_brand", "s_nationkey")
        .distinct()
    )


@query(
    "j20_cross_source_join",
    """
    SELECT c_mktsegment, COUNT(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment
    """,
)
def _(t):
    """Orders from Parquet with customers from files of another format."""
    path = new_folder(t.spark, "customers-orc")
    t.customer.select("c_custkey", "c_mktsegment").write.orc(path)
    customers = t.spark.read.schema("c_custkey long, c_mktsegment string").orc(path)
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.sum("n").alias("orders"))
    )


@query(
    "j21_snowflake_chain",
    f"""
    WITH {PLACES_CTE}
    SELECT country, city, COUNT(*) AS customers, CAST(SUM(balance) AS DECIMAL(20,2)) AS balance
    FROM located GROUP BY country, city
    """,
)
def _(t):
    return t.located_customers.groupBy("country", "city").agg(
        F.count(F.lit(1)).alias("customers"), total_cents(cents("balance")).alias("balance")
    )


# ---- aggregates --------------------------------------------------------------


@query(
    "a1_group_aggregates",
    """
    SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS amount,
           CAST(ROUND(CAST(SUM(CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS BIGINT)) AS DOUBLE) / COUNT(*) / 100, 1)
                AS DOUBLE) AS mean,
           MIN(o_totalprice) AS lowest, MAX(o_totalprice) AS highest
    FROM orders GROUP BY o_orderstatus
    """,
)
def _(t):
    amount = total_cents(cents("o_totalprice"))
    return t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        amount.alias("amount"),
        F.round(amount / F.count(F.lit(1)), 1).cast("double").alias("mean"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )


@query(
    "a2_count_distinct",
    """
    SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT o_orderdate) AS days
    FROM orders GROUP BY o_orderstatus
    """,
)
def _(t):
    return distinct_counts(t.orders, ["o_orderstatus"], {"o_custkey": "customers", "o_orderdate": "days"})


@query("a3_having", "SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 12")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).filter("orders >= 12")


@query(
    "a4_global_aggregate",
    """
    SELECT COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS gross,
           MAX(l_shipdate) AS last_ship FROM lineitem
    """,
)
def _(t):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n"),
        total_cents(cents("l_extendedprice")).alias("gross"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "a5_conditional_null_safe",
    """
    SELECT c_nationkey, COUNT(CASE WHEN c_acctbal < 0 THEN c_custkey END) AS in_debt,
           CAST(COALESCE(SUM(CASE WHEN c_acctbal < -950 THEN CAST(c_acctbal AS DECIMAL(14,2)) END), 0) AS DECIMAL(20,2)) AS deep_debt
    FROM customer GROUP BY c_nationkey
    """,
)
def _(t):
    balance = F.col("c_acctbal")
    return t.customer.groupBy("c_nationkey").agg(
        F.count(F.when(balance < 0, F.col("c_custkey"))).alias("in_debt"),
        F.coalesce(total_cents(F.when(balance < -950, cents("c_acctbal"))), F.lit(0)).cast("decimal(20,2)").alias("deep_debt"),
    )


@query(
    "a6_group_by_month",
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS orders FROM orders GROUP BY 1
    """,
)
def _(t):
    return t.orders.groupBy(dates.month_label(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "a7_ratio_of_sums",
    f"""
    WITH {LINES_CTE}
    SELECT order_source, ROUND(CAST(SUM(discount_amount) AS DOUBLE) / CAST(SUM(gross_revenue) AS DOUBLE), 6) AS discount_rate
    FROM lines GROUP BY order_source
    """,
)
def _(t):
    sales = sales_by_order(t.delivered_orders, t.shop_items)
    rate = F.try_divide(total_cents("discount_cents").cast("double"), total_cents("gross_cents").cast("double"))
    return sales.groupBy("order_source").agg(F.round(rate, 6).alias("discount_rate"))


@query(
    "a8_dependent_columns",
    """
    SELECT c_custkey, ANY_VALUE(c_name) AS c_name, COUNT(*) AS orders
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
    """,
)
def _(t):
    """Columns that depend on the key join in after counting."""
    counted = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "orders")


@query(
    "a9_aggregate_of_aggregate",
    """
    SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n,
           CAST(SUM(COUNT(*)) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS per_priority
    FROM orders GROUP BY o_orderpriority, o_orderstatus
    """,
)
def _(t):
    counted = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("per_priority", F.sum("n").over(Window.partitionBy("o_orderpriority")))


@query(
    "a10_counter_per_parent",
    """
    SELECT p_partkey, COALESCE(n, 0) AS sold_lines FROM part LEFT JOIN
      (SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey
    """,
)
def _(t):
    counted = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return t.part.join(counted, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        "p_partkey", F.coalesce("n", F.lit(0)).alias("sold_lines")
    )


@query(
    "a11_duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
    """,
)
def _(t):
    from orderloom.operators.quality import duplicate_keys

    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "a12_shard_partial_and_total",
    """
    WITH s AS (SELECT CAST(o_custkey % 3 AS VARCHAR) AS source, COUNT(*) AS orders,
                      CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS amount
               FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
    SELECT * FROM s UNION ALL SELECT 'total', CAST(SUM(orders) AS BIGINT), CAST(SUM(amount) AS DECIMAL(20,2)) FROM s
    """,
)
def _(t):
    from orderloom.operators.sharding import hash_shard, per_shard_and_total

    pending = t.orders.filter("o_orderstatus = 'P'").withColumn("shard", hash_shard(F.col("o_custkey"), 3))
    measures = {"orders": F.count(F.lit(1)), "amount": total_cents(cents("o_totalprice"))}
    merged = per_shard_and_total(pending, "shard", measures)
    return merged.select("source", "orders", F.col("amount").cast("decimal(20,2)").alias("amount"))


@query(
    "a13_first_and_last",
    "SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order FROM orders GROUP BY o_custkey",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )


@query(
    "a14_pivot",
    """
    SELECT CAST(ts AS DATE) AS day,
           COUNT(*) FILTER (event_type = 'click') AS click, COUNT(*) FILTER (event_type = 'error') AS error,
           COUNT(*) FILTER (event_type = 'purchase') AS purchase, COUNT(*) FILTER (event_type = 'signup') AS signup,
           COUNT(*) FILTER (event_type = 'view') AS view
    FROM events GROUP BY 1
    """,
)
def _(t):
    kinds = ["click", "error", "purchase", "signup", "view"]
    return (
        t.events.groupBy(F.col("ts").cast("date").alias("day"))
        .pivot("event_type", kinds)
        .agg(F.count(F.lit(1)))
        .na.fill(0, kinds)
    )


@query(
    "a15_semi_additive",
    """
    WITH daily AS (
      SELECT user_id, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(14,2)) AS balance,
             ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    SELECT day, COUNT(*) AS users, CAST(SUM(balance) AS DECIMAL(20,2)) AS balance FROM daily WHERE rn = 1 GROUP BY day
    """,
)
def _(t):
    """Last value per user and day, then added up over users."""
    last = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.max_by(cents("value"), F.struct("ts", "event_id")).alias("balance")
    )
    return last.groupBy("day").agg(F.count(F.lit(1)).alias("users"), total_cents("balance").alias("balance"))


# ---- windows -----------------------------------------------------------------


@query(
    "n1_row_number_per_key",
    """
    SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
    """,
)
def _(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    numbered = windows.numbered(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], row_number="rn")
    return numbered.select("o_orderkey", "o_custkey", "rn")


@query(
    "n1_top_3_per_key",
    """
    SELECT o_custkey, o_orderkey, rn FROM (
      SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
      FROM orders) WHERE rn <= 3
    """,
)
def _(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    top = ranking.top_per_key(orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return top.select("o_custkey", "o_orderkey", F.col("rn").cast("long").alias("rn"))


UNITS_SQL = """
    WITH sold AS (SELECT l_partkey AS product, CAST(SUM(l_quantity) AS BIGINT) AS units FROM lineitem GROUP BY l_partkey)
"""


def units_sold(t) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_partkey").alias("product")).agg(F.sum("l_quantity").cast("long").alias("units"))


@query(
    "n2_rank_dense_rank",
    UNITS_SQL
    + """
    SELECT product, units, RANK() OVER (ORDER BY units DESC) AS rnk, DENSE_RANK() OVER (ORDER BY units DESC) AS dense FROM sold
    """,
)
def _(t):
    """Ranks over the whole product list."""
    ranked = ranking.with_ranks(units_sold(t), "units", "product", rank="rnk", dense_rank="dense")
    return ranked.select("product", "units", "rnk", "dense")


@query("n3_ntile", UNITS_SQL + "SELECT product, units, CAST(NTILE(4) OVER (ORDER BY units DESC, product) AS INTEGER) AS quartile FROM sold")
def _(t):
    return ranking.with_ntile(cut(units_sold(t), "units"), [("units", True), ("product", False)], 4, "quartile")


@query(
    "n4_lag",
    """
    SELECT event_id, user_id, LAG(event_id) OVER w AS prev_event, LAG(value) OVER w AS prev_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def _(t):
    before = windows.previous(
        t.events.select("event_id", "user_id", "ts", "value"),
        ["user_id"],
        ["ts", "event_id"],
        {"event_id": "prev_event", "value": "prev_value"},
    )
    return before.select("event_id", "user_id", "prev_event", "prev_value")


@query(
    "n4_lag_lead_by_month",
    """
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS orders FROM orders GROUP BY 1)
    SELECT month, orders, LAG(orders, 1) OVER (ORDER BY month) AS prev_orders,
           LAG(orders, 12) OVER (ORDER BY month) AS year_ago, LEAD(orders) OVER (ORDER BY month) AS next_orders FROM m
    """,
)
def _(t):
    monthly = t.orders.groupBy(dates.month_label(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    by_month = Window.orderBy("month")  # one row per month
    return monthly.select(
        "month",
        "orders",
        F.lag("orders", 1).over(by_month).alias("prev_orders"),
        F.lag("orders", 12).over(by_month).alias("year_ago"),
        F.lead("orders").over(by_month).alias("next_orders"),
    )


@query(
    "n5_running_sum_rows",
    """
    SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      AS DECIMAL(20,2)) AS running_total FROM orders
    """,
)
def _(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", cents("o_totalprice").alias("amount"))
    summed = windows.running(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"running_total": F.col("amount")}
    )
    return summed.select("o_orderkey", "o_custkey", from_cents("running_total", 20).alias("running_total"))


@query(
    "n6_running_sum_peers",
    """
    SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) OVER (ORDER BY o_orderdate) AS DECIMAL(20,2)) AS so_far
    FROM orders
    """,
)
def _(t):
    """Default frame over the whole table: orders of one day share their total."""
    orders = t.orders.select("o_orderkey", "o_orderdate", cents("o_totalprice").alias("amount"))
    summed = windows.running_with_peers(orders, [], ["o_orderdate"], {"so_far": F.col("amount")})
    return summed.select("o_orderkey", from_cents("so_far", 20).alias("so_far"))


@query(
    "n7_percent_of_total",
    """
    SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) OVER (PARTITION BY o_custkey) AS DECIMAL(20,2)) AS customer_total,
           ROUND(o_totalprice / CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) * 100, 2) AS pct
    FROM orders
    """,
)
def _(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    summed = windows.with_total(orders, ["o_custkey"], {"customer_total": total_cents(cents("o_totalprice"))})
    share = F.try_divide(F.col("o_totalprice"), F.col("customer_total").cast("double")) * 100
    return summed.select("o_orderkey", "o_custkey", "customer_total", F.round(share, 2).alias("pct"))


@query(
    "n8_month_over_month",
    """
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS revenue
               FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
         l AS (SELECT *, LAG(revenue) OVER (ORDER BY month) AS prev_revenue FROM m)
    SELECT month, revenue, prev_revenue,
           ROUND((CAST(revenue AS DOUBLE) - CAST(prev_revenue AS DOUBLE)) / CAST(prev_revenue AS DOUBLE) * 100, 2) AS growth_pct FROM l
    """,
)
def _(t):
    from orderloom.plans.reports import month_over_month

    return month_over_month(t.delivered_orders)


# ---- sorting and pages -------------------------------------------------------


@query("o1_order_by", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC NULLS LAST, o_orderkey")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        F.asc_nulls_first("o_custkey"), F.desc_nulls_last("o_totalprice"), "o_orderkey"
    )


@query("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("o3_offset_page", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20 OFFSET 80")
def _(t):
    order = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return paging.offset_page(t.orders.select("o_orderkey", "o_orderdate"), order, size=20, page=5)


@query(
    "o4_keyset_page",
    """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1999-06-01', 500) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20
    """,
)
def _(t):
    cursor = [dates.instant("1999-06-01 00:00:00"), F.lit(500)]
    return paging.keyset_page(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], cursor, 20)


@query("o5_seek_page", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1234 ORDER BY o_orderkey LIMIT 25")
def _(t):
    return paging.seek_page(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 1234, 25)


@query(
    "o6_page_envelope",
    """
    WITH f AS (SELECT o_orderdate, o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
               WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1999-06-01', 500))
    SELECT CAST(COUNT(*) FILTER (rn <= 20) AS INTEGER) AS returned, COUNT(*) > 20 AS has_more,
           MAX(o_orderdate) FILTER (rn = 20) AS next_o_orderdate, MAX(o_orderkey) FILTER (rn = 20) AS next_o_orderkey FROM f
    """,
)
def _(t):
    cursor = [dates.instant("1999-06-01 00:00:00"), F.lit(500)]
    return paging.page_envelope(t.orders, ["o_orderdate", "o_orderkey"], cursor, 20)


@query("s14_row_count", "SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders")
def _(t):
    """The count comes from the file footers."""
    n = files.file_row_count(t.spark, f"{t.folder}/orders.parquet")
    return t.region.limit(1).select(F.lit("orders").alias("table_name"), F.lit(n).cast("long").alias("row_count"))


@query(
    "o6_page_envelope_total",
    """
    WITH f AS (SELECT o_orderdate, o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    SELECT CAST(COUNT(*) FILTER (rn <= 20) AS INTEGER) AS returned, COUNT(*) > 20 AS has_more, (SELECT COUNT(*) FROM orders) AS approximate_total,
           MAX(o_orderdate) FILTER (rn = 20) AS next_o_orderdate, MAX(o_orderkey) FILTER (rn = 20) AS next_o_orderkey FROM f
    """,
)
def _(t):
    """The first page, with the total that the file footers tell."""
    total = files.file_row_count(t.spark, f"{t.folder}/orders.parquet")
    return paging.page_envelope(t.orders, ["o_orderdate", "o_orderkey"], None, 20, about=total)


@query(
    "o8_random_pick_law",
    "SELECT 1::BIGINT AS picked, TRUE AS in_table",
)
def _(t):
    """However the choice falls, it is one row of the table."""
    picked = t.orders.select("o_orderkey").orderBy(F.rand(7)).limit(1)
    found = picked.join(t.orders.select("o_orderkey").withColumn("_in", F.lit(True)).distinct(), "o_orderkey", "left")
    return found.agg(F.count(F.lit(1)).alias("picked"), F.bool_and(F.coalesce("_in", F.lit(False))).alias("in_table"))


@query(
    "o7_scatter_gather_top",
    """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P'
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 10
    """,
)
def _(t):
    pending = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey", "o_orderdate")
    shards = [pending.filter(F.pmod("o_custkey", F.lit(3)) == n) for n in range(3)]
    return paging.gather_top(shards, [F.desc("o_orderdate"), F.col("o_orderkey")], 10)


@query(
    "o7_top_per_shard",
    """
    SELECT shard, o_orderkey FROM (SELECT CAST(o_custkey % 3 AS BIGINT) AS shard, o_orderkey,
      ROW_NUMBER() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders WHERE o_orderstatus = 'P') WHERE rn <= 10
    """,
)
def _(t):
    pending = t.orders.filter("o_orderstatus = 'P'").select(
        F.pmod("o_custkey", F.lit(3)).alias("shard"), "o_orderkey", "o_orderdate"
    )
    return paging.top_per_shard(pending, "shard", [F.desc("o_orderdate"), F.col("o_orderkey")], 10).select("shard", "o_orderkey")


@query("o8_random_pick")
def _(t):
    """One order in random order; rows only, as the choice is random."""
    return t.orders.select("o_orderkey", "o_orderstatus").orderBy(F.rand(7)).limit(1)


@query(
    "o9_batch_rewrite",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders
    """,
)
def _(t):
    """What is done elsewhere in chunks of ten thousand rows is one rewrite here."""
    stale = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < dates.instant("1996-01-01 00:00:00"))
    return update_where(t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), stale, {"o_orderstatus": F.lit("X")}).drop("o_orderdate")


# ---- set operations and recursion --------------------------------------------


@query(
    "u1_union_all_counts",
    """
    SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
    UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'part', COUNT(*) FROM part
    """,
)
def _(t):
    from orderloom.plans.warehouse import union_all

    counted = [
        t.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in ["orders", "lineitem", "customer", "part"]
    ]
    return union_all(counted)


@query("u2_union_distinct", "SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    buyers = t.customer.select(F.col("c_nationkey").alias("nation_key"))
    sellers = t.supplier.select(F.col("s_nationkey").alias("nation_key"))
    return buyers.union(sellers).distinct()


@query(
    "u3_cte_chain",
    """
    WITH done AS (SELECT o_custkey, COUNT(*) AS orders, SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS revenue
                  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
         classed AS (SELECT *, CASE WHEN revenue > 1500000 THEN 'vip' WHEN revenue > 700000 THEN 'regular' ELSE 'new' END AS segment FROM done)
    SELECT segment, COUNT(*) AS customers, CAST(SUM(orders) AS BIGINT) AS orders FROM classed GROUP BY segment
    """,
)
def _(t):
    return t.spark.sql(
        """
        WITH done AS (SELECT customer_nk, COUNT(*) AS orders, SUM(total_amount) AS revenue FROM {orders} GROUP BY customer_nk),
             classed AS (SELECT *, CASE WHEN revenue > 1500000 THEN 'vip' WHEN revenue > 700000 THEN 'regular'
                                        ELSE 'new' END AS segment FROM done)
        SELECT segment, COUNT(*) AS customers, SUM(orders) AS orders FROM classed GROUP BY segment
        """,
        orders=t.delivered_orders,
    )


@query(
    "u4_number_series",
    """
    WITH RECURSIVE per_order AS (SELECT l_orderkey, COUNT(*) AS c FROM lineitem GROUP BY l_orderkey),
      n AS (SELECT 1 AS line_count UNION ALL SELECT line_count + 1 FROM n WHERE line_count < (SELECT MAX(c) FROM per_order))
    SELECT CAST(n.line_count AS BIGINT) AS line_count, COUNT(p.c) AS orders FROM n LEFT JOIN per_order p ON p.c = n.line_count GROUP BY 1
    """,
)
def _(t):
    """The series 1..n, n being the longest order, with the orders of each length (also none)."""
    lengths = (
        t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("c").agg(F.count(F.lit(1)).alias("orders"))
    )
    series = lengths.agg(F.max("c").alias("n")).select(F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("line_count"))
    return series.join(lengths, F.col("line_count") == F.col("c"), "left").select(
        "line_count", F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query(
    "u5_date_series",
    """
    WITH RECURSIVE d AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS day FROM orders
                         UNION ALL SELECT CAST(day + INTERVAL 1 DAY AS DATE) FROM d WHERE day < (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders)),
      c AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT d.day, COALESCE(c.n, 0) AS orders FROM d LEFT JOIN c ON c.day = d.day
    """,
)
def _(t):
    counted = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return days_covering(t.orders, "o_orderdate").join(counted, "full_date", "left").select(
        F.col("full_date").alias("day"), F.coalesce("n", F.lit(0)).alias("orders")
    )


TREE_CTE = """
tree AS (
  SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer
)"""


def place_tree(t) -> DataFrame:
    """Regions, nations and customers as one tree of three levels."""
    def node(df, prefix, key, parent_prefix, parent, name):
        above = F.concat(F.lit(parent_prefix), parent) if parent else F.lit(None).cast("string")
        return df.select(F.concat(F.lit(prefix), F.col(key)).alias("id"), above.alias("parent_id"), F.col(name).alias("name"))

    return (
        node(t.region, "r", "r_regionkey", None, None, "r_name")
        .unionByName(node(t.nation, "n", "n_nationkey", "r", "n_regionkey", "n_name"))
        .unionByName(node(t.customer, "c", "c_custkey", "n", "c_nationkey", "c_name"))
    )


@query(
    "u6_recursive_tree_walk",
    f"""
    WITH RECURSIVE {TREE_CTE},
    walk AS (SELECT id, parent_id, name, 0 AS depth FROM tree WHERE id = 'r2'
             UNION ALL SELECT c.id, c.parent_id, c.name, w.depth + 1 FROM tree c JOIN walk w ON w.id = c.parent_id)
    SELECT id, parent_id, name, depth FROM walk
    """,
)
def _(t):
    """All that lies below one region, level by level."""
    return descend(place_tree(t), F.col("id") == "r2").select("id", "parent_id", "name", "depth")


@query(
    "u6_recursive_query",
    """
    WITH RECURSIVE tree AS (SELECT 'r' || r_regionkey AS id, 'world' AS parent_id FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
                            UNION ALL SELECT 'world', NULL),
    below AS (SELECT id, parent_id, 0 AS depth FROM tree WHERE id = 'world' UNION ALL SELECT c.id, c.parent_id, b.depth + 1 FROM tree c JOIN below b ON c.parent_id = b.id)
    SELECT b.id, b.depth, COALESCE(n, 0) AS customers FROM below b LEFT JOIN (SELECT 'n' || c_nationkey AS id, COUNT(*) AS n FROM customer GROUP BY 1) c ON c.id = b.id
    """,
)
def _(t):
    """The tree of places below one node, with the customers at each place."""
    places = place_tree(t).filter("id NOT LIKE 'c%'")
    world = F.coalesce("parent_id", F.lit("world")).alias("parent_id")
    top = places.select(F.lit("world").alias("id"), F.lit(None).cast("string").alias("parent_id")).distinct()
    tree = places.select("id", world).unionByName(top)
    per_nation = t.customer.groupBy(F.concat(F.lit("n"), "c_nationkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return below(tree, "world").join(per_nation, "id", "left").select(
        "id", "depth", F.coalesce("n", F.lit(0)).alias("customers")
    )
