"""Warehouse loads: dimensions, staging, merges, facts, segments, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from orderloom.bindings import AS_OF, FIRST_LOAD, SECOND_LOAD, money
from orderloom.catalog.core import DIM_CUSTOMER_CTE, LINES_CTE, PLACES_CTE, SNAPSHOTS_CTE, checksum_sql, key_sql, query
from orderloom.catalog.relational import dim_customer
from orderloom.catalog.reports import calendar_of, lines_of, sales_of, shop_payments
from orderloom.functions import dates
from orderloom.functions.amounts import total_cents
from orderloom.functions.keys import surrogate_key
from orderloom.operators import merge, quality, scd
from orderloom.plans import marts, migration, warehouse
from orderloom.session import new_folder
from orderloom.sources import tables as files
from orderloom.sources.increments import IncrementTable
from orderloom.sources.snapshots import SnapshotTable, WatermarkStore
from orderloom.streaming import changes


@query(
    "w1_dim_date",
    """
    WITH RECURSIVE d AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS full_date FROM orders UNION ALL
      SELECT CAST(full_date + INTERVAL 1 DAY AS DATE) FROM d WHERE full_date < (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders))
    SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
      CASE WHEN month(full_date) <= 6 THEN 1 ELSE 2 END AS year_half, CAST(quarter(full_date) AS INTEGER) AS quarter,
      'Q' || quarter(full_date) AS quarter_name, CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
      'Tháng ' || month(full_date) AS month_name_vi, left(monthname(full_date), 3) AS month_short,
      CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(isodow(full_date) AS INTEGER) AS day_of_week,
      CAST(dayofweek(full_date) + 1 AS INTEGER) AS dow_sunday1, dayname(full_date) AS day_name,
      CASE dayofweek(full_date) WHEN 0 THEN 'Chủ Nhật' WHEN 1 THEN 'Thứ Hai' WHEN 2 THEN 'Thứ Ba' WHEN 3 THEN 'Thứ Tư'
        WHEN 4 THEN 'Thứ Năm' WHEN 5 THEN 'Thứ Sáu' ELSE 'Thứ Bảy' END AS day_name_vi,
      CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
      isodow(full_date) >= 6 AS is_weekend, COALESCE(h.full_day IS NOT NULL, FALSE) AS is_holiday_vn,
      CAST(CASE WHEN month(full_date) < 4 THEN year(full_date) - 1 ELSE year(full_date) END AS INTEGER) AS fiscal_year,
      CAST(CASE WHEN month(full_date) < 4 THEN 4 WHEN month(full_date) < 7 THEN 1 WHEN month(full_date) < 10 THEN 2 ELSE 3 END AS INTEGER) AS fiscal_quarter
    FROM d LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS full_day FROM orders GROUP BY 1
                      HAVING COUNT(*) FILTER (o_orderpriority = '1-URGENT') = 0) h ON h.full_day = full_date
    """,
)
def _(t):
    """Calendar from the first to the last order; days without an urgent order play the holidays."""
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    quiet = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(urgent.alias("n")).filter("n = 0")
    return warehouse.dim_date(warehouse.days_covering(t.orders, "o_orderdate"), holidays=quiet)


@query(
    "w2_stg_orders",
    """
    SELECT o_orderkey AS order_nk, o_custkey AS customer_nk,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'pending' ELSE 'processing' END AS order_status,
           CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS order_day_of_week,
           o_orderstatus = 'F' AS is_completed, FALSE AS is_cancelled
    FROM orders
    """,
)
def _(t):
    return warehouse.stg_orders(t.shop_orders).select(
        "order_nk", "customer_nk", "order_status", "order_date", "order_year", "order_month", "order_day_of_week",
        "is_completed", "is_cancelled",
    )


def shop_customers(t):
    """Customers in the shop's own layout; those deep in debt are deleted, first orders date the sign-up."""
    signed_up = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("created_at"))
    gone = F.when(F.col("c_acctbal") < -500, dates.instant("2001-01-01 00:00:00"))
    return t.customer.join(signed_up, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("id"),
        F.md5("c_name").alias("uuid"),
        F.concat(F.lit(" "), "c_name", F.lit("@Shop.Example ")).alias("email"),
        F.concat("c_name", F.lit(" ")).alias("full_name"),
        F.lit(None).cast("string").alias("phone"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("inactive").alias("status"),
        "created_at",
        F.col("created_at").alias("updated_at"),
        gone.alias("deleted_at"),
    )


def shop_addresses(t):
    """Default address for all but one segment; region as country."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("n_name").alias("city"),
        F.when(F.col("n_regionkey") == 0, "AF").when(F.col("n_regionkey") == 1, "AM").alias("country"),
        (F.col("c_mktsegment") != "FURNITURE").alias("is_default"),
    )


@query(
    "w3_stg_customers",
    f"""
    WITH s AS (SELECT o_custkey, MIN(o_orderdate) AS created_at FROM orders GROUP BY 1)
    SELECT c_custkey AS customer_nk, lower(c_name) || '@shop.example' AS email, c_name AS full_name,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN n_name END AS city,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN 'VN' WHEN n_regionkey = 0 THEN 'AF' WHEN n_regionkey = 1 THEN 'AM' ELSE 'VN' END AS country_code,
           CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS is_active,
           CASE WHEN date_diff('day', CAST(created_at AS DATE), DATE '1996-01-01') <= 30 THEN 1 ELSE 0 END AS is_new_customer
    FROM customer JOIN s ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= -500
    """,
)
def _(t):
    staged = warehouse.stg_customers(shop_customers(t), shop_addresses(t), dates.instant("1996-01-01 00:00:00"))
    return staged.select("customer_nk", "email", "full_name", "city", "country_code", "is_active", "is_new_customer")


@query(
    "w4_stg_products",
    """
    WITH c AS (SELECT DISTINCT p_type || '/' || p_brand AS id, p_type AS parent_id, p_brand AS name FROM part WHERE p_brand <> 'Brand#1')
    SELECT p_partkey AS product_nk, COALESCE(c.name, 'Uncategorized') AS category_name, COALESCE(c.parent_id, c.name) AS top_category,
           CAST((((CAST(ROUND(p_retailprice * 100) AS BIGINT) - 80000) * 20000 + CAST(ROUND(p_retailprice * 100) AS BIGINT)) // (2 * CAST(ROUND(p_retailprice * 100) AS BIGINT))) / 100 AS DECIMAL(7,2)) AS margin_pct,
           CASE WHEN p_size < 10 THEN 'low_stock' ELSE 'adequate' END AS stock_status
    FROM part LEFT JOIN c ON c.id = p_type || '/' || p_brand WHERE p_size <= 40
    """,
)
def _(t):
    """Type and brand as a two-level category tree in which one brand is missing; large sizes are archived."""
    brand = t.part.filter("p_brand <> 'Brand#1'").select("p_type", "p_brand").distinct()
    categories = brand.select(
        F.concat_ws("/", "p_type", "p_brand").alias("id"),
        F.col("p_type").alias("parent_id"),
        F.col("p_brand").alias("name"),
        F.lower("p_brand").alias("slug"),
    ).unionByName(
        t.part.select("p_type").distinct().select(
            F.col("p_type").alias("id"),
            F.lit(None).cast("string").alias("parent_id"),
            F.col("p_type").alias("name"),
            F.lower("p_type").alias("slug"),
        )
    )
    products = t.part.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.concat_ws("/", "p_type", "p_brand").alias("category_id"),
        F.col("p_name").alias("name"),
        money("p_retailprice", 12).alias("price"),
        F.lit(800).cast("decimal(12,2)").alias("cost_price"),
        F.when(F.col("p_size") > 40, "archived").otherwise("active").alias("status"),
        F.col("p_size").alias("stock_quantity"),
    )
    staged = warehouse.stg_products(products, categories)
    return staged.select("product_nk", "category_name", "top_category", "margin_pct", "stock_status")


# ---- merges ------------------------------------------------------------------

TARGET_SQL = "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS amount, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
SOURCE_SQL = """SELECT o_orderkey, 'S' AS o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 1 AS DECIMAL(14,2)) AS amount, o_orderdate
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"""


def merge_sides(t):
    """Old orders as the target, newer ones with changed values as the source; a year overlaps."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("amount"), "o_orderdate")
    target = rows.filter(F.col("o_orderdate") < dates.instant("1999-01-01 00:00:00"))
    source = rows.filter(F.col("o_orderdate") >= dates.instant("1998-01-01 00:00:00")).select(
        "o_orderkey",
        F.lit("S").alias("o_orderstatus"),
        (F.col("amount") + 1).cast("decimal(14,2)").alias("amount"),
        "o_orderdate",
    )
    return target, source


@query(
    "w5_upsert",
    f"""
    WITH t AS ({TARGET_SQL}), s AS ({SOURCE_SQL})
    SELECT o_orderkey, COALESCE(t.o_orderstatus, s.o_orderstatus) AS o_orderstatus, COALESCE(s.amount, t.amount) AS amount,
           COALESCE(t.o_orderdate, s.o_orderdate) AS o_orderdate
    FROM t FULL JOIN s USING (o_orderkey)
    """,
)
def _(t):
    """Only the amount is updated on known keys; the source comes twice and is reduced first."""
    target, source = merge_sides(t)
    older = source.withColumns({"amount": (F.col("amount") - 5).cast("decimal(14,2)"), "seq": F.lit(1)})
    twice = source.withColumn("seq", F.lit(2)).unionByName(older)
    return merge.upsert(target, twice, ["o_orderkey"], update=["amount"], latest_by=["seq"])


@query(
    "w6_additive_upsert",
    """
    SELECT l_partkey, l_suppkey, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2
    """,
)
def _(t):
    """Quantities of two halves of the lines added up per part and supplier."""
    rows = t.lineitem.select("l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"), "l_returnflag")
    stock = rows.filter("l_returnflag = 'A'").groupBy("l_partkey", "l_suppkey").agg(F.sum("quantity").alias("quantity"))
    return merge.additive_upsert(stock, rows.filter("l_returnflag <> 'A'"), ["l_partkey", "l_suppkey"], ["quantity"])


@query(
    "w6_insert_absent",
    f"""
    WITH t AS ({TARGET_SQL}), s AS ({SOURCE_SQL})
    SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)
    """,
)
def _(t):
    target, source = merge_sides(t)
    return merge.insert_absent(target, source, ["o_orderkey"])


@query(
    "w6_insert_absent_repeats",
    """
    WITH t AS (SELECT o_custkey, MAX(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
    SELECT * FROM t UNION ALL
    SELECT o_custkey, MAX(o_orderkey) FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM t) GROUP BY 1
    """,
)
def _(t):
    """The source has a customer many times over; one row of each comes in."""
    target = t.orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))
    return merge.insert_absent(target, t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"])


@query(
    "w7_same_day_change",
    f"""
    WITH {SNAPSHOTS_CTE}
    SELECT COUNT(*) AS versions, COUNT(*) AS different_keys, COUNT(*) FILTER (segment = 'TWICE') AS changed_twice
    FROM (SELECT CASE WHEN segment = 'BUILDING' THEN 'TWICE' ELSE segment END AS segment FROM cust_before
          UNION ALL SELECT segment FROM cust_before WHERE segment = 'BUILDING')
    """,
)
def _(t):
    """Two changes on one day: the second replaces the version that the first has opened."""
    before = t.customers_before
    dim = scd.scd2_initial(before, "customer_nk", F.lit(FIRST_LOAD))
    for name in ("ONCE", "TWICE"):
        renamed = F.when(F.col("segment") == "BUILDING", name).otherwise(F.col("segment"))
        dim = scd.scd2_merge(dim, before.withColumn("segment", renamed), "customer_nk", ["segment"], F.lit(SECOND_LOAD))
    return dim.groupBy("dim_sk").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("segment") == "TWICE").cast("long")).alias("t")).agg(
        F.sum("n").alias("versions"), F.count(F.lit(1)).alias("different_keys"), F.sum("t").alias("changed_twice")
    )


@query(
    "w7_scd2_merge",
    f"""
    WITH {DIM_CUSTOMER_CTE}
    SELECT customer_sk, customer_nk, segment, city, effective_from, effective_to, is_current FROM dim_customer
    """,
)
def _(t):
    return dim_customer(t).select(
        "customer_sk", "customer_nk", "segment", "city", "effective_from", "effective_to", "is_current"
    )


@query(
    "w7_scd2_close_missing",
    f"""
    WITH {SNAPSHOTS_CTE}
    SELECT b.customer_nk, b.segment, DATE '{FIRST_LOAD}' AS effective_from,
           CASE WHEN a.segment IS DISTINCT FROM b.segment THEN DATE '{SECOND_LOAD}' END AS effective_to,
           a.segment IS NOT DISTINCT FROM b.segment AS is_current
    FROM cust_before b LEFT JOIN cust_after a USING (customer_nk)
    UNION ALL
    SELECT a.customer_nk, a.segment, DATE '{SECOND_LOAD}', CAST(NULL AS DATE), TRUE
    FROM cust_after a LEFT JOIN cust_before b USING (customer_nk) WHERE b.segment IS DISTINCT FROM a.segment
    """,
)
def _(t):
    """Customers that the second snapshot lacks end with it."""
    first = scd.scd2_initial(t.customers_before, "customer_nk", F.lit(FIRST_LOAD))
    second = scd.scd2_merge(first, t.customers_after, "customer_nk", ["segment"], F.lit(SECOND_LOAD), close_missing=True)
    return second.select("customer_nk", "segment", "effective_from", "effective_to", "is_current")


@query(
    "w8_scd1_overwrite",
    f"""
    WITH {SNAPSHOTS_CTE}
    SELECT customer_nk, COALESCE(a.full_name, b.full_name) AS full_name, COALESCE(a.segment, b.segment) AS segment
    FROM cust_before b FULL JOIN cust_after a USING (customer_nk)
    """,
)
def _(t):
    columns = ["customer_nk", "full_name", "segment"]
    return scd.scd1_merge(t.customers_before.select(*columns), t.customers_after.select(*columns), "customer_nk")


@query(
    "w9_scd3_previous_value",
    f"""
    WITH {SNAPSHOTS_CTE}
    SELECT b.customer_nk, COALESCE(a.segment, b.segment) AS segment, CASE WHEN a.segment <> b.segment THEN b.segment END AS previous_segment,
           CASE WHEN a.segment <> b.segment THEN DATE '{SECOND_LOAD}' END AS segment_changed_on
    FROM cust_before b LEFT JOIN cust_after a USING (customer_nk)
    """,
)
def _(t):
    dim = t.customers_before.select(
        "customer_nk",
        "segment",
        F.lit(None).cast("string").alias("previous_segment"),
        F.lit(None).cast("date").alias("segment_changed_on"),
    )
    return scd.scd3_merge(dim, t.customers_after, "customer_nk", "segment", F.lit(SECOND_LOAD))


@query(
    "w10_snapshot_diff",
    f"""
    WITH {SNAPSHOTS_CTE},
    j AS (SELECT COALESCE(b.customer_nk, a.customer_nk) AS record_id, b.segment AS old_segment, a.segment AS new_segment
          FROM cust_before b FULL JOIN cust_after a ON a.customer_nk = b.customer_nk)
    SELECT 'customers' AS table_name, record_id,
           CASE WHEN old_segment IS NULL THEN 'INSERT' WHEN new_segment IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
           CASE WHEN old_segment IS NOT NULL THEN '{{"customer_nk":' || record_id || ',"segment":"' || old_segment || '"}}' END AS old_values,
           CASE WHEN new_segment IS NOT NULL THEN '{{"customer_nk":' || record_id || ',"segment":"' || new_segment || '"}}' END AS new_values
    FROM j WHERE old_segment IS DISTINCT FROM new_segment
    """,
)
def _(t):
    columns = ["customer_nk", "segment"]
    return scd.diff(t.customers_before.select(*columns), t.customers_after.select(*columns), "customer_nk", "customers")


@query("w10_applied_diff", f"WITH {SNAPSHOTS_CTE} SELECT customer_nk, segment FROM cust_after")
def _(t):
    """The audit rows between two snapshots, applied to the older one, give the newer one."""
    before, after = (df.select("customer_nk", "segment") for df in (t.customers_before, t.customers_after))
    return scd.apply_diff(before, scd.diff(before, after, "customer_nk", "customers"), "customer_nk")


@query(
    "w11_surrogate_hash_key",
    f"SELECT p_partkey, {key_sql('p_type', 'p_brand', 'CASE WHEN p_size > 25 THEN p_size END')} AS sk FROM part",
)
def _(t):
    size = F.when(F.col("p_size") > 25, F.col("p_size"))
    return t.part.select("p_partkey", surrogate_key(F.col("p_type"), F.col("p_brand"), size).alias("sk"))


@query(
    "w11_dense_integer_key",
    "SELECT c_custkey, 1000 + ROW_NUMBER() OVER (ORDER BY c_name, c_custkey) AS sk FROM customer",
)
def _(t):
    """Numbers without gaps over the whole table, in name order, following the keys given before."""
    return warehouse.with_dense_key(t.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], "sk", 1000).select("c_custkey", "sk")


# ---- facts -------------------------------------------------------------------


def dim_product(t):
    """First load of the product dimension; archived sizes are not in it."""
    return scd.scd2_initial(t.shop_products.filter("stock_quantity <= 45"), "product_nk", F.lit(FIRST_LOAD), "product_sk")


@query(
    "w12_fact_sales",
    f"""
    WITH {DIM_CUSTOMER_CTE}, {LINES_CTE}
    SELECT order_item_nk, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, COALESCE(customer_sk, '-1') AS customer_sk,
           CASE WHEN p_size <= 45 THEN {key_sql("p_partkey", f"'{FIRST_LOAD}'")} ELSE '-1' END AS product_sk, order_nk, quantity,
           CAST(FLOOR((2 * CAST(gross_revenue * 100 AS BIGINT) + quantity) // (2 * quantity)) / 100 AS DECIMAL(12,2)) AS unit_price,
           discount_amount, gross_revenue, CAST(net_revenue AS DECIMAL(14,2)) AS net_revenue, order_source
    FROM lines LEFT JOIN dim_customer d ON d.customer_nk = lines.customer_nk AND d.is_current
    LEFT JOIN part ON p_partkey = product_nk
    """,
)
def fact_sales(t):
    return warehouse.fact_sales(lines_of(t), calendar_of(t), dim_customer(t), dim_product(t))


@query(
    "w13_fact_orders_incremental",
    f"""
    WITH {DIM_CUSTOMER_CTE}
    SELECT o_orderkey AS order_nk, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, COALESCE(customer_sk, '-1') AS customer_sk,
           CAST(o_totalprice AS DECIMAL(14,2)) AS gross_revenue,
           CAST(CAST(o_totalprice AS DECIMAL(14,2)) - CAST(ROUND(CAST(o_totalprice AS DECIMAL(14,2)) * 0.05, 2) AS DECIMAL(14,2)) AS DECIMAL(14,2)) AS net_revenue
    FROM orders LEFT JOIN dim_customer d ON d.customer_nk = o_custkey AND d.is_current
    """,
)
def _(t):
    """Order grain, loaded in two runs behind a watermark; the second run re-reads three days."""
    amount = F.col("total_amount")
    orders = t.shop_orders.withColumns(
        {"subtotal": amount, "discount_amount": F.round(amount * F.lit("0.05").cast("decimal(3,2)"), 2).cast("decimal(14,2)")}
    )
    fact = warehouse.fact_orders(orders, dim_customer(t)).withColumn(
        "net_revenue", F.col("net_revenue").cast("decimal(14,2)")
    )
    fact = fact.withColumn("year", F.floor(F.col("date_key") / 10_000).cast("int"))
    root = new_folder(t.spark, "fact-orders")
    path, marks = f"{root}/table", WatermarkStore(t.spark, f"{root}/marks")
    for stop in ["1998-06-15 00:00:00", "2002-01-01 00:00:00"]:
        seen = fact.filter(F.col("updated_at") < dates.instant(stop))
        warehouse.incremental_load("orders", seen, "updated_at", ["order_nk"], path, "year", marks)
    return t.spark.read.parquet(path).drop("updated_at", "year")


@query(
    "w14_fact_payments",
    f"""
    WITH {DIM_CUSTOMER_CTE}
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, COALESCE(customer_sk, '-1') AS customer_sk,
           {key_sql("CASE WHEN o_orderpriority = '1-URGENT' THEN 'card' ELSE 'cod' END")} AS payment_method_sk,
           o_orderkey AS payment_nk, o_orderkey AS order_nk, CAST(o_totalprice AS DECIMAL(14,2)) AS payment_amount,
           o_orderstatus = 'F' AS is_successful, CASE WHEN o_orderstatus <> 'P' THEN (o_custkey % 600) * 1000 END AS processing_time_ms
    FROM orders LEFT JOIN dim_customer d ON d.customer_nk = o_custkey AND d.is_current
    """,
)
def _(t):
    """One payment per order; those of pending orders are not processed yet."""
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"))
    return warehouse.fact_payments(shop_payments(t), orders, dim_customer(t))


@query(
    "w15_incremental_window",
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders WHERE o_orderstatus = 'F') - INTERVAL 3 DAY
    """,
)
def _(t):
    """Rows at or after the high-water mark of what was loaded, less three days."""
    marks = WatermarkStore(t.spark, new_folder(t.spark, "marks"))
    newest = t.orders.filter("o_orderstatus = 'F'").agg(F.max("o_orderdate").alias("m")).first().m
    marks.put("orders", newest - dt.timedelta(days=400))
    marks.put("orders", newest)
    return warehouse.incremental(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", marks.get("orders"))


@query(
    "w16_schema_evolution",
    """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(18,4)) AS amount,
           'VND' AS currency FROM orders
    """,
)
def _(t):
    """A column renamed, two retyped, one added with a default, one dropped."""
    rows = t.orders.select("o_orderkey", "o_custkey", money("o_totalprice").alias("amount"), "o_orderpriority")
    return merge.evolve(
        rows,
        rename={"o_orderkey": "order_id", "o_custkey": "customer"},
        cast={"customer": "string", "amount": "decimal(18,4)"},
        add={"currency": ("string", F.lit("VND"))},
        drop=["o_orderpriority"],
    )


@query(
    "w16_online_migration",
    f"""
    WITH t AS ({TARGET_SQL}), s AS ({SOURCE_SQL})
    SELECT o_orderkey, COALESCE(s.o_orderstatus, t.o_orderstatus) AS status, COALESCE(s.amount, t.amount) AS amount,
           year(COALESCE(s.o_orderdate, t.o_orderdate)) AS placed_in FROM t FULL JOIN s USING (o_orderkey)
    """,
)
def _(t):
    """A table moved to another layout while changes arrive; switched because it equals the changed source."""
    target, source = merge_sides(t)
    table = SnapshotTable(t.spark, new_folder(t.spark, "migration"))
    table.replace(target)
    log = source.select("*", F.lit("u").alias("op"), F.lit(1).cast("long").alias("ts_ms"), F.col("o_orderkey").alias("pos"))
    fresh = changes.live_rows(changes.apply_changes(table.read(), log, ["o_orderkey"]))

    def layout(df):
        renamed = df.withColumnsRenamed({"o_orderstatus": "status"})
        return renamed.withColumn("placed_in", F.year("o_orderdate").cast("long")).drop("o_orderdate")

    migration.migrate(table, layout, log, ["o_orderkey"], fresh)
    return table.read()


def daily_sales_sql(rows: str = "") -> str:
    return f"""
    WITH {LINES_CTE}
    SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, product_nk, COUNT(*) AS orders_count, CAST(SUM(quantity) AS BIGINT) AS units_sold,
           CAST(SUM(gross_revenue) AS DECIMAL(16,2)) AS gross_revenue, CAST(SUM(net_revenue) AS DECIMAL(16,2)) AS net_revenue,
           CAST(FLOOR((2 * CAST(SUM(gross_revenue) * 100 AS BIGINT) + COUNT(*)) // (2 * COUNT(*))) / 100 AS DECIMAL(12,2)) AS avg_order_value
    FROM lines {rows} GROUP BY 1, 2
    """


@query("w17_daily_sales", daily_sales_sql())
def _(t):
    return warehouse.daily_sales(lines_of(t))


@query("w17_refreshed_day", daily_sales_sql("WHERE quantity <= 25 OR order_date = (SELECT MAX(order_date) FROM lines)"))
def _(t):
    """A table by day made when only the small lines were there, then the last day alone computed anew and replaced."""
    path = new_folder(t.spark, "daily")
    lines = lines_of(t)
    files.write_by(warehouse.daily_sales(lines.filter("quantity <= 25")), path, "date_key")
    last = lines.agg(F.max("order_date")).first()[0]
    warehouse.refresh_daily_sales(lines, str(last), path)
    return t.spark.read.parquet(path)


@query(
    "w18_full_refresh",
    """
    SELECT o_custkey AS customer_nk, COUNT(*) AS total_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS total_spent
    FROM orders GROUP BY 1
    """,
)
def _(t):
    """A materialised view replaced as a whole: first with delivered orders only, then with all."""
    view = SnapshotTable(t.spark, new_folder(t.spark, "view"))

    def summary(orders):
        return orders.groupBy("customer_nk").agg(
            F.count(F.lit(1)).alias("total_orders"), total_cents("amount_cents").alias("total_spent")
        )

    view.replace(summary(t.delivered_orders))
    view.replace(summary(t.shop_orders))
    return view.read()


RFM_SQL = f"""
    WITH {LINES_CTE},
    m AS (SELECT customer_nk, COUNT(DISTINCT order_nk) AS frequency, CAST(SUM(gross_revenue) AS DECIMAL(20,2)) AS monetary,
                 MAX(order_date) AS last_order_date, CAST(date_diff('day', MAX(order_date), DATE '{AS_OF[:10]}') AS INTEGER) AS recency_days
          FROM lines GROUP BY 1),
    s AS (SELECT *, NTILE(5) OVER (ORDER BY recency_days DESC, customer_nk) AS r, NTILE(5) OVER (ORDER BY frequency, customer_nk) AS f,
                 NTILE(5) OVER (ORDER BY monetary, customer_nk) AS m FROM m)
    SELECT customer_nk, full_name, frequency, monetary, recency_days, CAST(r AS INTEGER) AS r_score, CAST(f AS INTEGER) AS f_score,
           CAST(m AS INTEGER) AS m_score, r || '' || f || '' || m AS rfm_cell, CAST(r + f + m AS INTEGER) AS rfm_total,
           segment, name AS segment_vi
    FROM (SELECT *, CASE WHEN least(r, f, m) >= 4 THEN 'Champions' WHEN least(r, f) >= 3 THEN 'Loyal Customers' WHEN r >= 4 THEN 'Recent Customers'
                         WHEN f >= 3 THEN 'At Risk' WHEN r = 1 THEN 'Lost' ELSE 'Potential' END AS segment FROM s)
    JOIN (VALUES ('Champions', 'Nhà Vô Địch'), ('Loyal Customers', 'Khách Hàng Trung Thành'), ('Recent Customers', 'Khách Hàng Mới'),
                 ('At Risk', 'Có Nguy Cơ'), ('Lost', 'Đã Mất'), ('Potential', 'Tiềm Năng')) names(segment, name) USING (segment)
    JOIN (SELECT c_custkey AS customer_nk, c_name AS full_name FROM customer) c USING (customer_nk)
"""


@query("w19_rfm_segments", RFM_SQL)
def _(t):
    measures = marts.rfm_measures(sales_of(t), "customer_nk", dates.instant(AS_OF))
    scored = marts.rfm_segments(measures, "customer_nk")
    names = t.customer.select(F.col("c_custkey").alias("customer_nk"), F.col("c_name").alias("full_name"))
    return scored.join(names, "customer_nk").select(
        "customer_nk", "full_name", "frequency", "monetary", "recency_days", "r_score", "f_score", "m_score",
        "rfm_cell", "rfm_total", "segment", "segment_vi",
    )


@query(
    "w20_value_segments",
    """
    WITH done AS (SELECT o_custkey, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(20,2)) AS revenue
                  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o_custkey AS customer_nk, orders, revenue, CASE WHEN revenue > 1500000 THEN 'vip' WHEN revenue > 700000 THEN 'regular' ELSE 'new' END AS segment,
           c_name AS full_name FROM done JOIN customer ON c_custkey = o_custkey
    """,
)
def _(t):
    return marts.value_segments(t.delivered_orders, t.located_customers, 1_500_000, 700_000)


@query(
    "w21_incremental_materialisation",
    f"""
    WITH t AS ({TARGET_SQL}), s AS ({SOURCE_SQL})
    SELECT o_orderkey, COALESCE(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, COALESCE(s.amount, t.amount) AS amount,
           COALESCE(s.o_orderdate, t.o_orderdate) AS o_orderdate, CASE WHEN s.o_orderkey IS NOT NULL THEN 'later' END AS origin
    FROM t FULL JOIN s USING (o_orderkey)
    """,
)
def _(t):
    """Two runs of an incremental model; the second brings a column the table did not have."""
    from orderloom.plans.materialise import materialise

    target, source = merge_sides(t)
    root = new_folder(t.spark, "model")
    materialise(target, "orders_model", "incremental", root, ["o_orderkey"])
    return materialise(source.withColumn("origin", F.lit("later")), "orders_model", "incremental", root, ["o_orderkey"])


@query(
    "w21_increments",
    """
    WITH runs AS (SELECT *, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day FROM events),
    last AS (SELECT user_id, event_type, event_id, CAST(value AS DECIMAL(14,2)) AS value, day,
                    ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY day % 6 DESC, ts DESC, event_id DESC) AS rn FROM runs)
    SELECT user_id, event_type, event_id, value, CASE WHEN day % 6 >= 3 THEN event_id END AS noted FROM last WHERE rn = 1
    """,
)
def _(t):
    """Every sixth day of events in a run of its own, the last event per user and type each; from the fourth run on
    there is one column more. The last run is repeated under its tag and counts once."""
    rows = t.events.withColumn("_day", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000))
    table = IncrementTable(t.spark, new_folder(t.spark, "increments"), ["user_id", "event_type"])
    for run in [0, 1, 2, 3, 4, 5, 5]:
        brought = rows.filter(F.pmod("_day", F.lit(6)) == run)
        brought = merge.latest_per_key(brought, ["user_id", "event_type"], ["ts", "event_id"])
        columns = ["user_id", "event_type", "event_id", money("value").alias("value")]
        noted = [F.col("event_id").alias("noted")] if run >= 3 else []
        table.append(brought.select(*columns, *noted), tag=f"run {run}")
    return table.read()


@query(
    "w22_accumulating_fulfilment",
    """
    SELECT l_orderkey AS order_nk, CAST(strftime(MIN(l_shipdate), '%Y%m%d') AS INTEGER) AS first_ship_key,
           CAST(strftime(MAX(l_shipdate), '%Y%m%d') AS INTEGER) AS last_ship_key,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(MIN(l_shipdate) AS DATE)) AS INTEGER) AS days_to_ship,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(MAX(l_shipdate) AS DATE)) AS INTEGER) AS days_to_complete
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, o_orderdate
    """,
)
def _(t):
    shipped = t.shop_items.select("order_nk", "shipped_at").join(t.shop_orders.select("order_nk", "created_at"), "order_nk")
    return warehouse.order_fulfilment(shipped).drop("created_at")


@query(
    "w22_daily_snapshot",
    """
    SELECT user_id, event_type, day, level FROM (
      SELECT user_id, event_type, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(14,2)) AS level,
             ROW_NUMBER() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def _(t):
    """Last level per subject and day."""
    moves = t.events.select("user_id", "event_type", "ts", "event_id", money("value").alias("level"))
    return warehouse.inventory_daily(moves, ["user_id", "event_type"], "ts", "level", "event_id")


@query(
    "w23_junk_dimension",
    f"SELECT DISTINCT l_returnflag, l_linestatus, {key_sql('l_returnflag', 'l_linestatus')} AS junk_sk FROM lineitem",
)
def _(t):
    return warehouse.junk_dimension(t.lineitem, ["l_returnflag", "l_linestatus"])


def wide_sales(t):
    """Sales lines with the names of customer and product as columns."""
    who = t.located_customers.select("customer_nk", "full_name", "city", "country")
    what = t.shop_products.select("product_nk", "product_name", "category_name", "brand")
    return lines_of(t).join(who, "customer_nk").join(what, "product_nk")


@query(
    "w24_wide_fact",
    f"""
    WITH {LINES_CTE}, {PLACES_CTE}
    SELECT order_item_nk, order_nk, full_name, city, country, p_name AS product_name, p_brand AS brand, gross_revenue
    FROM lines JOIN located USING (customer_nk) JOIN part ON p_partkey = product_nk
    """,
)
def _(t):
    return wide_sales(t).select(
        "order_item_nk", "order_nk", "full_name", "city", "country", "product_name", "brand", "gross_revenue"
    )


@query(
    "w25_retention_split",
    f"""
    SELECT CASE WHEN o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 2 YEAR THEN 'archive' ELSE 'keep' END AS side, COUNT(*) AS row_count,
           {checksum_sql("o_orderkey", "o_orderstatus")} FROM orders GROUP BY 1
    """,
)
def _(t):
    """Orders older than two years go to the archive; counts and checksums of what was written."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    old = F.col("o_orderdate") < dates.instant(AS_OF) - F.expr("INTERVAL 2 YEARS")
    root = new_folder(t.spark, "retention")
    sides = []
    for side, part in zip(["keep", "archive"], merge.split_where(rows, old)):
        written = files.create_table_as(part, f"{root}/{side}")
        mark = quality.fingerprint(written, side, [F.col("o_orderkey"), F.col("o_orderstatus")])
        sides.append(mark.select(F.col("table_name").alias("side"), "row_count", "checksum", "checksum_2"))
    return sides[0].unionByName(sides[1])


@query(
    "w26_missing_days",
    """
    WITH RECURSIVE d AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS day FROM orders UNION ALL
      SELECT CAST(day + INTERVAL 1 DAY AS DATE) FROM d WHERE day < (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders))
    SELECT day AS full_date FROM d WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')
    """,
)
def _(t):
    """Days of the calendar on which no delivered order was loaded."""
    loaded = t.delivered_orders.select(F.col("created_at").cast("date").alias("full_date"))
    return warehouse.missing_days(warehouse.days_covering(t.orders, "o_orderdate"), loaded)


@query(
    "w26_load_freshness",
    f"""
    SELECT MAX(o_orderdate) AS last_load, date_sub('hour', MAX(o_orderdate), TIMESTAMP '{AS_OF}') AS hours_since,
           date_sub('hour', MAX(o_orderdate), TIMESTAMP '{AS_OF}') > 25 AS is_stale FROM orders
    """,
)
def _(t):
    return warehouse.load_freshness(t.orders, "o_orderdate", dates.instant(AS_OF))


@query(
    "w27_soft_delete_restore",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal < -100 THEN TIMESTAMP '2000-01-01'
                           WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal < 0 THEN TIMESTAMP '2001-01-01' END AS deleted_at FROM customer
    """,
)
def _(t):
    """Two deletes, the second covering the first, then one segment restored."""
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", F.lit(None).cast("timestamp_ntz").alias("deleted_at"))
    first = merge.soft_delete(rows, F.col("c_acctbal") < -100, dates.instant("2000-01-01 00:00:00"))
    again = merge.soft_delete(first, F.col("c_acctbal") < 0, dates.instant("2001-01-01 00:00:00"))
    return merge.restore(again, F.col("c_mktsegment") == "MACHINERY").select("c_custkey", "deleted_at")


ADMISSION_CTE = """
req AS (
  SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, CAST(l_quantity AS BIGINT) AS wanted,
         ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn FROM lineitem),
walk AS (
  SELECT r.*, COALESCE(wanted <= p_size * 10, FALSE) AS accepted, CAST(p_size * 10 - CASE WHEN wanted <= p_size * 10 THEN wanted ELSE 0 END AS BIGINT) AS rest
  FROM req r LEFT JOIN part ON p_partkey = l_partkey WHERE rn = 1
  UNION ALL
  SELECT r.*, COALESCE(r.wanted <= w.rest, FALSE), w.rest - CASE WHEN r.wanted <= w.rest THEN r.wanted ELSE 0 END
  FROM walk w JOIN req r ON r.l_partkey = w.l_partkey AND r.rn = w.rn + 1)"""


def admitted(t):
    """Every line takes its quantity from the stock of its part, in order of shipping."""
    stock = t.part.select("p_partkey", (F.col("p_size") * 10).cast("long").alias("available"))
    asked = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), "l_shipdate", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("wanted")
    )
    return merge.guarded_decrement(stock, asked, ["p_partkey"], "available", "wanted", ["l_shipdate", "l_orderkey", "l_linenumber"])


@query(
    "w28_ordered_admission",
    f"WITH RECURSIVE {ADMISSION_CTE} SELECT l_partkey AS p_partkey, l_orderkey, l_linenumber, accepted FROM walk",
)
def _(t):
    """Each line is accepted if what the earlier ones have left suffices."""
    return admitted(t)[0].select("p_partkey", "l_orderkey", "l_linenumber", "accepted")


@query(
    "w28_guarded_decrement",
    f"""
    WITH RECURSIVE {ADMISSION_CTE}
    SELECT p_partkey, CAST(p_size * 10 - COALESCE(SUM(wanted) FILTER (accepted), 0) AS BIGINT) AS available
    FROM part LEFT JOIN walk ON l_partkey = p_partkey GROUP BY p_partkey, p_size
    """,
)
def _(t):
    """The stock that is left."""
    return admitted(t)[1]


@query(
    "w28_conditional_update",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 200000 THEN 'confirmed' ELSE o_orderstatus END AS o_orderstatus FROM orders
    """,
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    large = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000)
    return merge.update_where(rows, large, {"o_orderstatus": F.lit("confirmed")}).drop("o_totalprice")


def confirmed(t):
    """Three events each ask to confirm one order; some numbers do not exist."""
    requests = t.events.select("event_id", (F.floor(F.col("event_id") / 3) * 2).alias("order_nk"))
    state = t.orders.select(F.col("o_orderkey").alias("order_nk"), F.col("o_orderstatus").alias("status"))
    return merge.transition(requests, state, "order_nk", "status", "P", "confirmed", ["event_id"])


@query(
    "w29_status_transition",
    """
    SELECT event_id, order_nk, CASE WHEN o_orderstatus IS NULL THEN 'NOT_FOUND' WHEN o_orderstatus <> 'P' THEN 'INVALID_STATUS:' || o_orderstatus
           WHEN ROW_NUMBER() OVER (PARTITION BY order_nk ORDER BY event_id) = 1 THEN 'OK' ELSE 'INVALID_STATUS:confirmed' END AS verdict
    FROM (SELECT event_id, event_id // 3 * 2 AS order_nk FROM events) LEFT JOIN orders ON o_orderkey = order_nk
    """,
)
def _(t):
    """The first request for a pending order moves it, the next ones find it confirmed."""
    return confirmed(t)[0]


@query(
    "w29_status_after",
    """
    SELECT o_orderkey AS order_nk, CASE WHEN o_orderstatus = 'P' AND o_orderkey IN (SELECT event_id // 3 * 2 FROM events) THEN 'confirmed' ELSE o_orderstatus END AS status
    FROM orders
    """,
)
def _(t):
    return confirmed(t)[1]


@query(
    "w30_inventory_reservation",
    """
    SELECT p_partkey, warehouse_code, CAST(p_size + COALESCE(q, 0) AS BIGINT) AS quantity_reserved
    FROM part CROSS JOIN (VALUES ('WH-HN-01'), ('WH-SGN-01')) w(warehouse_code)
    LEFT JOIN (SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS q FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) ON l_partkey = p_partkey
    """,
)
def _(t):
    """Quantities of open lines added to the reservation of the product in each of its warehouses."""
    places = F.explode(F.array(F.lit("WH-HN-01"), F.lit("WH-SGN-01"))).alias("warehouse_code")
    inventory = t.part.select("p_partkey", places, F.col("p_size").cast("long").alias("quantity_reserved"))
    added = t.lineitem.filter("l_linestatus = 'O'").groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("q"))
    per_place = inventory.join(added, F.col("p_partkey") == F.col("l_partkey")).select(
        "p_partkey", "warehouse_code", F.col("q").alias("quantity_reserved")
    )
    return merge.additive_upsert(inventory, per_place, ["p_partkey", "warehouse_code"], ["quantity_reserved"])


@query(
    "w31_dim_geography",
    f"""
    SELECT DISTINCT n_name AS city, r_name AS country, r_name AS region, {key_sql("n_name", "r_name", "r_name")} AS geography_sk
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    """,
)
def _(t):
    places = t.located_customers.select("city", "country", F.col("country").alias("region"))
    return warehouse.dim_geography(places)


@query(
    "w31_dim_payment_method",
    f"""
    SELECT {key_sql("code")} AS payment_method_sk, code AS method_code, method_name, method_name_vi, gateway, is_online FROM (VALUES
      ('card', 'Card', 'Thẻ', TRUE), ('bank_transfer', 'Bank transfer', 'Chuyển khoản', TRUE), ('cod', 'Cash on delivery', 'Thanh toán khi nhận hàng', FALSE),
      ('wallet', 'E-wallet', 'Ví điện tử', TRUE), ('qr', 'QR code', 'Mã QR', TRUE)) m(code, method_name, method_name_vi, is_online)
    LEFT JOIN (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'card' ELSE 'cod' END AS used,
                      MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN 'stripe' END) AS gateway FROM orders GROUP BY 1) ON used = code
    """,
)
def _(t):
    return warehouse.dim_payment_method(shop_payments(t))
