"""Dimensions, staging models and facts of the star schema."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import dates, rules
from orderloom.functions.amounts import total_cents
from orderloom.functions.keys import surrogate_key
from orderloom.functions.text import clean_email
from orderloom.operators.ranking import with_position
from orderloom.operators.skew import join_one_per_key
from orderloom.session import cut
from orderloom.sources.snapshots import WatermarkStore
from orderloom.sources.tables import merge_partitions, write_by

UNKNOWN = "-1"
UNKNOWN_DATE = -1
# Payment methods with names, and whether they are paid online.
PAYMENT_METHODS = [
    ("card", "Card", "Thẻ", True),
    ("bank_transfer", "Bank transfer", "Chuyển khoản", True),
    ("cod", "Cash on delivery", "Thanh toán khi nhận hàng", False),
    ("wallet", "E-wallet", "Ví điện tử", True),
    ("qr", "QR code", "Mã QR", True),
]
# Order states that count as completed.
COMPLETED = ["delivered", "completed"]


def date_series(spark: SparkSession, start: str | Column, stop: str | Column) -> DataFrame:
    """One row per day, both ends included. A calendar's length bounds its size."""
    first, last = [F.lit(d).cast("date") if isinstance(d, str) else d for d in (start, stop)]
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("full_date"))


def days_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last day of ``column``."""
    day = F.col(column).cast("date")
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def dim_date(days: DataFrame, holidays: DataFrame | None = None, fiscal_start: int = 4) -> DataFrame:
    """Date dimension over a frame of ``full_date``; ``holidays`` lists full_date values."""
    day = F.col("full_date")
    month, weekday = F.month(day), F.dayofweek(day)
    month_name = F.date_format(day, "MMMM")
    marked = days.withColumn("is_holiday_vn", F.lit(False))
    if holidays is not None:
        listed = holidays.select("full_date").distinct().withColumn("is_holiday_vn", F.lit(True))
        marked = days.join(listed, "full_date", "left").withColumn(
            "is_holiday_vn", F.coalesce("is_holiday_vn", F.lit(False))
        )
    return marked.select(
        dates.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.when(month <= 6, 1).otherwise(2).alias("year_half"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_name"),
        month.alias("month"),
        month_name.alias("month_name"),
        dates.pick(month, dates.MONTH_NAMES_VI).alias("month_name_vi"),
        F.left(month_name, F.lit(3)).alias("month_short"),
        F.weekofyear(day).alias("week_of_year"),
        dates.iso_weekday(day).alias("day_of_week"),
        weekday.alias("dow_sunday1"),
        F.date_format(day, "EEEE").alias("day_name"),
        dates.pick(weekday, dates.DAY_NAMES_VI).alias("day_name_vi"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        weekday.isin(1, 7).alias("is_weekend"),
        "is_holiday_vn",
        dates.fiscal_year(day, fiscal_start).alias("fiscal_year"),
        dates.fiscal_quarter(day, fiscal_start).alias("fiscal_quarter"),
    )


def dim_payment_method(payments: DataFrame) -> DataFrame:
    """Known methods plus any code found in the payments, with the gateways seen per method."""
    spark = payments.sparkSession
    names = spark.createDataFrame(
        PAYMENT_METHODS, "method_code string, method_name string, method_name_vi string, is_online boolean"
    )
    used = payments.groupBy(F.col("method").alias("method_code")).agg(F.max("gateway").alias("gateway"))
    return names.join(used, "method_code", "full").select(
        surrogate_key(F.col("method_code")).alias("payment_method_sk"),
        "method_code",
        F.coalesce("method_name", "method_code").alias("method_name"),
        F.coalesce("method_name_vi", "method_code").alias("method_name_vi"),
        "gateway",
        F.coalesce("is_online", F.lit(True)).alias("is_online"),
    )


def dim_geography(places: DataFrame) -> DataFrame:
    """Distinct (city, country, region) with a key."""
    return places.select("city", "country", "region").distinct().withColumn(
        "geography_sk", surrogate_key(F.col("city"), F.col("country"), F.col("region"))
    )


def junk_dimension(df: DataFrame, flags: list[str], name: str = "junk_sk") -> DataFrame:
    """Distinct combinations of low-cardinality columns with a key."""
    return df.select(*flags).distinct().withColumn(name, surrogate_key(*[F.col(f) for f in flags]))


def with_dense_key(new: DataFrame, order: list[str], name: str, above: int = 0) -> DataFrame:
    """Integer surrogate keys without gaps, starting after ``above``."""
    numbered = with_position(new, [F.col(c) for c in order], name)
    return numbered.withColumn(name, F.col(name) + above)


def stg_orders(orders: DataFrame, include_cancelled: bool = False) -> DataFrame:
    """Standardised orders: renamed keys, date parts and flags. Cancelled ones are left out by default."""
    day = F.col("created_at").cast("date")
    staged = orders.withColumns(
        {
            "order_date": day,
            "order_year": F.year(day),
            "order_month": F.month(day),
            "order_day_of_week": F.dayofweek(day),
            "is_completed": F.col("order_status").isin(COMPLETED),
            "is_cancelled": F.col("order_status") == "cancelled",
        }
    )
    return staged if include_cancelled else staged.filter("order_status <> 'cancelled'")


def stg_customers(customers: DataFrame, addresses: DataFrame, as_of: Column) -> DataFrame:
    """Live customers with their default address, cleaned names and flags.

    Of several default addresses the newest counts, by ``updated_at`` and ``id`` where there are such columns; then the greatest.
    """
    live = customers.filter("deleted_at IS NULL")
    newest = [c for c in ("updated_at", "id") if c in addresses.columns]
    home = F.max(F.struct(*newest, "city", "country")).alias("_home")
    homes = addresses.filter("is_default").groupBy(F.col("customer_id").alias("_owner")).agg(home)
    homes = homes.select("_owner", "_home.city", F.col("_home.country").alias("_country"))
    joined = live.join(homes, F.col("id") == F.col("_owner"), "left")
    optional = []
    if "date_of_birth" in customers.columns:
        optional = [(F.floor(F.datediff(as_of, "date_of_birth") / 365)).alias("age_years")]
    return joined.select(
        F.col("id").alias("customer_nk"),
        F.col("uuid").alias("customer_uuid"),
        clean_email(F.col("email")).alias("email"),
        F.trim("full_name").alias("full_name"),
        "phone",
        "status",
        "city",
        F.coalesce("_country", F.lit("VN")).alias("country_code"),
        "created_at",
        "updated_at",
        (F.col("status") == "active").cast("int").alias("is_active"),
        (F.datediff(as_of, "created_at") <= 30).cast("int").alias("is_new_customer"),
        *optional,
    )


def margin_pct(price: Column, cost: Column) -> Column:
    return F.when(cost > 0, F.round(F.try_divide((price - cost) * 100, price), 2))


def stg_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products on sale with category, top category, margin and stock band."""
    own, above = categories.alias("c"), categories.alias("p")
    joined = (
        products.filter(F.col("status").isin("active", "inactive"))
        .join(own, F.col("category_id") == F.col("c.id"), "left")
        .join(above, F.col("c.parent_id") == F.col("p.id"), "left")
    )
    optional = []
    if "cost_price" in products.columns:
        optional.append(margin_pct(F.col("price"), F.col("cost_price")).cast("decimal(7,2)").alias("margin_pct"))
    if "stock_quantity" in products.columns:
        optional.append(rules.stock_band(F.col("stock_quantity")).alias("stock_status"))
    return joined.select(
        products["id"].alias("product_nk"),
        "sku",
        products["name"].alias("product_name"),
        F.coalesce("c.name", F.lit("Uncategorized")).alias("category_name"),
        F.col("c.slug").alias("category_slug"),
        F.coalesce("p.name", "c.name").alias("top_category"),
        F.col("price").alias("unit_price"),
        products["status"].alias("status"),
        *optional,
    )


def sales_lines(delivered_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines of delivered orders with gross, discount and net revenue: fact grain, natural keys.

    A line's discount is an amount and is subtracted once.
    """
    orders = delivered_orders.select("order_nk", "customer_nk", "order_source", "created_at")
    return items.join(orders, "order_nk").select(
        "order_item_nk",
        "order_nk",
        "customer_nk",
        "product_nk",
        F.col("created_at").cast("date").alias("order_date"),
        "order_source",
        "quantity",
        "unit_price",
        "discount_amount",
        "gross_revenue",
        (F.col("gross_revenue") - F.col("discount_amount")).cast("decimal(14,2)").alias("net_revenue"),
        "gross_cents",
        (F.col("gross_cents") - F.col("discount_cents")).alias("net_cents"),
    )


def sales_by_order(delivered_orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered orders with the sums of their lines.

    Lines are added up before the join: a quarter of the rows to shuffle, and one
    row for an order however many lines it has. Every report that does not ask
    for products starts here.
    """
    per_order = items.groupBy("order_nk").agg(
        F.sum("gross_cents").alias("gross_cents"),
        F.sum("discount_cents").alias("discount_cents"),
        F.sum(F.col("gross_cents") - F.col("discount_cents")).alias("net_cents"),
        F.sum("quantity").alias("quantity"),
        F.count(F.lit(1)).alias("line_count"),
    )
    orders = delivered_orders.select(
        "order_nk", "customer_nk", F.col("created_at").cast("date").alias("order_date"), "order_source"
    )
    return orders.join(per_order, "order_nk")


def fact_sales(
    lines: DataFrame, days: DataFrame, customers: DataFrame, products: DataFrame, payments: DataFrame | None = None
) -> DataFrame:
    """Line grain fact with surrogate keys of the current dimension rows; -1 where there is none."""
    who = customers.filter("is_current").select("customer_nk", "customer_sk")
    what = products.filter("is_current").select("product_nk", "product_sk")
    when = days.select("date_key", F.col("full_date").alias("order_date"))
    joined = lines.join(when, "order_date", "left").join(who, "customer_nk", "left").join(what, "product_nk", "left")
    optional = []
    if payments is not None:
        latest = payments.groupBy(F.col("order_id").alias("order_nk")).agg(
            F.max_by("method", F.struct("created_at", "id")).alias("payment_method")
        )
        joined = join_one_per_key(joined, latest, ["order_nk"], "left")
        optional = ["payment_method"]
    return joined.select(
        "order_item_nk",
        F.coalesce("date_key", F.lit(UNKNOWN_DATE)).alias("date_key"),
        F.coalesce("customer_sk", F.lit(UNKNOWN)).alias("customer_sk"),
        F.coalesce("product_sk", F.lit(UNKNOWN)).alias("product_sk"),
        "order_nk",
        "quantity",
        "unit_price",
        "discount_amount",
        "gross_revenue",
        "net_revenue",
        "order_source",
        *optional,
    )


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order grain fact: gross is the subtotal, net the subtotal less the discount."""
    who = customers.filter("is_current").select("customer_nk", "customer_sk")
    return orders.join(who, "customer_nk", "left").select(
        "order_nk",
        dates.date_key(F.col("created_at").cast("date")).alias("date_key"),
        F.coalesce("customer_sk", F.lit(UNKNOWN)).alias("customer_sk"),
        F.col("subtotal").alias("gross_revenue"),
        (F.col("subtotal") - F.col("discount_amount")).alias("net_revenue"),
        "updated_at",
    )


def fact_payments(payments: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Payment grain fact with the success flag and the processing time."""
    who = customers.filter("is_current").select("customer_nk", "customer_sk")
    bought = orders.select(F.col("id").alias("order_id"), F.col("customer_id").alias("customer_nk"))
    joined = payments.join(bought, "order_id").join(who, "customer_nk", "left")
    return joined.select(
        dates.date_key(F.col("created_at").cast("date")).alias("date_key"),
        F.coalesce("customer_sk", F.lit(UNKNOWN)).alias("customer_sk"),
        surrogate_key(F.col("method")).alias("payment_method_sk"),
        F.col("id").alias("payment_nk"),
        F.col("order_id").alias("order_nk"),
        F.col("amount").alias("payment_amount"),
        (F.col("status") == "completed").alias("is_successful"),
        F.timestamp_diff("MILLISECOND", F.col("created_at"), F.col("processed_at")).alias("processing_time_ms"),
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    """Counts, units, revenue and average value per day and product."""
    return lines.groupBy(dates.date_key(F.col("order_date")).alias("date_key"), "product_nk").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("quantity").alias("units_sold"),
        total_cents("gross_cents", 16).alias("gross_revenue"),
        total_cents("net_cents", 16).alias("net_revenue"),
        F.round(total_cents("gross_cents", 16) / F.count(F.lit(1)), 2).cast("decimal(12,2)").alias("avg_order_value"),
    )


def refresh_daily_sales(lines: DataFrame, day: str, path: str) -> None:
    """Recomputes one day and replaces that day's directory only."""
    write_by(daily_sales(lines.filter(F.col("order_date") == F.lit(day).cast("date"))), path, "date_key")


def order_fulfilment(lines: DataFrame) -> DataFrame:
    """Accumulating snapshot per order: ordered, first and last shipment, days between."""
    shipped, all_shipped = F.min("shipped_at").cast("date"), F.max("shipped_at").cast("date")
    return lines.groupBy("order_nk", "created_at").agg(
        dates.date_key(shipped).alias("first_ship_key"),
        dates.date_key(all_shipped).alias("last_ship_key"),
        F.datediff(shipped, F.col("created_at")).alias("days_to_ship"),
        F.datediff(all_shipped, F.col("created_at")).alias("days_to_complete"),
    )


def inventory_daily(movements: DataFrame, subject: list[str], at: str, level: str, tie: str) -> DataFrame:
    """Periodic snapshot: the last known level per subject and day."""
    return movements.groupBy(*subject, F.col(at).cast("date").alias("day")).agg(
        F.max_by(level, F.struct(at, tie)).alias(level)
    )


def missing_days(days: DataFrame, loaded: DataFrame) -> DataFrame:
    """Calendar days without any loaded row; ``loaded`` has a ``full_date`` per row."""
    present = loaded.groupBy("full_date").agg(F.count(F.lit(1)).alias("rows"))
    return days.join(present, "full_date", "left_anti")


def load_freshness(loaded: DataFrame, at: str, as_of: Column, limit_hours: int = 25) -> DataFrame:
    """One row: newest load time, whole hours since, and whether that is too long."""
    newest = loaded.agg(F.max(at).alias("last_load"))
    hours = F.timestamp_diff("HOUR", F.col("last_load"), as_of)
    return newest.select("last_load", hours.alias("hours_since"), (hours > limit_hours).alias("is_stale"))


def incremental(source: DataFrame, column: str, mark: dt.datetime | None, lookback_days: int = 3) -> DataFrame:
    """Rows at or after the high-water mark less the look-back; all of them on the first run.

    Rows seen before come again, so the load must be an upsert.
    """
    if mark is None:
        return source
    since = mark - dt.timedelta(days=lookback_days)
    return source.filter(F.col(column) >= dates.instant(since.isoformat(sep=" ")))


def incremental_load(
    name: str,
    source: DataFrame,
    column: str,
    keys: list[str],
    path: str,
    partition: str,
    marks: WatermarkStore,
    lookback_days: int = 3,
) -> bool:
    """One run of an incremental model: read behind the mark, upsert, then move the mark.

    Only the partitions of the rows read are rewritten. False if there was nothing to load.
    """
    rows = cut(incremental(source, column, marks.get(name), lookback_days), f"load-{name}")
    newest = rows.agg(F.max(column).alias("newest")).first().newest
    if newest is None:
        return False
    merge_partitions(rows, path, keys, partition, latest_by=[column])
    marks.put(name, newest)
    return True


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
