"""Warehouse models on the seed rows, sources, quality, capacity."""

import datetime as dt
from decimal import Decimal

import pytest
import seed
from pyspark.sql import functions as F

from orderloom.operators import quality, scd
from orderloom.plans import capacity, migration, warehouse
from orderloom.session import new_folder, shared_dir
from orderloom.sources import jdbc, slowlog, tables as files
from orderloom.sources.snapshots import SnapshotTable
from orderloom.streaming import changes


def now():
    return F.lit("2024-12-15 00:00:00").cast("timestamp_ntz")


def test_calendar(spark):
    days = warehouse.dim_date(warehouse.date_series(spark, "2024-01-01", "2024-12-31"))
    assert days.count() == 366
    row = days.filter("full_date = '2024-09-01'").first()
    assert (row.date_key, row.day_of_week, row.dow_sunday1, row.is_weekend) == (20240901, 7, 1, True)
    assert (row.month_name_vi, row.day_name_vi, row.month_short) == ("Tháng 9", "Chủ Nhật", "Sep")
    holidays = spark.createDataFrame([(dt.date(2024, 9, 2),)], "full_date date")
    marked = warehouse.dim_date(warehouse.date_series(spark, "2024-09-01", "2024-09-03"), holidays)
    assert [r.is_holiday_vn for r in marked.orderBy("full_date").collect()] == [False, True, False]


def test_staged_customers(spark):
    staged = {r.customer_nk: r for r in warehouse.stg_customers(seed.customers(spark), seed.addresses(spark), now()).collect()}
    assert sorted(staged) == [1, 2, 3, 5]
    assert staged[1].email == "nguyen.van.a@gmail.com" and staged[3].full_name == "Lê Văn C"
    assert (staged[1].city, staged[5].city) == ("Hà Nội", None)
    assert (staged[3].country_code, staged[5].country_code) == ("LA", "VN")
    assert (staged[5].is_active, staged[1].is_new_customer) == (0, 0)


def test_two_default_addresses_make_one_customer(spark):
    homes = seed.addresses(spark).unionByName(spark.createDataFrame([(1, "Huế", "VN", True)], "customer_id long, city string, country string, is_default boolean"))
    staged = [r.city for r in warehouse.stg_customers(seed.customers(spark), homes, now()).collect() if r.customer_nk == 1]
    assert staged == ["Hà Nội"] or staged == ["Huế"]
    dated = homes.withColumn("id", F.when(F.col("city") == "Huế", 9).otherwise(1))
    assert [r.city for r in warehouse.stg_customers(seed.customers(spark), dated, now()).collect() if r.customer_nk == 1] == ["Huế"]


def test_staged_orders(spark):
    orders = seed.orders(spark)
    assert warehouse.stg_orders(orders).count() == 4
    assert warehouse.stg_orders(orders, include_cancelled=True).filter("is_cancelled").count() == 1
    assert warehouse.stg_orders(orders).filter("id = 1").first().order_day_of_week == 6


def test_staged_products(spark):
    products = spark.createDataFrame(
        [(1, "s1", 3, "phone", Decimal("100.00"), Decimal("60.00"), "active", 0), (2, "s2", None, "thing", Decimal("10.00"), Decimal("0.00"), "inactive", 9),
         (3, "s3", 9, "shirt", Decimal("30.00"), Decimal("20.00"), "active", 100), (4, "s4", 1, "old", Decimal("1.00"), Decimal("1.00"), "archived", 5)],
        "id long, sku string, category_id long, name string, price decimal(12,2), cost_price decimal(12,2), status string, stock_quantity int",
    )
    staged = {r.product_nk: r for r in warehouse.stg_products(products, seed.categories(spark)).collect()}
    assert sorted(staged) == [1, 2, 3]
    assert (staged[1].category_name, staged[1].top_category, staged[1].margin_pct, staged[1].stock_status) == ("Android Phones", "Smartphones", Decimal("40.00"), "out_of_stock")
    assert (staged[2].category_name, staged[2].top_category, staged[2].margin_pct, staged[2].stock_status) == ("Uncategorized", None, None, "low_stock")
    assert (staged[3].top_category, staged[3].stock_status) == ("Fashion", "well_stocked")


def current_customers(spark):
    rows = seed.customers(spark).select(F.col("id").alias("customer_nk"), "full_name")
    return scd.scd2_initial(rows, "customer_nk", F.lit("2024-01-01"), "customer_sk")


def test_order_facts_subtract_the_discount_once(spark):
    orders = seed.orders(spark).withColumnsRenamed({"id": "order_nk", "customer_id": "customer_nk"})
    fact = {r.order_nk: r for r in warehouse.fact_orders(orders, current_customers(spark)).collect()}
    assert (fact[1].date_key, fact[1].gross_revenue, fact[1].net_revenue) == (20241115, Decimal("29990000.00"), Decimal("28990000.00"))
    total = seed.orders(spark).filter("id = 1").select(F.expr("subtotal - discount_amount + tax_amount + shipping_amount = total_amount").alias("x"))
    assert total.first().x


def test_payment_facts(spark):
    facts = {r.payment_nk: r for r in warehouse.fact_payments(seed.payments(spark), seed.orders(spark), current_customers(spark)).collect()}
    assert (facts[1].is_successful, facts[1].processing_time_ms) == (True, 300_000)
    assert (facts[5].is_successful, facts[5].processing_time_ms) == (False, None)
    methods = {r.method_code: r for r in warehouse.dim_payment_method(seed.payments(spark)).collect()}
    assert (methods["card"].gateway, methods["cod"].is_online, methods["wallet"].gateway) == ("stripe", False, None)
    assert methods["voucher"].method_name == "voucher"


def test_line_facts_with_unknown_members_and_payment(spark):
    lines = spark.createDataFrame([("i1", 1, 1, 7, dt.date(2024, 11, 15), "web", 1, 1.0, 0.0, 1.0, 1.0), ("i2", 2, 99, 7, dt.date(2024, 11, 20), "app", 1, 1.0, 0.0, 1.0, 1.0)],
        "order_item_nk string, order_nk long, customer_nk long, product_nk long, order_date date, order_source string, quantity long, unit_price double, discount_amount double, gross_revenue double, net_revenue double")
    products = scd.scd2_initial(spark.createDataFrame([(8, "x")], "product_nk long, n string"), "product_nk", F.lit("2024-01-01"), "product_sk")
    days = warehouse.dim_date(warehouse.date_series(spark, "2024-11-01", "2024-11-30"))
    facts = {r.order_item_nk: r for r in warehouse.fact_sales(lines, days, current_customers(spark), products, seed.payments(spark)).collect()}
    assert facts["i1"].customer_sk != "-1" and facts["i2"].customer_sk == "-1" and facts["i1"].product_sk == "-1"
    assert (facts["i1"].payment_method, facts["i2"].payment_method) == ("bank_transfer", "card")


def test_daily_refresh_replaces_one_day(spark, tables):
    from orderloom.catalog.reports import lines_of

    path = new_folder(spark, "daily")
    lines = lines_of(tables)
    files.write_by(warehouse.daily_sales(lines), path, "date_key")
    day = lines.agg(F.max("order_date").alias("d")).first().d
    key = int(day.strftime("%Y%m%d"))
    doubled = lines.unionByName(lines)
    warehouse.refresh_daily_sales(doubled, str(day), path)
    before = {(r.date_key, r.product_nk): r.orders_count for r in warehouse.daily_sales(lines).collect()}
    after = {(r.date_key, r.product_nk): r.orders_count for r in spark.read.parquet(path).collect()}
    assert after == {k: v * 2 if k[0] == key else v for k, v in before.items()}


def test_migration_checks_before_it_switches(spark):
    table = SnapshotTable(spark, new_folder(spark, "migrate"))
    table.replace(spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"))
    log = spark.createDataFrame([(2, "B", "u", 5, 1), (3, "c", "c", 6, 2), (1, "a", "d", 7, 3)], "id long, name string, op string, ts_ms long, pos long")
    fresh = changes.live_rows(changes.apply_changes(table.read(), log, ["id"]))
    widen = lambda df: df.withColumnsRenamed({"name": "full_name"}).withColumn("kind", F.lit("x"))
    assert migration.migrate(table, widen, log, ["id"], fresh) == 2
    assert sorted(tuple(r) for r in table.read().select("id", "full_name", "kind").collect()) == [(2, "B", "x"), (3, "c", "x")]
    with pytest.raises(RuntimeError):
        migration.migrate(table, lambda df: df, log.withColumnsRenamed({"name": "full_name"}).withColumn("kind", F.lit("x")).filter("id = 3"), ["id"], table.read().limit(1))
    assert table.read().columns == ["id", "full_name", "kind"]


def test_jdbc_options():
    assert jdbc.partition_options("id", 1, 100, 4) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc.partition_options("id", 5, 5, 4)
    assert jdbc.options("u", "t", "me", "pw")["dbtable"] == "t"


class Recorder:
    """Stands in for a DataFrame writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def save(self):
        self.told["saved"] = True


def test_jdbc_writes():
    class Frame:
        write = Recorder()

    jdbc.write(Frame, jdbc.options("u", "t", "me", "pw"), "overwrite")
    assert Frame.write.told["truncate"] == "true" and Frame.write.told["mode"] == "overwrite" and Frame.write.told["saved"]
    Frame.write = Recorder()
    jdbc.stream_writer(jdbc.options("u", "t", "me", "pw"))(Frame, 3)
    assert Frame.write.told["mode"] == "append" and "truncate" not in Frame.write.told


def test_seeds_and_csv(spark):
    path = new_folder(spark, "csv")
    rows = files.seed(spark, [(1, "Hà Nội"), (2, "Huế")], "id int, city string")
    rows.write.csv(path, header=True)
    assert sorted(files.read_csv(spark, path, "id int, city string").collect()) == sorted(rows.collect())


def test_catalog_and_statistics(spark):
    import uuid

    name = f"stats_{uuid.uuid4().hex}"
    path = new_folder(spark, name)
    spark.range(12).write.parquet(path)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    assert name in files.list_tables(spark)
    assert files.estimated_rows(spark, name) is None
    files.analyze(spark, name)
    assert files.estimated_rows(spark, name) == 12
    assert files.file_row_count(spark, path) == 12
    spark.sql(f"DROP TABLE {name}")


SLOW_LOG = """# Time: 2025-03-02T01:02:03.250000Z
# User@Host: report[report] @ [192.0.2.7]
# Query_time: 12.750000  Lock_time: 0.004000  Rows_sent: 20  Rows_examined: 48000
SET timestamp=1740877323;
SELECT p.sku, SUM(i.quantity)
FROM order_items i JOIN products p ON p.id = i.product_id
GROUP BY p.sku;
# Time: 2025-03-02T01:02:09.000000Z
# User@Host: report[report] @ [192.0.2.7]
# Query_time: 0.100000  Lock_time: 0.000001  Rows_sent: 0  Rows_examined: 5
SET timestamp=1740877329;
SELECT 1;
"""


def test_slow_log(spark):
    path = new_folder(spark, "log")
    spark.createDataFrame([(SLOW_LOG.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    entries = slowlog.read_entries(spark, path)
    assert entries.count() == 2
    row = slowlog.over_threshold(entries, 1.0, 1000).first()
    assert (row.query_time, row.lock_time, row.rows_sent, row.rows_examined) == (12.75, 0.004, 20, 48000)
    assert row.user_host == "report[report] @ [192.0.2.7]"
    assert row.sql_text == "SELECT p.sku, SUM(i.quantity) FROM order_items i JOIN products p ON p.id = i.product_id GROUP BY p.sku;"
    assert row.time == dt.datetime(2025, 3, 2, 1, 2, 3, 250000)


def test_growth(spark):
    sizes = spark.createDataFrame([("t", m, 100.0 + 12 * m) for m in range(6)] + [("flat", m, 5.0) for m in range(6)], "t string, m int, s double")
    found = {r.t: r for r in capacity.growth(sizes, ["t"], F.col("m"), F.col("s"), F.lit(340.0)).collect()}
    assert abs(found["t"].growth_per_period - 12) < 1e-9 and abs(found["t"].periods_to_limit - 15) < 1e-9
    assert found["flat"].periods_to_limit is None


def test_checks_and_summary(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    report = quality.report(
        [quality.check("C1", "dup", quality.duplicate_keys(rows, ["id"])), quality.check("C2", "neg", rows.filter("id < 0")), quality.check("C3", "big", rows.filter("id > 1"), "WARN")]
    )
    assert [(r.check_id, r.result, r.issue_count) for r in report.orderBy("check_id").collect()] == [("C1", "FAIL", 1), ("C2", "PASS", 0), ("C3", "WARN", 1)]
    total = quality.summary(report).first()
    assert (total.passed, total.failed, total.warned, total.overall) == (1, 1, 1, "SOME CHECKS FAILED")


def test_checks_of_one_table_read_it_once(spark, tmp_path):
    spark.createDataFrame([(1, 5), (1, -1), (2, None), (3, -2), (None, 4)], "k int, v int").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    rules = [quality.Rule("C1", "negative", F.col("v") < 0), quality.Rule("C2", "missing", F.col("v").isNull(), "WARN"), quality.Rule("C3", "large", F.col("v") > 9)]
    found = quality.table_checks(rows, rules, quality.Reference("C4", "orphans", "k", parent, "id"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    expected = [("C1", "negative", "FAIL", 2), ("C2", "missing", "WARN", 1), ("C3", "large", "PASS", 0), ("C4", "orphans", "FAIL", 2)]
    assert sorted(map(tuple, found.collect())) == expected
    assert sorted(map(tuple, quality.table_checks(rows, rules).collect())) == expected[:3]
    nothing = quality.table_checks(rows.filter("k > 9"), rules, quality.Reference("C4", "orphans", "k", parent, "id"))
    assert [(r.result, r.issue_count) for r in nothing.collect()] == [("PASS", 0)] * 4


def test_nulls_count_in_dependencies(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", None), ("b", None), ("c", "y")], "k string, v string")
    assert [r.k for r in quality.violates_dependency(rows, ["k"], "v").collect()] == ["a"]


def test_fingerprint_ignores_order_only(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    mark = lambda df: quality.fingerprint(df, "t", [F.col("id"), F.col("v")])
    assert quality.reconcile(mark(rows), mark(rows.orderBy(F.desc("id")))).first().matches
    assert not quality.reconcile(mark(rows), mark(rows.na.fill("b"))).first().matches


def test_accepted_values_let_null_pass(spark):
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    assert [r.v for r in quality.unaccepted(rows, "v", ["a"]).collect()] == ["z"]


def test_shared_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)
