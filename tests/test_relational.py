"""Joins, pages and plans."""

import datetime as dt

from pyspark.sql import functions as F

from orderloom.functions import dates
from orderloom.operators import joins, paging
from orderloom.plans import reports
from orderloom.plans.warehouse import date_series, dim_date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_range_reaches_the_scan(tables):
    assert "GreaterThanOrEqual(o_orderdate" in plan(tables.orders.filter(dates.year_range(F.col("o_orderdate"), 1996)))


def test_row_comparison_reaches_the_scan(tables):
    cursor = [dates.instant("1996-05-05 00:00:00"), F.lit(7)]
    page = paging.keyset_page(tables.orders, ["o_orderdate", "o_orderkey"], cursor, 5)
    assert "LessThanOrEqual(o_orderdate" in plan(page)
    assert "TakeOrderedAndProject" in plan(page)


def test_only_needed_columns_are_read(tables):
    from orderloom.plans.reports import revenue_by_source

    scan = plan(revenue_by_source(tables.shop_orders))
    assert "o_orderpriority" in scan and "o_custkey" not in scan.split("ReadSchema")[1]


def test_pages_in_a_row_are_the_full_order(tables):
    rows = tables.orders.select("o_orderdate", "o_orderkey")
    cursor, seen = None, []
    for _ in range(5):
        page = paging.keyset_page(rows, ["o_orderdate", "o_orderkey"], cursor, 40).collect()
        seen += page
        last = page[-1]
        cursor = [dates.instant(str(last.o_orderdate)), F.lit(last.o_orderkey)]
    expected = rows.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(200).collect()
    assert seen == expected
    by_number = [r for p in range(1, 6) for r in paging.offset_page(rows, [F.desc("o_orderdate"), F.desc("o_orderkey")], 40, p).collect()]
    assert by_number == expected


def test_last_page_has_no_more(spark):
    rows = spark.range(7).select(F.col("id").alias("a"))
    first = paging.page_envelope(rows, ["a"], None, 5).first()
    assert (first.returned, first.has_more, first.next_a) == (5, True, 2)
    rest = paging.page_envelope(rows, ["a"], [F.lit(first.next_a)], 5).first()
    assert (rest.returned, rest.has_more, rest.next_a) == (2, False, 0)
    empty = paging.page_envelope(rows, ["a"], [F.lit(0)], 5).first()
    assert (empty.returned, empty.has_more, empty.next_a) == (0, False, None)


def test_not_in_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "b int")
    check = lambda other: sorted(r.a if r.a is not None else -1 for r in joins.not_in(left, "a", other, "b").collect())
    assert check(values(2, 3)) == [1]
    assert check(values(2, None)) == []
    assert check(values(2).limit(0)) == [-1, 1, 2]


def test_range_join_against_all_pairs(spark):
    points = spark.range(200).select(F.col("id").alias("p"))
    spans = spark.createDataFrame([(i, i * 7 % 150, i * 7 % 150 + i % 30) for i in range(60)], "s int, lo int, hi int")
    brute = {(r.p, s.s) for r in points.collect() for s in spans.collect() if s.lo <= r.p <= s.hi}
    for width in [1, 8, 500]:
        found = joins.range_join(points, spans, "p", "lo", "hi", width).select("p", "s").collect()
        assert len(found) == len(brute) and {(r.p, r.s) for r in found} == brute


def test_as_of_join_uses_half_open_validity(spark):
    fact = spark.createDataFrame([(1, dt.date(2024, 1, d)) for d in (1, 9, 10, 11)] + [(2, dt.date(2024, 1, 1))], "nk int, day date")
    dim = spark.createDataFrame(
        [(1, "old", dt.date(2024, 1, 2), dt.date(2024, 1, 10)), (1, "new", dt.date(2024, 1, 10), None)],
        "dk int, v string, effective_from date, effective_to date",
    )
    rows = joins.as_of_dimension(fact, dim, "nk", "dk", F.col("day")).orderBy("nk", "day").collect()
    assert [r.v for r in rows] == [None, "old", "new", "new", None]


def test_pairs_and_partners(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "y")], "id int, city string")
    assert [(r.city, r.pairs) for r in joins.count_pairs(rows, ["city"]).collect()] == [("x", 3)]
    assert sorted(r.id for r in joins.partners_of(rows, ["city"], "id", 2).collect()) == [1, 3]


def test_range_join_of_one_interval_over_everything(spark):
    points = spark.createDataFrame([(p,) for p in range(0, 1_000_000, 997)] + [(None,)], "p long")
    spans = spark.createDataFrame([("all", -5, 10**12), ("one", 997, 997), ("back", 9, 3), ("none", None, 4)], "s string, lo long, hi long")
    joined = joins.range_join(points, spans, "p", "lo", "hi", 64)
    assert {r.s: r["count"] for r in joined.groupBy("s").count().collect()} == {"all": 1004, "one": 1}


def test_reports_keep_dates_outside_the_calendar(spark):
    kind = "order_date date, customer_nk long, gross_cents long, net_cents long, quantity long"
    sales = spark.createDataFrame([(dt.date(2001, 5, 1), 1, 5, 5, 1), (dt.date(2071, 6, 1), 1, 7, 7, 1), (None, 2, 11, 11, 1)], kind)
    calendar = dim_date(date_series(spark, "2001-01-01", "2001-12-31"))
    found = reports.monthly_revenue(sales, calendar).collect()
    assert [(r.year, r.month, r.orders) for r in found] == [(None, None, 1), (2001, 5, 1), (2071, 6, 1)]
    assert found[2].month_name_vi == "Tháng 6"
    assert {r.year: r.units for r in reports.revenue_by_year(sales, calendar).collect()} == {None: 1, 2001: 1, 2071: 1}
