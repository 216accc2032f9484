"""Scalar functions against goldens."""

import datetime as dt
import re

from pyspark.sql import functions as F

from orderloom.functions import dates, keys, rules, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_discount_rates(spark):
    rates = {50_000_000: 0.15, 49_999_999: 0.10, 20_000_000: 0.10, 5_000_000: 0.05, 4_999_999: 0.0}
    for amount, rate in rates.items():
        assert float(one(spark, rules.discount_rate(F.lit(amount)))) == rate


def test_lag_bands(spark):
    bands = {0: "in sync", 29: "minor", 30: "moderate", 119: "moderate", 120: "critical"}
    for lag, band in bands.items():
        assert one(spark, rules.lag_severity(F.lit(lag))) == band
    assert one(spark, rules.exit_level(F.lit(None).cast("int"))) == 2


def test_weeks_from_zero(spark):
    # 2021-01-01 is a Friday, before the first four-day week; 2024-12-30 belongs to the next year's first.
    days = {dt.date(2021, 1, 1): 0, dt.date(2021, 1, 4): 1, dt.date(2024, 1, 1): 1, dt.date(2024, 12, 30): 53, dt.date(2020, 12, 31): 53}
    for day, week in days.items():
        assert one(spark, dates.week_monday_first(F.lit(day))) == week


def test_fiscal_year_starts_in_april(spark):
    cases = {dt.date(2024, 3, 31): (2023, 4), dt.date(2024, 4, 1): (2024, 1), dt.date(2024, 12, 31): (2024, 3)}
    for day, expected in cases.items():
        assert (one(spark, dates.fiscal_year(F.lit(day))), one(spark, dates.fiscal_quarter(F.lit(day)))) == expected
    assert one(spark, dates.fiscal_quarter(F.lit(dt.date(2024, 3, 1)), 1)) == 1


def test_names_out_of_range_are_null(spark):
    assert one(spark, dates.pick(F.lit(13), dates.MONTH_NAMES_VI)) is None
    assert one(spark, dates.pick(F.lit(1), dates.DAY_NAMES_VI)) == "Chủ Nhật"


def test_key_and_date_are_inverse(spark):
    assert one(spark, dates.key_to_date(dates.date_key(F.lit(dt.date(2024, 2, 29))))) == dt.date(2024, 2, 29)


def test_uuid_v7(spark):
    times = spark.range(1000).select(F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id")).alias("t"), "id")
    salted = [r.u for r in times.select(keys.uuid_v7(F.col("t"), F.col("id")).alias("u")).collect()]
    random = [r.u for r in times.select(keys.uuid_v7(F.col("t")).alias("u")).collect()]
    shape = re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    for ids in (salted, random):
        assert all(shape.match(u) for u in ids) and len(set(ids)) == 1000
        assert ids == sorted(ids)
    assert int(salted[5].replace("-", "")[:12], 16) == 1_700_000_000_005


def test_surrogate_keys_tell_nulls_apart(spark):
    a, null = F.lit("a"), F.lit(None).cast("string")
    assert one(spark, keys.surrogate_key(a, null)) != one(spark, keys.surrogate_key(null, a))


def test_collation_ignores_case_and_accents(spark):
    assert one(spark, text.loose(F.lit("Hà Nội")) == text.loose(F.lit("ha noi")))


def test_statement_digest(spark):
    shapes = {
        "SELECT * FROM orders WHERE id = 17 AND name = 'O''Brien';": "select * from orders where id = ? and name = ?",
        "select  x\n from t1 where a in (1, 2,3)  and b=-1.5e3": "select x from t1 where a in (?) and b=?",
        "UPDATE t SET a = \"x\\\"y\" WHERE b2 = 0x1F": "update t set a = ? where b2 = ?",
    }
    for sql, digest in shapes.items():
        assert one(spark, text.statement_digest(F.lit(sql))) == digest


def test_json_object_keeps_null(spark):
    assert one(spark, text.json_object(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))) == '{"a":1,"b":null}'


def test_states_sort_by_their_order(spark):
    found = spark.createDataFrame([(s,) for s in ["shipped", "pending", "delivered"]], "s string")
    ordered = found.orderBy(rules.ordinal(F.col("s"), rules.ORDER_STATUSES)).collect()
    assert [r.s for r in ordered] == ["pending", "shipped", "delivered"]


def test_masked_email(spark):
    assert one(spark, text.masked_email(F.lit("nguyen@gmail.com"))) == "n***@gmail.com"
