"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.bindings import AS_OF, money
from orderloom.catalog.core import query, text_sql
from orderloom.functions import dates, keys, rules, text


@query("f1_lower_trim", "SELECT p_partkey, lower(trim('  ' || p_type || ' ')) AS clean FROM part")
def _(t):
    return t.part.select("p_partkey", text.clean_email(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("clean"))


@query(
    "f2_concat_null",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment || ':' || CAST(c_nationkey AS VARCHAR) END AS label FROM customer
    """,
)
def _(t):
    part = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", F.concat(part, F.lit(":"), F.col("c_nationkey").cast("string")).alias("label"))


@query("f3_left_substr", "SELECT p_partkey, left(p_name, 3) AS head, substr(p_name, 5, 4) AS middle FROM part")
def _(t):
    return t.part.select("p_partkey", F.left("p_name", F.lit(3)).alias("head"), F.substring("p_name", 5, 4).alias("middle"))


@query(
    "f4_lpad_hex_unhex",
    """
    SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, upper(hex(p_type)) AS coded, p_type AS decoded FROM part
    """,
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.hex("p_type").alias("coded"),
        F.decode(F.unhex(F.hex("p_type")), "UTF-8").alias("decoded"),
    )


@query(
    "f5_elt_names",
    """
    SELECT o_orderkey, 'Tháng ' || month(o_orderdate) AS month_vi,
           CASE dayofweek(o_orderdate) WHEN 0 THEN 'Chủ Nhật' WHEN 1 THEN 'Thứ Hai' WHEN 2 THEN 'Thứ Ba' WHEN 3 THEN 'Thứ Tư'
             WHEN 4 THEN 'Thứ Năm' WHEN 5 THEN 'Thứ Sáu' ELSE 'Thứ Bảy' END AS day_vi,
           CASE WHEN month(o_orderdate) <= 3 THEN 'Tháng ' || month(o_orderdate) END AS first_quarter_only
    FROM orders
    """,
)
def _(t):
    month = F.month("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.pick(month, dates.MONTH_NAMES_VI).alias("month_vi"),
        dates.pick(F.dayofweek("o_orderdate"), dates.DAY_NAMES_VI).alias("day_vi"),
        dates.pick(month, dates.MONTH_NAMES_VI[:3]).alias("first_quarter_only"),
    )


@query("f6_coalesce", "SELECT p_partkey, COALESCE(CASE WHEN p_size > 25 THEN p_brand END, p_type, '-') AS label FROM part")
def _(t):
    return t.part.select(
        "p_partkey", F.coalesce(F.when(F.col("p_size") > 25, F.col("p_brand")), "p_type", F.lit("-")).alias("label")
    )


@query(
    "f7_round_floor",
    """
    SELECT o_orderkey, CAST(ROUND(CAST(o_totalprice AS DECIMAL(14,2)), 1) AS DECIMAL(14,1)) AS rounded,
           CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders
    """,
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.round(money("o_totalprice"), 1).cast("decimal(14,1)").alias("rounded"),
        F.floor("o_totalprice").alias("whole"),
    )


@query(
    "f8_null_safe_division",
    "SELECT l_orderkey, l_partkey, CASE WHEN l_tax = 0 THEN NULL ELSE ROUND(l_discount / l_tax, 4) END AS ratio FROM lineitem",
)
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", F.round(F.try_divide("l_discount", "l_tax"), 4).alias("ratio"))


@query("f9_modulo", "SELECT o_orderkey, o_custkey % 3 AS shard, -o_custkey % 7 AS signed FROM orders")
def _(t):
    return t.orders.select("o_orderkey", (F.col("o_custkey") % 3).alias("shard"), (-F.col("o_custkey") % 7).alias("signed"))


@query(
    "f10_lenient_cast",
    "SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS BIGINT) AS brand_no, TRY_CAST(p_type AS BIGINT) AS not_a_number FROM part",
)
def _(t):
    return t.part.select(
        "p_partkey",
        text.lenient_number(F.expr("substr(p_brand, 7)")).alias("brand_no"),
        text.lenient_number(F.col("p_type")).alias("not_a_number"),
    )


@query(
    "f11_date_format",
    """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y-%m') AS month,
           strftime(o_orderdate, '%B') AS month_name FROM orders
    """,
)
def _(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dates.date_key(day).alias("date_key"),
        dates.month_label(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


@query(
    "f12_date_parts",
    """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(quarter(ts) AS INTEGER) AS q, CAST(month(ts) AS INTEGER) AS m,
           CAST(day(ts) AS INTEGER) AS d, CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(ts AS DATE) AS day FROM events
    """,
)
def _(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.year(ts).alias("y"),
        F.quarter(ts).alias("q"),
        F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("d"),
        F.dayofyear(ts).alias("doy"),
        F.to_date(ts).alias("day"),
    )


@query(
    "f13_day_of_week",
    "SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS sunday1, CAST(isodow(o_orderdate) AS INTEGER) AS monday1 FROM orders",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.dayofweek("o_orderdate").alias("sunday1"),
        dates.iso_weekday(F.col("o_orderdate")).alias("monday1"),
    )


@query(
    "f14_weeks",
    """
    SELECT o_orderkey, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
           CAST(CASE WHEN isoyear(o_orderdate) < year(o_orderdate) THEN 0 WHEN isoyear(o_orderdate) > year(o_orderdate) THEN 53
                     ELSE weekofyear(o_orderdate) END AS INTEGER) AS week_from_0 FROM orders
    """,
)
def _(t):
    day = F.col("o_orderdate")
    return t.orders.select("o_orderkey", F.weekofyear(day).alias("iso_week"), dates.week_monday_first(day).alias("week_from_0"))


@query("f15_full_names", "SELECT o_orderkey, monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name FROM orders")
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "MMMM").alias("month_name"),
        F.date_format("o_orderdate", "EEEE").alias("day_name"),
    )


@query(
    "f16_interval_arithmetic",
    """
    SELECT event_id, ts - INTERVAL 24 HOUR AS day_before, CAST(CAST(ts AS DATE) + INTERVAL 7 DAY AS DATE) AS week_on,
           ts - INTERVAL 12 MONTH AS year_before FROM events
    """,
)
def _(t):
    return t.events.select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 24 HOURS")).alias("day_before"),
        F.date_add(F.to_date("ts"), 7).alias("week_on"),
        (F.col("ts") - F.expr("INTERVAL 12 MONTHS")).alias("year_before"),
    )


@query(
    "f17_datediff",
    f"SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF[:10]}') AS INTEGER) AS days FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", F.datediff(dates.instant(AS_OF), "o_orderdate").alias("days"))


@query(
    "f18_timestampdiff",
    """
    SELECT event_id, date_sub('hour', ts, TIMESTAMP '2024-02-01') AS hours, date_sub('second', ts, TIMESTAMP '2024-02-01') AS seconds FROM events
    """,
)
def _(t):
    end = dates.instant("2024-02-01 00:00:00")
    return t.events.select(
        "event_id",
        dates.whole_units("HOUR", F.col("ts"), end).alias("hours"),
        dates.whole_units("SECOND", F.col("ts"), end).alias("seconds"),
    )


@query(
    "f19_as_of_argument",
    f"SELECT o_orderkey, o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY AS is_old FROM orders",
)
def _(t):
    """'Now' is an argument, so that a run can be repeated."""
    return t.orders.select(
        "o_orderkey", (F.col("o_orderdate") < dates.instant(AS_OF) - F.expr("INTERVAL 7 DAYS")).alias("is_old")
    )


@query(
    "f20_epoch_ms",
    """
    SELECT event_id, epoch_us(ts) // 1000 AS ms, CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS back FROM events
    """,
)
def _(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id", ms.alias("ms"), dates.epoch_ms_to_timestamp(ms).cast("timestamp_ntz").alias("back")
    )


@query("f21_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS missing FROM events")
def _(t):
    return t.events.select(
        "event_id",
        text.lenient_number(text.json_text(F.col("props"), "$.k")).alias("k"),
        text.json_text(F.col("props"), "$.none").alias("missing"),
    )


@query(
    "f22_json_object",
    """
    SELECT event_id, '{"id":' || event_id || ',"type":"' || event_type || '","note":null}' AS body FROM events
    """,
)
def _(t):
    body = text.json_object(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"), F.lit(None).cast("string").alias("note")
    )
    return t.events.select("event_id", body.alias("body"))


@query("f23_uuid_v4")
def _(t):
    """Random ids: rows only."""
    return t.events.select("event_id", keys.uuid_v4().alias("uuid"))


@query("f23_uuid_v4_law", "SELECT COUNT(*) AS ids, COUNT(*) AS different, COUNT(*) AS well_formed FROM events")
def _(t):
    """Whatever the ids are: as many different ones as rows, each of the shape of version 4."""
    shape = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    made = t.events.select(keys.uuid_v4().alias("uuid")).groupBy("uuid").agg(F.count(F.lit(1)).alias("n"))
    return made.agg(
        F.sum("n").alias("ids"), F.count(F.lit(1)).alias("different"), F.sum(F.when(F.col("uuid").rlike(shape), F.col("n")).otherwise(0)).alias("well_formed")
    )


@query(
    "f24_uuid_v7",
    f"""
    WITH h AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, md5({text_sql("event_id")}) AS n FROM events),
         x AS (SELECT *, lpad(lower(hex(ms)), 12, '0') AS t FROM h)
    SELECT event_id, substr(t, 1, 8) || '-' || substr(t, 9, 4) || '-7' || substr(n, 1, 3) || '-' ||
           substr('89ab', CAST(('0x' || substr(n, 4, 1)) AS INTEGER) % 4 + 1, 1) || substr(n, 5, 3) || '-' || substr(n, 8, 12) AS uuid FROM x
    """,
)
def _(t):
    return t.events.select("event_id", keys.uuid_v7(F.col("ts"), F.col("event_id")).alias("uuid"))


@query("f25_hashes", "SELECT event_id, sha256(props) AS request_hash, md5(props) AS key_hash FROM events")
def _(t):
    return t.events.select("event_id", keys.request_hash(F.col("props")).alias("request_hash"), F.md5("props").alias("key_hash"))


@query("f26_rand")
def _(t):
    """Random numbers in [0, 1): rows only."""
    return t.orders.select("o_orderkey", F.rand(11).alias("draw"))


@query("f26_rand_law", "SELECT COUNT(*) AS draws, COUNT(*) AS inside, TRUE AS spread FROM orders")
def _(t):
    """All draws lie in [0, 1) and fill both halves."""
    drawn = t.orders.select(F.rand(11).alias("draw"))
    inside = (F.col("draw") >= 0) & (F.col("draw") < 1)
    spread = (F.min("draw") < 0.5) & (F.max("draw") >= 0.5)
    return drawn.agg(F.count("draw").alias("draws"), F.count_if(inside).alias("inside"), spread.alias("spread"))


@query(
    "x1_discount_rate",
    """
    SELECT o_orderkey, CAST(CASE WHEN o_totalprice * 100 >= 50000000 THEN 0.15 WHEN o_totalprice * 100 >= 20000000 THEN 0.10
           WHEN o_totalprice * 100 >= 5000000 THEN 0.05 ELSE 0 END AS DECIMAL(5,4)) AS rate FROM orders
    """,
)
def _(t):
    """Totals in hundredths, to reach all rates."""
    return t.orders.select("o_orderkey", rules.discount_rate(money("o_totalprice") * 100).alias("rate"))


@query(
    "x1_sql_function",
    "SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END AS size FROM orders",
)
def _(t):
    """The same kind of rule as a SQL function, which the optimizer inlines."""
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION order_size(amount DOUBLE) RETURNS STRING RETURN "
        "CASE WHEN amount >= 400000 THEN 'large' WHEN amount >= 100000 THEN 'medium' ELSE 'small' END"
    )
    return t.spark.sql("SELECT o_orderkey, order_size(o_totalprice) AS size FROM {orders}", orders=t.orders)


@query(
    "x2_uuid_v7_orders",
    f"""
    WITH h AS (SELECT o_orderkey, epoch_ms(o_orderdate) AS ms, md5({text_sql("o_orderkey", "o_custkey")}) AS n FROM orders),
         x AS (SELECT *, lpad(lower(hex(ms)), 12, '0') AS t FROM h)
    SELECT o_orderkey, substr(t, 1, 8) || '-' || substr(t, 9, 4) || '-7' || substr(n, 1, 3) || '-' ||
           substr('89ab', CAST(('0x' || substr(n, 4, 1)) AS INTEGER) % 4 + 1, 1) || substr(n, 5, 3) || '-' || substr(n, 8, 12) AS uuid FROM x
    """,
)
def _(t):
    return t.orders.select(
        "o_orderkey", keys.uuid_v7(F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_custkey")).alias("uuid")
    )


@query(
    "x3_set_based_procedure",
    """
    SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders, COUNT(*) FILTER (o_orderstatus = 'P') AS to_confirm FROM orders GROUP BY 1
    """,
)
def _(t):
    """What a procedure does day by day in a loop, as one aggregate."""
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "P").alias("to_confirm")
    )


@query(
    "x4_parameterised_view",
    """
    SELECT o_orderkey, o_orderdate FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE c_nationkey = 3 AND o_orderdate < TIMESTAMP '1999-01-01'
    """,
)
def _(t):
    """A view with a tenant and a point in time as arguments: a function giving a DataFrame."""

    def orders_of(tenant: int, as_of: str):
        members = t.customer.filter(F.col("c_nationkey") == tenant).select("c_custkey")
        past = t.orders.filter(F.col("o_orderdate") < dates.instant(as_of))
        return past.join(members, F.col("o_custkey") == F.col("c_custkey"), "left_semi")

    return orders_of(3, "1999-01-01 00:00:00").select("o_orderkey", "o_orderdate")
