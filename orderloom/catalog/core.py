"""Registry of the named queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from orderloom.bindings import Tables
from orderloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``build(tables) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = dedent(sql).strip()
        return build

    return register


def key_sql(*values: str) -> str:
    """SQL of a surrogate key: each value with its length before it, a dash for NULL."""
    return f"sha256({text_sql(*values)})"


def text_sql(*values: str) -> str:
    texts = [f"CAST({v} AS VARCHAR)" for v in values]
    return " || ".join(f"COALESCE(length({t}) || ':' || {t}, '-')" for t in texts)


def checksum_sql(*values: str) -> str:
    """SQL of the two table checksums."""
    digest = f"md5({text_sql(*values)})"
    return ", ".join(
        f"CAST(SUM(CAST(CAST(('0x' || substr({digest}, {start}, 16)) AS UBIGINT) AS HUGEINT)) AS DECIMAL(38,0)) AS {name}"
        for start, name in ((1, "checksum"), (17, "checksum_2"))
    )


# Common table expressions shared by the checking SQL, written for another engine
# and from the tables, not from the Spark code.
LINES_CTE = """
lines AS (
  SELECT l_orderkey AS order_nk, o_custkey AS customer_nk, l_partkey AS product_nk,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS gross_revenue,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(14,2))
           AS discount_amount,
         CAST(l_extendedprice AS DECIMAL(14,2))
           - CAST(ROUND(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(14,2))
           AS net_revenue,
         CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS order_source,
         md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),
             CAST(l_extendedprice AS DECIMAL(14,2)), CAST(l_discount AS DECIMAL(4,2)), CAST(l_tax AS DECIMAL(4,2)),
             l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS order_item_nk
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderstatus = 'F'
)"""

PLACES_CTE = """
located AS (
  SELECT c_custkey AS customer_nk, c_name AS full_name, n_name AS city, r_name AS country,
         c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(14,2)) AS balance
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
)"""

SNAPSHOTS_CTE = (
    PLACES_CTE
    + """,
cust_before AS (SELECT * FROM located WHERE balance <= 9500),
cust_after AS (
  SELECT customer_nk, full_name, city, country,
         CASE WHEN segment = 'BUILDING' THEN 'MACHINERY' ELSE segment END AS segment, balance
  FROM located WHERE balance >= -900
)"""
)

DIM_CUSTOMER_CTE = (
    SNAPSHOTS_CTE
    + f""",
dim_rows AS (
  SELECT b.customer_nk, b.full_name, b.city, b.country, b.segment, b.balance, DATE '1995-01-01' AS effective_from,
         CASE WHEN a.segment <> b.segment THEN DATE '1998-01-01' END AS effective_to,
         COALESCE(a.segment = b.segment, TRUE) AS is_current
  FROM cust_before b LEFT JOIN cust_after a ON a.customer_nk = b.customer_nk
  UNION ALL
  SELECT a.customer_nk, a.full_name, a.city, a.country, a.segment, a.balance, DATE '1998-01-01', CAST(NULL AS DATE), TRUE
  FROM cust_after a LEFT JOIN cust_before b ON a.customer_nk = b.customer_nk
  WHERE b.customer_nk IS NULL OR a.segment <> b.segment
),
dim_customer AS (
  SELECT {key_sql("customer_nk", "effective_from")} AS customer_sk, * FROM dim_rows
)"""
)
