"""Data quality checks on the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.bindings import AS_OF, money
from orderloom.catalog.core import checksum_sql, query
from orderloom.functions import dates
from orderloom.functions.text import loose
from orderloom.operators import quality


@query(
    "q1_unique",
    """
    SELECT 'orders.o_orderkey' AS tested, COUNT(*) AS violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'lineitem.l_orderkey,l_linenumber', COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
    """,
)
def _(t):
    def tested(df, keys, name):
        return quality.duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("tested"), "violations"
        )

    return tested(t.orders, ["o_orderkey"], "orders.o_orderkey").unionByName(
        tested(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem.l_orderkey,l_linenumber")
    )


@query(
    "q2_not_null",
    """
    SELECT 'o_orderkey' AS column_name, COUNT(*) - COUNT(o_orderkey) AS nulls FROM orders
    UNION ALL SELECT 'late_total', COUNT(*) - COUNT(CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN o_totalprice END) FROM orders
    UNION ALL SELECT 'o_custkey', COUNT(*) - COUNT(o_custkey) FROM orders
    """,
)
def _(t):
    """All columns in one pass; one of them loses its late values."""
    kept = F.when(F.col("o_orderdate") < dates.instant("2001-01-01 00:00:00"), F.col("o_totalprice"))
    return quality.null_counts(t.orders.select("o_orderkey", "o_custkey", kept.alias("late_total")))


@query(
    "q3_accepted_values",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
)
def _(t):
    accepted = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    return quality.unaccepted(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", accepted)


@query(
    "q4_relationships",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > -900)
    """,
)
def _(t):
    """Orders against the customers that were kept."""
    kept = t.customer.filter("c_acctbal > -900")
    return quality.orphans(t.orders.select("o_orderkey", "o_custkey"), kept, "o_custkey", "c_custkey")


@query(
    "q5_orphan_lines",
    """
    SELECT l_returnflag, COUNT(*) AS orphans FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-02-01') o
    ON o_orderkey = l_orderkey WHERE o_orderkey IS NULL GROUP BY 1
    """,
)
def _(t):
    """Lines whose order was archived in the first month."""
    kept = t.orders.filter(F.col("o_orderdate") >= dates.instant("1995-02-01 00:00:00"))
    lost = quality.orphans(t.lineitem.select("l_orderkey", "l_returnflag"), kept, "l_orderkey", "o_orderkey")
    return lost.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("orphans"))


@query(
    "q6_invalid_amounts",
    """
    SELECT (SELECT COUNT(*) FROM customer WHERE c_acctbal < 0) AS negative_balances,
           (SELECT COUNT(*) FROM part WHERE p_size <= 25 AND (p_retailprice IS NULL OR p_retailprice <= 950)) AS invalid_prices
    """,
)
def _(t):
    negative = t.customer.filter("c_acctbal < 0").agg(F.count(F.lit(1)).alias("negative_balances"))
    cheap = t.part.filter("p_size <= 25 AND (p_retailprice IS NULL OR p_retailprice <= 950)").agg(F.count(F.lit(1)))
    return negative.withColumn("invalid_prices", cheap.scalar())


@query(
    "q7_duplicate_emails",
    """
    SELECT lower(p_name) AS email, COUNT(*) AS rows FROM part WHERE p_size > 10 GROUP BY 1 HAVING COUNT(*) > 1
    """,
)
def _(t):
    """Names of live products, written in two ways, compared without regard to case."""
    written = F.when(F.col("p_size") > 30, F.upper("p_name")).otherwise(F.col("p_name"))
    live = t.part.filter("p_size > 10").select(loose(written).alias("email"))
    found = quality.duplicate_keys(live, ["email"])
    return found.select(F.lower(F.collate("email", "UTF8_BINARY")).alias("email"), "rows")


@query(
    "q8_stuck_orders",
    f"""
    SELECT COUNT(*) FILTER (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS stuck_pending,
           COUNT(*) FILTER (o_orderstatus = 'O' AND o_orderdate > TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR) AS failed_lately FROM orders
    """,
)
def _(t):
    now, status, day = dates.instant(AS_OF), F.col("o_orderstatus"), F.col("o_orderdate")
    return t.orders.agg(
        F.count_if((status == "P") & (day < now - F.expr("INTERVAL 7 DAYS"))).alias("stuck_pending"),
        F.count_if((status == "O") & (day > now - F.expr("INTERVAL 48 HOURS"))).alias("failed_lately"),
    )


@query(
    "q9_reconcile",
    """
    WITH o AS (SELECT COUNT(*) AS n FROM orders), f AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice < 499000)
    SELECT 'orders_copy' AS table_name, o.n AS rows_before, o.n AS rows_after, TRUE AS matches FROM o
    UNION ALL SELECT 'orders_lossy', o.n, f.n, o.n = f.n FROM o, f
    """,
)
def _(t):
    """A faithful and a lossy copy against the original: rows and checksums."""
    columns = [F.col(c) for c in ["o_orderkey", "o_custkey", "o_orderstatus"]] + [money("o_totalprice")]
    lossy = t.orders.filter("o_orderstatus <> 'P' OR o_totalprice < 499000")
    before = [quality.fingerprint(t.orders, n, columns, F.col("o_orderdate")) for n in ["orders_copy", "orders_lossy"]]
    after = [
        quality.fingerprint(t.orders.orderBy(F.desc("o_totalprice")), "orders_copy", columns, F.col("o_orderdate")),
        quality.fingerprint(lossy, "orders_lossy", columns, F.col("o_orderdate")),
    ]
    return quality.reconcile(before[0].unionByName(before[1]), after[0].unionByName(after[1]))


@query(
    "q9_fingerprint",
    f"""
    SELECT 'lineitem' AS table_name, COUNT(*) AS row_count, {checksum_sql("l_orderkey", "l_partkey", "l_linenumber")},
           MAX(l_shipdate) AS latest FROM lineitem
    """,
)
def _(t):
    columns = [F.col(c) for c in ["l_orderkey", "l_partkey", "l_linenumber"]]
    return quality.fingerprint(t.lineitem, "lineitem", columns, F.col("l_shipdate"))


def _report(t):
    """One pass over each checked table; orders below 1000 count as unknown, so that there are orphans."""
    stuck = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < dates.instant(AS_OF) - F.expr("INTERVAL 7 DAYS"))
    return quality.report(
        [
            quality.check("CHECK 1", "Orphaned lines", quality.orphans(t.lineitem, t.orders.filter("o_totalprice >= 1000"), "l_orderkey", "o_orderkey")),
            quality.table_checks(
                t.orders,
                [
                    quality.Rule("CHECK 2", "Negative order totals", F.col("o_totalprice") < 0),
                    quality.Rule("CHECK 5", "Orders stuck pending", stuck, "WARN"),
                ],
                quality.Reference("CHECK 4", "Orders without customer", "o_custkey", t.customer, "c_custkey"),
            ),
            quality.check("CHECK 3", "Duplicate customer names", quality.duplicate_keys(t.customer, ["c_name"])),
            quality.table_checks(
                t.part,
                [quality.Rule("CHECK 6", "Products with invalid price", F.col("p_retailprice").isNull() | (F.col("p_retailprice") <= 0))],
            ),
            quality.table_checks(t.events, [quality.Rule("CHECK 7", "Failed events", F.col("event_type") == "error", "WARN")]),
        ]
    )


REPORT_CTE = f"""
counts(check_id, description, n, level) AS (
  SELECT 'CHECK 1', 'Orphaned lines', (SELECT COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice >= 1000)), 'FAIL'
  UNION ALL SELECT 'CHECK 2', 'Negative order totals', (SELECT COUNT(*) FROM orders WHERE o_totalprice < 0), 'FAIL'
  UNION ALL SELECT 'CHECK 3', 'Duplicate customer names', (SELECT COUNT(*) FROM (SELECT c_name FROM customer GROUP BY 1 HAVING COUNT(*) > 1)), 'FAIL'
  UNION ALL SELECT 'CHECK 4', 'Orders without customer', (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)), 'FAIL'
  UNION ALL SELECT 'CHECK 5', 'Orders stuck pending', (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY), 'WARN'
  UNION ALL SELECT 'CHECK 6', 'Products with invalid price', (SELECT COUNT(*) FROM part WHERE p_retailprice IS NULL OR p_retailprice <= 0), 'FAIL'
  UNION ALL SELECT 'CHECK 7', 'Failed events', (SELECT COUNT(*) FROM events WHERE event_type = 'error'), 'WARN'
),
report AS (SELECT check_id, description, CASE WHEN n = 0 THEN 'PASS' ELSE level END AS result, n AS issue_count FROM counts)
"""


@query("q10_report", f"WITH {REPORT_CTE} SELECT * FROM report")
def _(t):
    return _report(t)


@query(
    "q10_summary",
    f"""
    WITH {REPORT_CTE}
    SELECT COUNT(*) FILTER (result = 'PASS') AS passed, COUNT(*) FILTER (result = 'FAIL') AS failed, COUNT(*) FILTER (result = 'WARN') AS warned,
           CASE WHEN COUNT(*) FILTER (result = 'FAIL') = 0 THEN 'ALL CHECKS PASSED' ELSE 'SOME CHECKS FAILED' END AS overall FROM report
    """,
)
def _(t):
    return quality.summary(_report(t))


@query(
    "q11_tenant_leaks",
    """
    SELECT COUNT(*) FILTER (c_nationkey IS NULL) AS without_tenant, COUNT(*) FILTER (c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)) AS outside
    FROM customer
    """,
)
def _(t):
    """Customers without a tenant, and outside the tenants in use."""
    tenants = t.supplier.filter("s_acctbal > 5000").select("s_nationkey").distinct()
    outside = quality.orphans(t.customer, tenants, "c_nationkey", "s_nationkey").agg(F.count(F.lit(1)))
    return t.customer.agg(F.count_if(F.col("c_nationkey").isNull()).alias("without_tenant")).withColumn(
        "outside", outside.scalar()
    )


@query(
    "q12_transitive_dependency",
    """
    SELECT p_name, MIN(p_brand) AS lowest, MAX(p_brand) AS highest FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_brand) > 1
    """,
)
def _(t):
    """Does the product name determine the brand? The names for which it does not."""
    return quality.violates_dependency(t.part, ["p_name"], "p_brand")


@query("q12_holding_dependency", "SELECT c_nationkey, MIN(n_name) AS lowest, MAX(n_name) AS highest FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 HAVING COUNT(DISTINCT n_name) > 1")
def _(t):
    """Nation key determines nation name: nothing to report."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return quality.violates_dependency(named, ["c_nationkey"], "n_name")


@query(
    "q12_split_values",
    """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
    """,
)
def _(t):
    """Cells with several words, one row per word."""
    several = quality.multi_valued(t.part.select("p_partkey", F.col("p_name").alias("word")), "word", " ")
    return quality.split_values(several, "word", " ")
