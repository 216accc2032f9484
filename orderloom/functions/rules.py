"""Business rules as CASE chains; the first condition met wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# States of the shop tables, in their declared order.
ORDER_STATUSES = ["pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded"]
PAYMENT_STATUSES = ["pending", "processing", "completed", "failed", "refunded"]
# Change operation codes.
OP_LABELS = {"c": "CREATE", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
# Customer segments and their Vietnamese names.
RFM_NAMES_VI = {
    "Champions": "Nhà Vô Địch",
    "Loyal Customers": "Khách Hàng Trung Thành",
    "Recent Customers": "Khách Hàng Mới",
    "At Risk": "Có Nguy Cơ",
    "Lost": "Đã Mất",
    "Potential": "Tiềm Năng",
}


def lookup(column: Column, table: dict[str, str], default: str | None = None) -> Column:
    """Value of a small literal table, NULL or ``default`` for an unknown key."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), column)
    return found if default is None else F.coalesce(found, F.lit(default))


def ordinal(column: Column, values: list[str]) -> Column:
    """Position in the declared list, for sorting a state by its order rather than its text."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), column)


def op_label(op: Column) -> Column:
    return lookup(op, OP_LABELS)


def discount_rate(total: Column) -> Column:
    """Rates by order total."""
    return (
        F.when(total >= 50_000_000, 0.15)
        .when(total >= 20_000_000, 0.10)
        .when(total >= 5_000_000, 0.05)
        .otherwise(0.0)
        .cast("decimal(5,4)")
    )


# Limits and names of the bands.
def stock_band(quantity: Column) -> Column:
    return (
        F.when(quantity == 0, "out_of_stock")
        .when(quantity < 10, "low_stock")
        .when(quantity < 100, "adequate")
        .otherwise("well_stocked")
    )


# Limits and names.
def lag_severity(seconds: Column) -> Column:
    return (
        F.when(seconds == 0, "in sync")
        .when(seconds < 30, "minor")
        .when(seconds < 120, "moderate")
        .otherwise("critical")
    )


def exit_level(seconds: Column, warning: int = 30, critical: int = 120) -> Column:
    """0 fine, 1 warning, 2 critical; an unknown lag is critical."""
    return F.when(seconds.isNull() | (seconds >= critical), 2).when(seconds >= warning, 1).otherwise(0)


def value_segment(revenue: Column, vip, regular) -> Column:
    return F.when(revenue > vip, "vip").when(revenue > regular, "regular").otherwise("new")


# The rule and the names of the segments.
def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when(r == 1, "Lost")
        .otherwise("Potential")
    )


def record_status(deleted_at: Column) -> Column:
    return F.when(deleted_at.isNotNull(), "deleted").otherwise("active")
