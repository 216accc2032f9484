"""A handful of shop rows with known results. Fixed values."""

import datetime as dt
from decimal import Decimal

CREATED = dt.datetime(2024, 1, 1)

CATEGORIES = [
    (1, None, "Electronics", "electronics"),
    (2, 1, "Smartphones", "smartphones"),
    (3, 2, "Android Phones", "android-phones"),
    (4, 2, "iPhones", "iphones"),
    (5, 1, "Laptops", "laptops"),
    (6, 5, "Gaming Laptops", "gaming-laptops"),
    (7, 5, "Business Laptops", "business-laptops"),
    (8, 1, "Accessories", "accessories"),
    (9, None, "Fashion", "fashion"),
    (10, 9, "Men's Clothing", "mens-clothing"),
    (11, 9, "Women's Clothing", "womens-clothing"),
]
# id, lft, rgt: numbers with gaps
NESTED = [
    (1, 1, 20), (2, 2, 7), (3, 3, 4), (4, 5, 6), (5, 8, 13), (6, 9, 10), (7, 11, 12), (8, 14, 19),
    (9, 21, 30), (10, 22, 25), (11, 26, 29),
]
CUSTOMERS = [
    (1, " Nguyen.Van.A@gmail.com ", "Nguyễn Văn A", "active", None),
    (2, "tran.thi.b@gmail.com", "Trần Thị B", "active", None),
    (3, "le.van.c@company.vn", "Lê Văn C ", "active", None),
    (4, "pham.thi.d@outlook.com", "Phạm Thị D", "active", dt.datetime(2024, 12, 1)),
    (5, "hoang.van.e@yahoo.com", "Hoàng Văn E", "inactive", None),
]
ADDRESSES = [
    (1, "Hà Nội", "VN", True),
    (1, "Hà Nội", "VN", False),
    (2, "Hồ Chí Minh", "VN", True),
    (3, "Vientiane", "LA", True),
]
# id, customer, status, subtotal, discount, tax, shipping, total, created
ORDERS = [
    (1, 1, "delivered", 29990000, 1000000, 2890000, 30000, 31910000, dt.datetime(2024, 11, 15, 9, 23)),
    (2, 2, "delivered", 39990000, 0, 3999000, 30000, 44019000, dt.datetime(2024, 11, 20, 14, 12)),
    (3, 3, "shipped", 54990000, 500000, 5449000, 50000, 59989000, dt.datetime(2024, 12, 1, 10, 5)),
    (5, 4, "pending", 1290000, 50000, 124000, 15000, 1379000, dt.datetime(2024, 12, 11, 8, 30)),
    (7, 5, "cancelled", 29990000, 0, 2999000, 30000, 33019000, dt.datetime(2024, 12, 8, 9, 0)),
]
# id, order, method, status, amount, gateway, processed, created
PAYMENTS = [
    (1, 1, "bank_transfer", "completed", Decimal("31910000.00"), "vnpay", dt.datetime(2024, 11, 15, 9, 28), dt.datetime(2024, 11, 15, 9, 23)),
    (2, 2, "card", "completed", Decimal("44019000.00"), "stripe", dt.datetime(2024, 11, 20, 14, 15), dt.datetime(2024, 11, 20, 14, 12)),
    (5, 5, "cod", "pending", Decimal("1379000.00"), None, None, dt.datetime(2024, 12, 11, 8, 30)),
    (7, 7, "voucher", "failed", Decimal("33019000.00"), "vnpay", dt.datetime(2024, 12, 8, 9, 5), dt.datetime(2024, 12, 8, 9, 0)),
]


def categories(spark):
    return spark.createDataFrame(CATEGORIES, "id long, parent_id long, name string, slug string")


def nested(spark):
    return spark.createDataFrame(NESTED, "id long, lft long, rgt long")


def customers(spark):
    rows = [(i, f"uuid-{i}", e, None, n, s, CREATED, CREATED, d) for i, e, n, s, d in CUSTOMERS]
    return spark.createDataFrame(
        rows,
        "id long, uuid string, email string, phone string, full_name string, status string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz",
    )


def addresses(spark):
    return spark.createDataFrame(ADDRESSES, "customer_id long, city string, country string, is_default boolean")


def orders(spark):
    rows = [(i, c, s, *[Decimal(x) for x in money], at, at) for i, c, s, *money, at in ORDERS]
    return spark.createDataFrame(
        rows,
        "id long, customer_id long, order_status string, subtotal decimal(14,2), discount_amount decimal(14,2), "
        "tax_amount decimal(14,2), shipping_amount decimal(14,2), total_amount decimal(14,2), "
        "created_at timestamp_ntz, updated_at timestamp_ntz",
    )


def payments(spark):
    return spark.createDataFrame(
        PAYMENTS,
        "id long, order_id long, method string, status string, amount decimal(14,2), gateway string, "
        "processed_at timestamp_ntz, created_at timestamp_ntz",
    )
