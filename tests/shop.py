"""A small invented shop in the raw shapes of the order model."""

import datetime as dt

from ledgerline import schemas

D = dt.date
T = dt.datetime

PRODUCTS = [
    ("A-1", "Trail Shoe", "Shoes/Outdoor", 80.0, 12, D(2025, 1, 1), None),
    ("A-2", "Road Shoe", "Shoes/Road", 95.0, 4, D(2025, 1, 1), None),
    ("B-1", "Rain Jacket", "Apparel/Outer", 120.0, 7, D(2025, 2, 1), None),
    ("B-2", "Wool Cap", "Apparel/Head", 15.0, 30, D(2025, 2, 1), None),
    ("C-1", "Water Bottle", "Gear", 9.5, 50, D(2025, 3, 1), None),
    ("C-1", "Old Bottle", "Gear", 8.0, 0, D(2024, 3, 1), D(2025, 12, 1)),
    ("D-9", "Desk Lamp", "Gear", 30.0, 0, D(2024, 1, 1), D(2026, 1, 1)),
    ("E-1", "Broken Price", "Gear", -1.0, 3, D(2025, 1, 1), None),
]
CUSTOMERS = [
    (1, "Ada", "Lovelace", "ada@example.org", 10001, T(2025, 1, 2, 9), None),
    (2, "Alan", "Turing", "mailto_alan@example.org", 10002, T(2025, 1, 3, 9), None),
    (3, "Grace", "Hopper", None, 10003, T(2025, 1, 4, 9), None),
    (4, "Edsger", "Dijkstra", "edsger.example.org", 10004, T(2025, 1, 5, 9), None),
    (5, "Barbara", None, "b@example.org", 10005, T(2025, 1, 6, 9), None),
    (6, "Ken", "Thompson", "ken@example.org", 10006, T(2025, 1, 7, 9), T(2031, 1, 1)),
]
ORDERS = [
    (1, 1, T(2026, 5, 20, 10), "Complete", 170.0, 5.0, 0.0, 175.0, T(2026, 5, 25, 10), 2026, 5),
    (2, 2, T(2026, 6, 1, 11), "In-Progress", 228.5, 0.0, 0.0, 228.5, T(2026, 6, 2, 11), 2026, 6),
    (3, 1, T(2026, 6, 10, 12), "Cancelled", 475.0, 0.0, 0.0, 475.0, T(2026, 6, 11, 12), 2026, 6),
    (4, 3, T(2026, 5, 10, 9), "Complete", 380.0, 0.0, 0.0, 380.0, T(2026, 5, 12, 9), 2026, 5),
    (5, 4, T(2026, 5, 31, 23), "Initial", 169.98, 0.0, 0.0, 169.98, T(2026, 5, 31, 23), 2026, 6),
    (6, 5, T(2026, 6, 14, 8), "Initial", 15.0, 0.0, 0.0, 15.0, T(2026, 6, 14, 8), 2026, 6),
    (7, 5, T(2026, 6, 2, 8), None, 1.0, 0.0, 0.0, 1.0, T(2026, 6, 2, 8), 2026, 6),
]
ITEMS = [
    (10, 1, "A-1", 2, 0.0, 160.0, "Delivered", T(2026, 5, 25, 10), 2026, 5),
    (11, 1, "B-2", 1, 1.5, 15.0, "Delivered", T(2026, 5, 25, 10), 2026, 5),
    (12, 2, "A-1", 1, 0.0, 80.0, "Shipped", T(2026, 6, 2, 11), 2026, 6),
    (13, 2, "C-1", 3, None, 28.5, "Initial", T(2026, 6, 2, 11), 2026, 6),
    (14, 2, "B-1", 1, 10.0, 120.0, "Cancelled", T(2026, 6, 2, 11), 2026, 6),
    (15, 3, "A-2", 5, 0.0, 475.0, "Initial", T(2026, 6, 11, 12), 2026, 6),
    (16, 4, "A-2", 4, 0.0, 380.0, "Delivered", T(2026, 5, 12, 9), 2026, 5),
    (17, 5, "A-1", 1, 0.0, 79.99, "Initial", T(2026, 5, 31, 23), 2026, 6),
    (18, 5, "D-9", 2, 0.0, 60.0, "Initial", T(2026, 5, 31, 23), 2026, 6),
    (19, 6, "B-2", 1, 0.0, 15.0, "Initial", T(2026, 6, 14, 8), 2026, 6),
    (20, 5, "B-2", 2, 2.0, 29.99, "Shipped", T(2026, 6, 1, 7), 2026, 6),
]
STATUS = [("order", "Cancelled", 0), ("order", "Initial", 10), ("order", "In-Progress", 20),
          ("order", "Complete", 30), ("item", "Cancelled", 0), ("item", "Initial", 1000),
          ("item", "Shipped", 2000), ("item", "Delivered", 3000)]

PARTS = "year int, month int"


def _with_parts(schema):
    return schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", " + PARTS


class FrameSource:
    """Stand-in for ``OrderModel`` over the invented rows."""

    def __init__(self, spark):
        self.spark = spark

    def products(self):
        return self.spark.createDataFrame(PRODUCTS, schemas.PRODUCTS)

    def customers(self):
        return self.spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)

    def status(self):
        return self.spark.createDataFrame(STATUS, schemas.STATUS)

    def orders(self):
        return self.spark.createDataFrame(ORDERS, _with_parts(schemas.ORDERS))

    def order_items(self):
        return self.spark.createDataFrame(ITEMS, _with_parts(schemas.ORDER_ITEMS))

    def order_change_feed(self):
        return self.orders().drop("year", "month")

    def item_change_feed(self):
        return self.order_items().drop("year", "month")
