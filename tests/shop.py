"""A small hand-made shop with the awkward rows in it."""

from daybook.schemas import MODEL

DAY, OTHER_DAY = "2021-03-01", "2021-03-02"

ROWS = {
    "departments": [(1, "Home"), (2, "Garden")],
    "categories": [
        (10, 1, "Lamps"),
        (11, 1, "Chairs"),
        (12, 2, "Pots"),
        (13, 99, "Lost"),  # department does not exist
    ],
    "products": [
        (100, 10, "lamp"),
        (101, 11, "chair"),
        (102, 12, "pot"),
        (103, 13, "lost"),
        (104, 77, "uncategorised"),  # category does not exist
    ],
    "customers": [
        (1, "Ann", "A", "Oslo", "NO"),
        (2, "Bo", "B", "Rome", "IT"),
        (3, "Cy", "C", "Bonn", "DE"),
        (4, "Di", "D", "Lyon", "FR"),
        (5, "Ed", "E", "Graz", "AT"),
    ],
    # customer 9, the top spender, has no customer row
    "orders": [
        (1, DAY, 1, "COMPLETE", DAY),
        (2, DAY, 2, "PENDING", DAY),
        (3, DAY, 3, "CANCELED", DAY),
        (4, DAY, 4, "ON_HOLD", DAY),
        (5, DAY, 5, None, DAY),
        (6, DAY, 9, "COMPLETE", DAY),
        (7, DAY, 3, "COMPLETE", DAY),
        (8, DAY, 4, "COMPLETE", DAY),
        (9, OTHER_DAY, 1, "COMPLETE", OTHER_DAY),
    ],
    "order_items": [
        (1, 1, 100, 2, 20.25),
        (2, 1, 101, 1, 100.10),
        (3, 2, 102, 3, 30.30),
        (4, 3, 100, 50, 99999.0),  # cancelled
        (5, 4, 100, 50, 99999.0),  # on hold
        (6, 5, 100, 50, 99999.0),  # status unknown
        (7, 6, 103, 4, 5000.0),  # category without department
        (8, 7, 104, 9, 70.0),  # product without category
        (9, 7, 999, 9, 70.0),  # item without product
        (10, 555, 100, 9, 70.0),  # item without order
        (11, 7, 100, 1, 10.0),
        (12, 8, 102, 1, 10.0),
        (13, 9, 100, 7, 70.0),
    ],
}


def frames(spark, **overrides):
    """Model tables as DataFrames; ``overrides`` replaces the rows of single tables."""
    rows = {**ROWS, **overrides}
    return {name: spark.createDataFrame(rows[name], MODEL[name]) for name in MODEL}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
