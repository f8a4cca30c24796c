"""Fixed acceptance values: the example rows whose results this engine must reproduce exactly.

These rows and results are given, not of this repository's making; every test that needs them reads
them here.
"""

from datetime import date

# ---- the enrichment example -----------------------------------------------------------------------

CUSTOMERS = [(10, "John Doe", "USA"), (20, "Jane Smith", "UK")]
ORDERS = [(1, 10, 100.0, "2023-01-01", 1), (2, 20, 150.0, "2023-01-02", 2)]
ITEMS = [(1, 1, "Item A", 2, 50.0), (1, 2, "Item B", 1, 50.0), (2, 1, "Item C", 3, 150.0)]
PRODUCTS = [(1, "Product 1", 10.0, 1, "Category 1"), (2, "Product 2", 25.0, 2, "Category 2")]

DAY1, DAY2 = date(2023, 1, 1), date(2023, 1, 2)
SILVER = [
    ("John Doe", "USA", 10, 1, 100.0, DAY1, 1, "Product 1", 1, "Category 1", 1, "Item A", 2, 50.0),
    ("John Doe", "USA", 10, 1, 100.0, DAY1, 1, "Product 1", 1, "Category 1", 2, "Item B", 1, 50.0),
    ("Jane Smith", "UK", 20, 2, 150.0, DAY2, 2, "Product 2", 2, "Category 2", 1, "Item C", 3, 150.0),
]
GOLD = [
    ("John Doe", "USA", DAY1, 1, "Product 1", 1, "Category 1", 3, 100.0, 1),
    ("Jane Smith", "UK", DAY2, 2, "Product 2", 2, "Category 2", 3, 150.0, 1),
]

# ---- the end-to-end example -----------------------------------------------------------------------

LAKE_PRODUCTS = [
    (1, "Product 1", 10.0, 1, "Category 1"),
    (2, "Product 2", 20.0, 2, "Category 2"),
    (3, "Product 3", 30.0, 3, "Category 3"),
]
LAKE_ORDERS = [
    (1, 10, 100.0, "2023-01-01", 1),
    (2, 20, 1001.0, "2023-01-02", 2),
    (None, 10, 100.0, "2023-01-01", 1),
    (3, 20, 150.0, "2023-01-02", 3),
    (3, 20, 150.0, "2023-01-02", 3),
]
LAKE_ITEMS = [(1, 1, "Item A", 2, 50.0), (1, 2, "Item B", 1, 50.0), (2, 1, "Item C", 3, 151.0)]
LAKE_GOLD = [
    ("John Doe", "USA", DAY1, 1, "Product 1", 1, "Category 1", 3, 100.0, 1),
    ("Jane Smith", "UK", DAY2, 2, "Product 2", 2, "Category 2", 3, 151.0, 1),
]

# ---- orders that fail the quality rules -----------------------------------------------------------

DIRTY_ORDERS = [
    (1, 10, 100.0, "2023-01-01", 1),
    (2, 20, 1001.0, "2023-01-02", 2),
    (None, 10, 100.0, "2023-01-01", 1),
    (3, 20, 100.0, "2023-01-02", 3),
    (3, 20, 100.0, "2023-01-02", 3),
]
