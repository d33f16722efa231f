"""The hand-made edge tables of FIXTURES.md."""

import datetime as dt
from decimal import Decimal

from orderlens.sources import base_schemas

CUSTOMERS = [("C1", "TR", "Izmir"), ("C2", "TR", "Ankara"), ("C3", "DE", "Berlin"),
             ("C4", "FR", "Lyon")]
PRODUCTS = [("P1", "chai", 1, 10.0, 0), ("P2", "tea", 1, 20.0, 0), ("P3", "gift", 2, 0.0, 0),
            ("P4", "salt", 2, 5.0, 1)]
CATEGORIES = [(1, "drinks"), (2, "other")]
ORDERS = [("O1", "C1", "1997-06-01"), ("O2", "C1", "1997-08-01"), ("O3", "C1", "1998-04-01"),
          ("O4", "C2", "1997-05-01"), ("O5", "C2", "1998-05-06"), ("O6", "C1", "1997-05-06"),
          ("O7", "C4", "1997-07-01")]
LINES = [("O1", "P1", "10", 5, "0.25"), ("O1", "P2", "20", 2, "0.00"), ("O2", "P1", "10", 40, "0.20"),
         ("O3", "P2", "20", 1, "0.10"), ("O4", "P1", "10", 1, "0.00"), ("O5", "P2", "20", 0, "0.50"),
         ("O7", "P3", "0", 3, "0.00")]


def edge_tables(spark):
    schemas = base_schemas()
    rows = {
        "customers": CUSTOMERS, "products": PRODUCTS, "categories": CATEGORIES,
        "orders": [(o, c, dt.date.fromisoformat(d)) for o, c, d in ORDERS],
        "order_details": [(f"{o}-{p}", o, p, Decimal(price), q, Decimal(disc))
                          for o, p, price, q, disc in LINES],
    }
    return {name: spark.createDataFrame(data, schemas[name]) for name, data in rows.items()}
