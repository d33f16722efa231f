"""orderlens: order-history analytics as Spark DataFrame transformations.

Operators take DataFrames and return DataFrames. Most are lazy; those that pass over their
input several times (quantiles, splits, neighbours, the customer x product grid, training)
first write what they read again to a work table, when they are called.
"""
