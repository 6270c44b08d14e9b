"""sievework: turn messy tabular deliveries into trustworthy tables, on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function or a ``Column``
builder.  Nothing here sets up a cluster, plans a query or stores data by
itself; Spark does that.
"""
