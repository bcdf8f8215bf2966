"""Operators of a large-scale training-data pipeline, each as a Spark job.

Nothing else in the package imports this subpackage. ``queries.load()`` hands
the registered queries and their DuckDB statements to the driver entry.
"""
