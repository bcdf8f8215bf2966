"""Registered queries: one module per area, each query a ``(spark, sf_dir) ->
DataFrame`` function with its DuckDB oracle (see ``registry``)."""
