"""subpanel — subscription-panel analytics as Spark jobs.

Star-panel sources, cleaning with a repair log, revenue / churn / risk
aggregates, statistics, models and clustering; every operator is
DataFrame(s) in, DataFrame out.
"""

__version__ = "0.1.0"
