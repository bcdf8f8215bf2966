"""DataFrame-in, DataFrame-out operators grouped by area (quality, revenue, churn, ranks, quantiles, thresholds, statistics, models, clustering)."""
