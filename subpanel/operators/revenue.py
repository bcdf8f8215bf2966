"""Revenue aggregations.

All inputs are the panel DataFrames of ``sources.star`` / ``operators.quality``.
Grouped outputs are bounded by months or categories; anything at customer
grain stays distributed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantile, exact_quantiles
from .rank import global_rank

PROFILE_COLUMNS = ["mrr", "seats", "usage_per_seat", "support_tickets", "discount_pct",
                   "nps_score"]
TOP_FRACTIONS = (0.10, 0.20)
INVOICE_TOLERANCE_PCT = 5.0


def rows_per_table(named: dict) -> DataFrame:
    """``UNION ALL`` of one count per table."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in named.items()]
    return reduce(DataFrame.unionByName, parts)


def revenue_by_region_raw(raw_master: DataFrame) -> DataFrame:
    """A2: revenue by region on raw (un-deduplicated) rows, ``(no region)`` kept.

    Region is a customer attribute, so rows are first reduced to one per
    customer (partial aggregate) and customers are then counted per region —
    no distinct aggregation over fact rows."""
    per = raw_master.groupBy("customer_id", "region_name").agg(F.sum("mrr").alias("m"))
    return per.groupBy("region_name").agg(
        F.count("*").alias("customers"), F.round(F.sum("m"), 2).alias("total_mrr"),
    ).orderBy(F.col("total_mrr").desc(), "region_name").select(
        F.coalesce("region_name", F.lit("(no region)")).alias("region"),
             "customers", "total_mrr")


def monthly_revenue(panel: DataFrame) -> DataFrame:
    """A3: per month: MRR, distinct customers, ARPA = round(MRR / customers, 2)."""
    g = panel.groupBy("date_key", "month_name").agg(
        F.sum("mrr").alias("mrr_raw"), F.countDistinct("customer_id").alias("customers"))
    return g.select("date_key", "month_name", F.round("mrr_raw", 2).alias("mrr"), "customers",
                    F.round(F.col("mrr_raw") / F.col("customers"), 2).alias("arpa"))


def revenue_overview(panel: DataFrame) -> DataFrame:
    """A4: headline scalars as one row.

    First/last month come from ``min_by/max_by(mrr, date_key)`` over the
    monthly frame (bounded by months), customer-level figures from one
    aggregate over the first row per customer.
    """
    monthly = panel.groupBy("date_key").agg(F.sum("mrr").alias("m"))
    mstats = monthly.agg(
        F.avg("m").alias("mean_mrr_per_month"), F.count("*").alias("months"),
        F.min_by("m", "date_key").alias("first_m"), F.max_by("m", "date_key").alias("last_m"))
    totals = panel.agg(F.sum("mrr").alias("total"), F.countDistinct("customer_id").alias("customers"))
    annual = panel.groupBy("customer_id").agg(
        F.min_by("is_annual_contract", F.struct("date_key", "fact_id")).alias("a")) \
        .agg(F.avg((F.col("a") == 1).cast("double")).alias("share"))
    j = mstats.crossJoin(totals).crossJoin(annual)
    return j.select(
        F.round("total", 2).alias("total_mrr"),
        F.round("mean_mrr_per_month", 2).alias("mean_mrr_per_month"),
        F.col("months").cast("long").alias("months"),
        F.col("customers").cast("long").alias("customers"),
        F.round(F.col("total") / F.col("customers"), 2).alias("arpa"),
        F.round("first_m", 2).alias("mrr_first_month"),
        F.round("last_m", 2).alias("mrr_last_month"),
        F.round((F.col("last_m") - F.col("first_m")) / F.col("first_m") * 100, 2)
         .alias("mrr_change_pct"),
        F.round("share", 4).alias("annual_contract_share"),
    )


def distribution_profile(panel: DataFrame, columns=PROFILE_COLUMNS) -> DataFrame:
    """A5: per column mean, exact median, sample std, min, max, population skew.

    One wide aggregate over the pruned columns; the medians of all columns
    come from the same two or three passes (``quantiles``), without an unpivot.
    """
    wide = panel.select(*[F.col(c).cast("double").alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                     F.min(c).alias("min"), F.max(c).alias("max"), F.skewness(c).alias("skew"),
                     F.count(c).alias("n")) for c in columns]
    stats = wide.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows")).where("n > 0")
    med = exact_quantiles(wide, columns).unpivot([], list(columns), "column", "median")
    return stats.join(F.broadcast(med), "column").select(
        "column", F.round("mean", 2).alias("mean"), F.round("median", 2).alias("median"),
        F.round("std", 2).alias("std"), F.round("min", 2).alias("min"),
        F.round("max", 2).alias("max"), F.round("skew", 3).alias("skew"))


def customer_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy("customer_id").agg(F.sum("mrr").alias("total"))


def concentration(panel: DataFrame) -> DataFrame:
    """Revenue share of the top 10% / top 20% and the bottom n//2 customers.

    k = max(1, half-even round(n·f)). Customers are ranked by (total desc, id)
    with the distributed global rank (X1), never a single-task window.
    """
    per = customer_totals(panel)
    ranked = global_rank(per, [F.col("total").desc(), F.col("customer_id").asc()], "r")
    n = F.col("n")
    cuts = per.agg(F.count("*").alias("n"), F.sum("total").alias("grand"))
    j = ranked.crossJoin(F.broadcast(cuts))
    aggs = []
    for f in TOP_FRACTIONS:
        k = F.greatest(F.lit(1), F.bround(n * F.lit(f), 0).cast("long"))
        aggs.append(F.sum(F.when(F.col("r") <= k, F.col("total")).otherwise(0.0))
                    .alias(f"top_{int(round(f * 100))}"))
    aggs.append(F.sum(F.when(F.col("r") > n - F.floor(n / 2), F.col("total")).otherwise(0.0))
                .alias("bottom_50"))
    s = j.groupBy("grand").agg(*aggs)
    return s.select(
        F.round(F.col("top_10") / F.col("grand"), 4).alias("top_10_pct_share_of_mrr"),
        F.round(F.col("top_20") / F.col("grand"), 4).alias("top_20_pct_share_of_mrr"),
        F.round(F.col("bottom_50") / F.col("grand"), 4).alias("bottom_50_pct_share_of_mrr"))


def revenue_by_dimensions(panel: DataFrame, dims=("segment", "region_name", "industry")) -> DataFrame:
    """Revenue by each dimension in one grouping-sets scan.

    The dimensions are customer attributes: rows are reduced to one per
    customer (sum, row count) first, so the grouping-sets Expand and the
    distinct-customer count run on the customer grain, not on fact rows."""
    spark = panel.sparkSession
    per = panel.groupBy("customer_id", *dims).agg(F.sum("mrr").alias("m"),
                                                  F.count("*").alias("n"))
    sets = ", ".join(f"({d})" for d in dims)
    label = "CASE " + " ".join(
        f"WHEN grouping({d}) = 0 THEN '{d}'" for d in dims) + " END"
    value = "coalesce(" + ", ".join(f"CASE WHEN grouping({d}) = 0 THEN cast({d} as string) END"
                                    for d in dims) + ")"
    out = spark.sql(f"""
        SELECT {label} AS dimension, {value} AS value,
               round(sum(m), 2) AS total_mrr,
               count(*) AS customers,
               round(sum(m) / sum(n), 2) AS mean_mrr
        FROM {{per}} GROUP BY GROUPING SETS ({sets})""", per=per)
    return out.orderBy("dimension", F.col("total_mrr").desc(), "value")


def month_by_segment(panel: DataFrame) -> DataFrame:
    """MRR per month × segment."""
    return panel.groupBy("date_key", "month_name", "segment").agg(
        F.round(F.sum("mrr"), 2).alias("mrr"))


def running_total(monthly: DataFrame) -> DataFrame:
    """Cumulative MRR over the *aggregated* months (bounded frame)."""
    w = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select("date_key", F.round("mrr_raw", 2).alias("mrr"),
                          F.round(F.sum("mrr_raw").over(w), 2).alias("cumulative_mrr"))


def run_rate(panel: DataFrame) -> DataFrame:
    """Annualised run-rate = latest month × 12, and window change %."""
    monthly = panel.groupBy("date_key").agg(F.sum("mrr").alias("m"))
    s = monthly.agg(F.max_by("m", "date_key").alias("last_m"),
                    F.min_by("m", "date_key").alias("first_m"))
    return s.select(F.round(F.col("last_m") * 12, 2).alias("annual_run_rate"),
                    F.round((F.col("last_m") - F.col("first_m")) / F.col("first_m") * 100, 2)
                    .alias("window_change_pct"))


def reconcile(panel: DataFrame) -> DataFrame:
    """Invoice reconciliation in one aggregate (+ exact median pass)."""
    expected = F.col("seats") * F.col("list_price_per_seat") * (F.lit(1.0) - F.col("discount_pct"))
    diff = F.abs(F.col("mrr") - expected)
    pct = diff / F.greatest(F.abs(expected), F.lit(1.0)) * 100
    d = panel.select(diff.alias("diff"), pct.alias("pct"))
    within = F.col("pct") <= INVOICE_TOLERANCE_PCT
    s = d.agg(F.count("*").alias("rows_checked"), F.count_if(within).alias("within_5_percent"),
              F.count_if(~within).alias("mismatched"), F.avg("diff").alias("mad"))
    med = exact_quantile(d, "pct").withColumnRenamed("pct", "med")
    return s.crossJoin(med).select(
        "rows_checked", "within_5_percent", "mismatched",
        F.round(F.col("within_5_percent") / F.col("rows_checked"), 4).alias("match_rate"),
        F.round("med", 4).alias("median_percent_difference"),
        F.round("mad", 4).alias("mean_absolute_difference"))
