"""Registered revenue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, revenue
from ..sources import star
from .oracle import with_prelude
from .registry import register


def _deduped(spark, sf_dir):
    """The repaired panel (written once per session). Revenue, customer and
    month columns are untouched by C2-C8, so these equal the de-duplicated
    star join the oracle uses; reading the materialized, customer-bucketed
    panel avoids re-running the join pipeline per query."""
    return quality.clean(spark, sf_dir, label=False)


@register("a3_revenue_monthly", with_prelude("""
SELECT date_key, month_name, round(sum(mrr), 2) AS mrr,
       count(DISTINCT customer_id) AS customers,
       round(sum(mrr) / count(DISTINCT customer_id), 2) AS arpa
FROM master GROUP BY date_key, month_name"""))
def a3_revenue_monthly(spark, sf_dir):
    return revenue.monthly_revenue(_deduped(spark, sf_dir))


@register("a1_rows_per_table", with_prelude("""
SELECT 'fact' AS table_name, count(*) AS rows FROM fact_raw
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
UNION ALL SELECT 'dim_plan', count(*) FROM dim_plan
UNION ALL SELECT 'dim_region', count(*) FROM dim_region
UNION ALL SELECT 'dim_rep', count(*) FROM dim_rep
UNION ALL SELECT 'dim_date', count(DISTINCT date_key) FROM fact_raw"""))
def a1_rows_per_table(spark, sf_dir):
    f = star.fact(spark, sf_dir, dedupe=False, with_plan=False)
    return revenue.rows_per_table({
        "fact": f,
        "dim_customer": star.dim_customer(spark, sf_dir),
        "dim_plan": star.dim_plan(spark, sf_dir),
        "dim_region": star.dim_region(spark, sf_dir),
        "dim_rep": star.dim_rep(spark, sf_dir),
        "dim_date": f.select("date_key").distinct(),
    })


@register("a2_region_raw", with_prelude("""
SELECT coalesce(region_name, '(no region)') AS region,
       count(DISTINCT customer_id) AS customers, round(sum(mrr), 2) AS total_mrr
FROM master_raw GROUP BY region_name"""))
def a2_region_raw(spark, sf_dir):
    return revenue.revenue_by_region_raw(star.master(spark, sf_dir, dedupe=False))


@register("a4_revenue_overview", with_prelude("""
SELECT round(t.total, 2) AS total_mrr,
       round(ms.mean_m, 2) AS mean_mrr_per_month,
       ms.months AS months, t.customers AS customers,
       round(t.total / t.customers, 2) AS arpa,
       round(ms.first_m, 2) AS mrr_first_month, round(ms.last_m, 2) AS mrr_last_month,
       round((ms.last_m - ms.first_m) / ms.first_m * 100, 2) AS mrr_change_pct,
       round(a.share, 4) AS annual_contract_share
FROM (SELECT avg(m) AS mean_m, count(*) AS months, arg_min(m, date_key) AS first_m,
             arg_max(m, date_key) AS last_m
      FROM (SELECT date_key, sum(mrr) AS m FROM master GROUP BY date_key)) ms,
     (SELECT sum(mrr) AS total, count(DISTINCT customer_id) AS customers FROM master) t,
     (SELECT avg(CASE WHEN is_annual_contract = 1 THEN 1.0 ELSE 0.0 END) AS share
      FROM (SELECT DISTINCT customer_id, is_annual_contract FROM master)) a"""))
def a4_revenue_overview(spark, sf_dir):
    return revenue.revenue_overview(_deduped(spark, sf_dir))


@register("a5_distribution", with_prelude("""
SELECT "column", round(avg(value), 2) AS mean, round(median(value), 2) AS median,
       round(stddev_samp(value), 2) AS std, round(min(value), 2) AS min,
       round(max(value), 2) AS max,
       round((avg(value * value * value) - 3 * avg(value) * avg(value * value)
              + 2 * avg(value) * avg(value) * avg(value))
             / pow(avg(value * value) - avg(value) * avg(value), 1.5), 3) AS skew
FROM (UNPIVOT (SELECT cast(mrr as double) AS mrr, cast(seats as double) AS seats,
                      cast(usage_per_seat as double) AS usage_per_seat,
                      cast(support_tickets as double) AS support_tickets,
                      cast(discount_pct as double) AS discount_pct,
                      cast(nps_score as double) AS nps_score FROM clean)
       ON mrr, seats, usage_per_seat, support_tickets, discount_pct, nps_score
       INTO NAME "column" VALUE value)
WHERE value IS NOT NULL GROUP BY "column"
""", None))
def a5_distribution(spark, sf_dir):
    return revenue.distribution_profile(quality.clean(spark, sf_dir, label=False))


@register("a6_concentration", with_prelude("""
SELECT round(sum(CASE WHEN r <= greatest(1, round_even(n * 0.10, 0)) THEN total ELSE 0 END) / sum(total), 4)
         AS top_10_pct_share_of_mrr,
       round(sum(CASE WHEN r <= greatest(1, round_even(n * 0.20, 0)) THEN total ELSE 0 END) / sum(total), 4)
         AS top_20_pct_share_of_mrr,
       round(sum(CASE WHEN r > n - n // 2 THEN total ELSE 0 END) / sum(total), 4)
         AS bottom_50_pct_share_of_mrr
FROM (SELECT total, row_number() OVER (ORDER BY total DESC, customer_id) AS r,
             count(*) OVER () AS n
      FROM (SELECT customer_id, sum(mrr) AS total FROM master GROUP BY customer_id))"""))
def a6_concentration(spark, sf_dir):
    return revenue.concentration(_deduped(spark, sf_dir))


@register("a13_revenue_by_dim", with_prelude("""
SELECT 'segment' AS dimension, cast(segment as varchar) AS value, round(sum(mrr), 2) AS total_mrr,
       count(DISTINCT customer_id) AS customers, round(avg(mrr), 2) AS mean_mrr
FROM clean GROUP BY segment
UNION ALL
SELECT 'region_name', region_name, round(sum(mrr), 2), count(DISTINCT customer_id), round(avg(mrr), 2)
FROM clean GROUP BY region_name
UNION ALL
SELECT 'industry', industry, round(sum(mrr), 2), count(DISTINCT customer_id), round(avg(mrr), 2)
FROM clean GROUP BY industry""", None))
def a13_revenue_by_dim(spark, sf_dir):
    return revenue.revenue_by_dimensions(quality.clean(spark, sf_dir, label=False))


@register("a14_month_segment", with_prelude("""
SELECT date_key, month_name, segment, round(sum(mrr), 2) AS mrr
FROM master GROUP BY date_key, month_name, segment"""))
def a14_month_segment(spark, sf_dir):
    return revenue.month_by_segment(_deduped(spark, sf_dir))


@register("w1_running_total", with_prelude("""
SELECT date_key, round(m, 2) AS mrr,
       round(sum(m) OVER (ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
         AS cumulative_mrr
FROM (SELECT date_key, sum(mrr) AS m FROM master GROUP BY date_key)"""))
def w1_running_total(spark, sf_dir):
    m = _deduped(spark, sf_dir).groupBy("date_key").agg(F.sum("mrr").alias("mrr_raw"))
    return revenue.running_total(m)


@register("a23_run_rate", with_prelude("""
SELECT round(arg_max(m, date_key) * 12, 2) AS annual_run_rate,
       round((arg_max(m, date_key) - arg_min(m, date_key)) / arg_min(m, date_key) * 100, 2)
         AS window_change_pct
FROM (SELECT date_key, sum(mrr) AS m FROM master GROUP BY date_key)"""))
def a23_run_rate(spark, sf_dir):
    return revenue.run_rate(_deduped(spark, sf_dir))


@register("a24_reconcile", with_prelude("""
SELECT count(*) AS rows_checked,
       count(*) FILTER (WHERE pct <= 5.0) AS within_5_percent,
       count(*) FILTER (WHERE NOT (pct <= 5.0)) AS mismatched,
       round(count(*) FILTER (WHERE pct <= 5.0) / count(*), 4) AS match_rate,
       round(median(pct), 4) AS median_percent_difference,
       round(avg(diff), 4) AS mean_absolute_difference
FROM (SELECT abs(mrr - e) AS diff, abs(mrr - e) / greatest(abs(e), 1.0) * 100 AS pct
      FROM (SELECT mrr, seats * list_price_per_seat * (1.0 - discount_pct) AS e FROM clean))""",
      None))
def a24_reconcile(spark, sf_dir):
    return revenue.reconcile(quality.clean(spark, sf_dir, label=False))


@register("w2_rank_customers", with_prelude("""
SELECT customer_id, round(total, 2) AS total_mrr,
       row_number() OVER (ORDER BY total DESC, customer_id) AS revenue_rank,
       row_number() OVER (ORDER BY total DESC, customer_id)
         <= greatest(1, round_even(count(*) OVER () * 0.10, 0)) AS in_top_10_pct,
       row_number() OVER (ORDER BY total DESC, customer_id)
         > count(*) OVER () - count(*) OVER () // 2 AS in_bottom_half
FROM (SELECT customer_id, sum(mrr) AS total FROM master GROUP BY customer_id)"""))
def w2_rank_customers(spark, sf_dir):
    """Customers ranked by revenue (distributed global rank), with the
    head (top 10%) and tail (bottom n//2) membership used by A6."""
    per = revenue.customer_totals(_deduped(spark, sf_dir))
    ranked = revenue.global_rank(per, [F.col("total").desc(), F.col("customer_id").asc()],
                                 "revenue_rank")
    n = per.agg(F.count("*").alias("n"))
    j = ranked.crossJoin(F.broadcast(n))
    return j.select(
        "customer_id", F.round("total", 2).alias("total_mrr"), "revenue_rank",
        (F.col("revenue_rank") <= F.greatest(F.lit(1), F.bround(F.col("n") * 0.10, 0).cast("long")))
        .alias("in_top_10_pct"),
        (F.col("revenue_rank") > F.col("n") - F.floor(F.col("n") / 2)).alias("in_bottom_half"))
