"""Registered preview, leakage, consistency, mirror and attach queries
(S2-S4, S7, P9, P10, P12, J8, A11, A15)."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import functions as F

from ..functions.hashing import bucket, bucket_sql
from ..operators import churn, cluster, quality
from ..session import checkpoint_dir
from ..sources import sinks, star
from .oracle import with_prelude
from .registry import register

_MIRRORS: dict = {}


@register("s7_preview", with_prelude("""
SELECT customer_id, company_name, industry, segment, signup_date
FROM dim_customer ORDER BY customer_id LIMIT 3"""))
def s7_preview(spark, sf_dir):
    """The first three rows of a table by primary key (limit is the feature)."""
    c = star.dim_customer(spark, sf_dir)
    return c.select("customer_id", "company_name", "industry", "segment", "signup_date") \
            .orderBy("customer_id").limit(3)


@register("p9_leakage", with_prelude("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {str(c in churn.CHURN_FORBIDDEN).lower()} AS is_forbidden, "
    f"count({c}) AS non_null FROM scored" for c in [*churn.CHURN_FEATURES, "is_churned"])))
def p9_leakage(spark, sf_dir):
    """Features and post-outcome columns that the scored frame's schema holds,
    told apart and counted; a post-outcome column in the feature list raises."""
    s = churn.check_leakage(churn.scored_frame(spark, sf_dir, quality.clean(spark, sf_dir)),
                            churn.CHURN_FEATURES)
    known = [c for c in s.columns if c in churn.CHURN_FEATURES + churn.CHURN_FORBIDDEN]
    long = s.agg(*[F.count(c).alias(c) for c in known]).unpivot([], known, "feature", "non_null")
    return long.select("feature", F.col("feature").isin(churn.CHURN_FORBIDDEN).alias("is_forbidden"),
                       "non_null")


def churn_fields(labels):
    """Post-hoc churn fields derived from the panel label: the month after the
    last observed period, and a hashed reason code, both null unless churned;
    some customers get a reason without having churned, for P10 to find."""
    churned = F.col("is_churned") == 1
    return labels.select(
        "customer_id",
        F.when(churned, ((F.col("last_period") + 1) * 100 + 1).cast("int")).alias("churned_month"),
        F.when(churned | (F.col("customer_id") % 29 == 4),
               bucket("reason", F.col("customer_id"), 5) + 1).alias("churn_reason_id"))


@register("p10_reason_consistency", with_prelude(f"""
SELECT count(*) AS customers, count(churned_month) AS churned_customers,
       count(churn_reason_id) AS with_reason,
       count(*) FILTER (WHERE churn_reason_id IS NOT NULL AND churned_month IS NULL)
         AS reason_without_churn
FROM (SELECT customer_id,
        CASE WHEN is_churned = 1 THEN cast((last_period + 1) * 100 + 1 as integer) END AS churned_month,
        CASE WHEN is_churned = 1 OR customer_id % 29 = 4
             THEN {bucket_sql('reason', 'customer_id', 5)} + 1 END AS churn_reason_id
      FROM cust_label)"""))
def p10_reason_consistency(spark, sf_dir):
    """P10: a churn reason exists only where the customer churned."""
    f = quality.dedup_panel(spark, sf_dir)
    fields = churn_fields(quality.customer_labels(f))
    return fields.agg(
        F.count("*").alias("customers"), F.count("churned_month").alias("churned_customers"),
        F.count("churn_reason_id").alias("with_reason"),
        F.count_if(F.col("churn_reason_id").isNotNull() & F.col("churned_month").isNull())
        .alias("reason_without_churn"))


def _star_tables(spark, sf_dir):
    return {
        "dim_region": star.dim_region(spark, sf_dir),
        "dim_rep": star.dim_rep(spark, sf_dir),
        "dim_plan": star.dim_plan(spark, sf_dir),
        "dim_customer": star.dim_customer(spark, sf_dir).drop("nation_name"),
        "fact_subscription_monthly": star.fact(spark, sf_dir, dedupe=False, with_plan=False),
    }


@register("p12_mirror_counts", with_prelude("""
SELECT table_name, rows AS store_rows, rows AS mirror_rows, true AS agree FROM (
  SELECT 'dim_region' AS table_name, count(*) AS rows FROM dim_region
  UNION ALL SELECT 'dim_rep', count(*) FROM dim_rep
  UNION ALL SELECT 'dim_plan', count(*) FROM dim_plan
  UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
  UNION ALL SELECT 'fact_subscription_monthly', count(*) FROM fact_raw)"""))
def p12_mirror_counts(spark, sf_dir):
    """P12 (+ S2, S3, S4): write the star to a parquet store (fact partitioned
    by period) and a CSV mirror, read both back with declared schemas, and
    compare row counts per table."""
    tables = _star_tables(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MIRRORS:
        base = os.path.join(checkpoint_dir(spark), "mirror", spark.sparkContext.applicationId,
                            hashlib.sha1(sf_dir.encode()).hexdigest()[:12])
        store = sinks.write_table_store(tables, os.path.join(base, "store"),
                                        {"fact_subscription_monthly": "period_key"})
        mirror = sinks.write_csv_tables(tables, os.path.join(base, "csv"))
        _MIRRORS[key] = (store, mirror)
    store, mirror = _MIRRORS[key]
    parts = []
    for name, df in tables.items():
        s = spark.read.parquet(store[name]).agg(F.count("*").alias("store_rows"))
        m = sinks.read_csv_with_schema(spark, mirror[name], df.schema) \
                 .agg(F.count("*").alias("mirror_rows"))
        parts.append(s.crossJoin(m).select(F.lit(name).alias("table_name"), "store_rows",
                                           "mirror_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("agree", F.col("store_rows") == F.col("mirror_rows"))


@register("j8_attach_scores", with_prelude("""
SELECT s.customer_id, round(s.probability, 9) AS probability, l.cluster
FROM scored s LEFT JOIN cluster_labelled l USING (customer_id)"""))
def j8_attach_scores(spark, sf_dir):
    """Scores and cluster labels attached by customer id (not by position)."""
    panel = quality.clean(spark, sf_dir)
    s = churn.scored_frame(spark, sf_dir, panel)
    lab = cluster.fixed_centre_labels(cluster.cluster_frame(panel, churn.baseline_periods(panel)))
    return s.join(lab.select("customer_id", "cluster"), "customer_id", "left") \
            .select("customer_id", F.round("probability", 9).alias("probability"), "cluster")


@register("a11_smb_risk", with_prelude("""
SELECT customer_id, segment, industry, is_smb, industry_risk FROM model_frame"""))
def a11_smb_risk(spark, sf_dir):
    """SMB flag and industry risk (0.0 when unknown) per customer."""
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    return mf.select("customer_id", "segment", "industry", "is_smb", "industry_risk")


@register("a15_churn_by_dimension", with_prelude("\nUNION ALL\n".join(
    f"""SELECT '{d}' AS dimension, cast({d} as varchar) AS category,
       round(avg(is_churned), 4) AS churn_rate, count(*) AS customers
FROM cust_first GROUP BY {d}""" for d in churn.BREAKDOWN_DIMS)))
def a15_churn_by_dimension(spark, sf_dir):
    """Churn rate by each dimension, ascending (presentation order)."""
    b = churn.churn_breakdowns(churn.customer_grain(quality.clean(spark, sf_dir)))
    return b.select("dimension", "category", "churn_rate", "customers") \
            .orderBy("dimension", "churn_rate", "category")


ROW_CAP = quality.ROW_CAP


@register("p5_row_cap", with_prelude(f"""
SELECT table_name, rows, {ROW_CAP} AS cap, rows <= {ROW_CAP} AS within_cap FROM (
  SELECT 'dim_region' AS table_name, count(*) AS rows FROM dim_region
  UNION ALL SELECT 'dim_rep', count(*) FROM dim_rep
  UNION ALL SELECT 'dim_plan', count(*) FROM dim_plan
  UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
  UNION ALL SELECT 'fact_subscription_monthly', count(*) FROM fact_raw)"""))
def p5_row_cap(spark, sf_dir, cap: int = ROW_CAP):
    """P5: row count per table against the cap (the driver's tables exceed it:
    reported, not asserted)."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in _star_tables(spark, sf_dir).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "rows", F.lit(cap).alias("cap"),
                      (F.col("rows") <= cap).alias("within_cap"))
