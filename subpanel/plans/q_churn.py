"""Registered churn / customer-grain queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import u, u_sql
from ..operators import churn, quality
from ..sources import star
from .oracle import wilson_sql, with_prelude
from .registry import register

_LOW, _HIGH = wilson_sql("sum(is_churned)", "count(*)")


def _breakdown_sql(dim: str) -> str:
    return f"""SELECT '{dim}' AS dimension, cast({dim} as varchar) AS category,
       count(*) AS customers, cast(sum(is_churned) as bigint) AS churned,
       round(sum(is_churned) * 1.0 / count(*), 4) AS churn_rate,
       round({_LOW}, 4) AS ci_low, round({_HIGH}, 4) AS ci_high,
       NOT ({_LOW} <= (SELECT avg(is_churned) FROM cust_first)
            AND (SELECT avg(is_churned) FROM cust_first) <= {_HIGH}) AS differs_from_overall,
       round((SELECT avg(is_churned) FROM cust_first), 4) AS overall_churn_rate
FROM cust_first GROUP BY {dim}"""


@register("a7_a8_churn_wilson", with_prelude(
    "SELECT *, count(*) OVER () AS categories_examined, "
    "cast(sum(cast(differs_from_overall as integer)) OVER () as bigint) AS categories_differing "
    "FROM (" + "\nUNION ALL\n".join(_breakdown_sql(d) for d in churn.BREAKDOWN_DIMS) + ")"))
def a7_a8_churn_wilson(spark, sf_dir):
    customers = churn.customer_grain(quality.clean(spark, sf_dir))
    return churn.churn_breakdowns(customers)


@register("a9_customer_first_row", with_prelude("""
SELECT customer_id, segment, industry, region_name, is_annual_contract, company_name,
       primary_ticket_topic, is_churned FROM cust_first"""))
def a9_customer_first_row(spark, sf_dir):
    return churn.customer_grain(quality.clean(spark, sf_dir))


@register("a10_baseline_features", with_prelude("""
SELECT customer_id, round(usage_per_seat, 6) AS usage_per_seat,
       round(support_tickets, 6) AS support_tickets, round(discount_pct, 6) AS discount_pct,
       round(seats, 6) AS seats, round(nps_score, 6) AS nps_score, round(mrr, 4) AS mrr,
       is_annual_contract, segment, industry, region_name, is_churned,
       industry_risk, is_smb FROM model_frame"""))
def a10_baseline_features(spark, sf_dir):
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    return mf.select("customer_id", *[F.round(c, 6).alias(c) for c in
                                      ["usage_per_seat", "support_tickets", "discount_pct",
                                       "seats", "nps_score"]],
                     F.round("mrr", 4).alias("mrr"), "is_annual_contract", "segment", "industry",
                     "region_name", "is_churned", "industry_risk", "is_smb")


@register("a12_topics", with_prelude("""
SELECT primary_ticket_topic, count(*) AS overall_count,
       count(*) FILTER (WHERE is_churned = 1) AS churned_count,
       count(*) FILTER (WHERE is_churned = 0) AS retained_count,
       count(*) OVER () AS distinct_topics
FROM clean_lab GROUP BY primary_ticket_topic"""))
def a12_topics(spark, sf_dir):
    return churn.topic_counts(quality.clean(spark, sf_dir))


@register("a16_churn_by_topic", with_prelude("""
SELECT primary_ticket_topic, round(avg(is_churned), 4) AS churn_rate, count(*) AS customers
FROM cust_first GROUP BY primary_ticket_topic HAVING count(*) >= 5"""))
def a16_churn_by_topic(spark, sf_dir):
    return churn.churn_by_topic(churn.customer_grain(quality.clean(spark, sf_dir)))


@register("a17_split", with_prelude("""
SELECT count(*) FILTER (WHERE is_churned = 1) AS churned_customers,
       count(*) FILTER (WHERE is_churned = 0) AS retained_customers,
       round(avg(is_churned), 4) AS overall_churn_rate FROM cust_first"""))
def a17_split(spark, sf_dir):
    return churn.split_counts(churn.customer_grain(quality.clean(spark, sf_dir)))


@register("a20_mean_separation", with_prelude("""
SELECT is_churned, count(*) AS customers, round(avg(usage_per_seat), 6) AS mean_usage_per_seat,
       round(avg(nps_score), 6) AS mean_nps FROM model_frame GROUP BY is_churned"""))
def a20_mean_separation(spark, sf_dir):
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    return mf.groupBy("is_churned").agg(
        F.count("*").alias("customers"), F.round(F.avg("usage_per_seat"), 6).alias("mean_usage_per_seat"),
        F.round(F.avg("nps_score"), 6).alias("mean_nps"))


@register("a21_customer_totals", with_prelude("""
SELECT customer_id, round(avg(usage_per_seat), 9) AS mean_usage_per_seat,
       cast(sum(support_tickets) as bigint) AS total_tickets,
       round(avg(discount_pct), 9) AS mean_discount, round(avg(nps_score), 9) AS mean_nps,
       count(DISTINCT date_key) AS months_active
FROM clean GROUP BY customer_id"""))
def a21_customer_totals(spark, sf_dir):
    t = churn.customer_totals(quality.clean(spark, sf_dir, label=False))
    return t.select("customer_id", F.round("mean_usage_per_seat", 9).alias("mean_usage_per_seat"),
                    "total_tickets", F.round("mean_discount", 9).alias("mean_discount"),
                    F.round("mean_nps", 9).alias("mean_nps"), "months_active")


def _scored(spark, sf_dir):
    return churn.scored_frame(spark, sf_dir, quality.clean(spark, sf_dir))


@register("f3_logistic_score", with_prelude("""
SELECT customer_id, round(logit, 6) AS logit, round(probability, 6) AS probability FROM scored"""))
def f3_logistic_score(spark, sf_dir):
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    s = churn.fixture_logit(mf)
    return s.select("customer_id", F.round("logit", 6).alias("logit"),
                    F.round(1.0 / (1.0 + F.exp(-F.col("logit"))), 6).alias("probability"))


@register("w3_exact_n_label", with_prelude("""
SELECT count(*) AS customers, cast(sum(label) as bigint) AS positives,
       cast(sum(CASE WHEN label = 1 THEN customer_id ELSE 0 END) as bigint) AS positive_id_sum,
       round(sum(logit), 6) AS logit_sum FROM scored"""))
def w3_exact_n_label(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.agg(F.count("*").alias("customers"), F.sum("label").alias("positives"),
                 F.sum(F.when(F.col("label") == 1, F.col("customer_id")).otherwise(0))
                 .alias("positive_id_sum"),
                 F.round(F.sum("logit"), 6).alias("logit_sum"))


@register("a22_revenue_at_risk", with_prelude("""
SELECT round(coalesce(sum(mrr), 0.0), 2) AS revenue_at_risk, count(*) AS high_risk_customers
FROM scored WHERE probability >= 0.6"""))
def a22_revenue_at_risk(spark, sf_dir):
    return churn.revenue_at_risk(_scored(spark, sf_dir))


@register("j2_left_features", with_prelude("""
SELECT c.customer_id, c.segment, m.usage_per_seat IS NOT NULL AS has_baseline,
       round(m.usage_per_seat, 6) AS usage_per_seat
FROM dim_customer c LEFT JOIN model_frame m USING (customer_id)"""))
def j2_left_features(spark, sf_dir):
    """Every customer kept, baseline features where present."""
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    c = star.dim_customer(spark, sf_dir).select("customer_id", "segment")
    j = c.join(mf.select("customer_id", "usage_per_seat"), "customer_id", "left")
    return j.select("customer_id", "segment", F.col("usage_per_seat").isNotNull().alias("has_baseline"),
                    F.round("usage_per_seat", 6).alias("usage_per_seat"))


@register("j3_inner_features", with_prelude("""
SELECT c.customer_id, c.segment, round(m.nps_score, 6) AS nps_score
FROM dim_customer c JOIN model_frame m USING (customer_id)"""))
def j3_inner_features(spark, sf_dir):
    """Customers without baseline rows are dropped."""
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    c = star.dim_customer(spark, sf_dir).select("customer_id", "segment")
    return c.join(mf.select("customer_id", "nps_score"), "customer_id") \
            .select("customer_id", "segment", F.round("nps_score", 6).alias("nps_score"))


@register("j4_industry_risk", with_prelude("""
SELECT c.customer_id, c.industry, ir.industry_risk AS industry_risk_raw,
       coalesce(ir.industry_risk, 0.0) AS industry_risk
FROM dim_customer c LEFT JOIN industry_risk ir USING (industry)"""))
def j4_industry_risk(spark, sf_dir):
    """Lookup join; unmatched → null (raw) and 0.0 (model frame)."""
    c = star.dim_customer(spark, sf_dir).select("customer_id", "industry")
    r = star.industry_risk(spark, sf_dir)
    j = c.join(F.broadcast(r), "industry", "left")
    return j.select("customer_id", "industry", F.col("industry_risk").alias("industry_risk_raw"),
                    F.coalesce("industry_risk", F.lit(0.0)).alias("industry_risk"))


@register("j5_fk_semi_anti", with_prelude("""
SELECT (SELECT count(*) FROM dim_customer SEMI JOIN fact USING (customer_id)) AS customers_with_facts,
       (SELECT count(*) FROM dim_customer ANTI JOIN fact USING (customer_id)) AS customers_without_facts,
       (SELECT count(*) FROM dim_plan SEMI JOIN fact USING (plan_id)) AS plans_used"""))
def j5_fk_semi_anti(spark, sf_dir):
    f = quality.dedup_panel(spark, sf_dir)
    c = star.dim_customer(spark, sf_dir).select("customer_id")
    p = star.dim_plan(spark, sf_dir).select("plan_id")
    # keys of the fact once each (combined before the exchange), one join tells both kinds of customers
    seen = f.select("customer_id").distinct().withColumn("_seen", F.lit(True))
    customers = c.join(seen, "customer_id", "left").agg(
        F.count("_seen").alias("customers_with_facts"),
        F.count_if(F.col("_seen").isNull()).alias("customers_without_facts"))
    plans = p.join(f.select("plan_id").distinct(), "plan_id", "left_semi").agg(F.count("*").alias("plans_used"))
    return customers.crossJoin(plans)


@register("j7_churn_label", with_prelude("""
SELECT customer_id, last_period, is_churned FROM cust_label"""))
def j7_churn_label(spark, sf_dir):
    f = quality.dedup_panel(spark, sf_dir)
    return quality.customer_labels(f)


def _cutoffs(scored):
    # positives stop being observed in a hashed period after the baseline window
    return scored.where(F.col("label") == 1).select(
        "customer_id",
        (F.lit(1997) + F.floor(u("t", F.col("customer_id")) * 4)).cast("int").alias("cutoff_period"))


@register("j6_cutoff", with_prelude(f"""
SELECT count(*) AS rows_kept, count(DISTINCT customer_id) AS customers,
       max(period_key) AS max_period
FROM clean c LEFT JOIN (SELECT customer_id,
        cast(1997 + floor({u_sql('t', 'customer_id')} * 4) as integer)
        AS cutoff_period FROM scored WHERE label = 1) k USING (customer_id)
WHERE coalesce(c.period_key < k.cutoff_period, true)"""))
def j6_cutoff(spark, sf_dir):
    panel = quality.clean(spark, sf_dir, label=False)
    kept = churn.truncate_at_cutoff(panel, _cutoffs(_scored(spark, sf_dir)))
    return kept.agg(F.count("*").alias("rows_kept"), F.countDistinct("customer_id").alias("customers"),
                    F.max("period_key").alias("max_period"))


@register("score_label_truncate", with_prelude(f"""
SELECT customer_id, label, round(avg(usage_per_seat), 9) AS mean_usage_per_seat,
       cast(sum(support_tickets) as bigint) AS total_tickets,
       round(avg(discount_pct), 9) AS mean_discount, round(avg(nps_score), 9) AS mean_nps,
       count(DISTINCT date_key) AS months_active
FROM (SELECT c.*, s.label FROM clean c JOIN scored s USING (customer_id)
      LEFT JOIN (SELECT customer_id,
        cast(1997 + floor({u_sql('t', 'customer_id')} * 4) as integer)
        AS cutoff_period FROM scored WHERE label = 1) k USING (customer_id)
      WHERE coalesce(c.period_key < k.cutoff_period, true))
GROUP BY customer_id, label"""))
def score_label_truncate(spark, sf_dir):
    """F3+F2 score → W3 exact-N label → J6 truncate → A21 aggregate."""
    panel = quality.clean(spark, sf_dir, label=False)
    scored = _scored(spark, sf_dir)
    kept = churn.truncate_at_cutoff(panel, _cutoffs(scored))
    kept = kept.join(scored.select("customer_id", "label"), "customer_id")
    t = kept.groupBy("customer_id", "label").agg(
        F.avg("usage_per_seat").alias("m_u"), F.sum("support_tickets").alias("total_tickets"),
        F.avg("discount_pct").alias("m_d"), F.avg("nps_score").alias("m_n"),
        F.countDistinct("date_key").alias("months_active"))
    return t.select("customer_id", "label", F.round("m_u", 9).alias("mean_usage_per_seat"),
                    "total_tickets", F.round("m_d", 9).alias("mean_discount"),
                    F.round("m_n", 9).alias("mean_nps"), "months_active")
