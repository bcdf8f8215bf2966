"""Registered score/threshold, rank, set and scalar queries.

Scores are the fixture's fixed-coefficient probabilities (F3) with the
exact-N label (W3), so every threshold/AUC metric is value-checked without a
fitted model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import clip, parse_mixed_date, risk_band, slug
from ..operators import churn, quality, threshold
from ..operators.rank import average_rank
from ..sources import star
from .oracle import with_prelude
from .registry import register

_GRID_SQL = "SELECT k / 100.0 AS threshold FROM range(10, 91, 5) t(k)"
_SWEEP_SQL = """SELECT round(threshold, 2) AS threshold, tp, fp, fn, tn,
       CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0.0 END AS precision,
       CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0.0 END AS recall,
       cast(fn * 5000 + fp * 50 as bigint) AS expected_cost
FROM (SELECT g.threshold,
        count(*) FILTER (WHERE s.probability >= g.threshold AND s.label = 1) AS tp,
        count(*) FILTER (WHERE s.probability >= g.threshold AND s.label = 0) AS fp,
        count(*) FILTER (WHERE s.probability < g.threshold AND s.label = 1) AS fn,
        count(*) FILTER (WHERE s.probability < g.threshold AND s.label = 0) AS tn
      FROM grid g CROSS JOIN scored s GROUP BY g.threshold)"""
_SWEEP_CTES = [("grid", _GRID_SQL), ("sweep", _SWEEP_SQL)]


def _scored(spark, sf_dir):
    return churn.scored_frame(spark, sf_dir, quality.clean(spark, sf_dir))


@register("m10_threshold_sweep", with_prelude("SELECT * FROM sweep", _SWEEP_CTES))
def m10_threshold_sweep(spark, sf_dir):
    return threshold.threshold_sweep(_scored(spark, sf_dir))


@register("m11_optimal_threshold", with_prelude("""
SELECT b.threshold AS best_threshold, b.expected_cost AS best_cost, b.recall AS best_recall,
       d.expected_cost AS default_cost, d.recall AS default_recall,
       d.expected_cost - b.expected_cost AS saving
FROM (SELECT * FROM sweep ORDER BY expected_cost, threshold LIMIT 1) b,
     (SELECT * FROM sweep WHERE threshold = 0.5) d""", _SWEEP_CTES))
def m11_optimal_threshold(spark, sf_dir):
    return threshold.optimal_threshold(threshold.threshold_sweep(_scored(spark, sf_dir)))


@register("w6_argmin", with_prelude("""
SELECT threshold, expected_cost FROM sweep ORDER BY expected_cost, threshold LIMIT 1""",
                                    _SWEEP_CTES))
def w6_argmin(spark, sf_dir):
    """Arg-min row of the cost curve, first threshold on ties."""
    sw = threshold.threshold_sweep(_scored(spark, sf_dir))
    best = sw.agg(F.min_by(F.struct("threshold", "expected_cost"),
                           F.struct("expected_cost", "threshold")).alias("b"))
    return best.select("b.threshold", "b.expected_cost")


@register("m12_confusion", with_prelude("""
SELECT * FROM sweep WHERE threshold IN (0.2, 0.5)""", _SWEEP_CTES))
def m12_confusion(spark, sf_dir):
    """The slider's confusion matrix, here at 0.20 and 0.50."""
    s = _scored(spark, sf_dir)
    return threshold.confusion_at(s, 0.2).unionByName(threshold.confusion_at(s, 0.5))


@register("m9_auc_roc", with_prelude("""
SELECT r, round(score, 9) AS score, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr,
       round(auc, 9) AS auc
FROM (SELECT *, sum(n_pos * (N - fp_cum + n_neg / 2.0)) OVER () / (P * N) AS auc
      FROM (SELECT *, row_number() OVER (ORDER BY score DESC) AS r,
              sum(n_pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) * 1.0 / P AS tpr,
              sum(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) * 1.0 / N AS fpr,
              sum(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp_cum
            FROM (SELECT probability AS score, count(*) FILTER (WHERE label = 1) AS n_pos,
                         count(*) FILTER (WHERE label = 0) AS n_neg FROM scored GROUP BY probability),
                 (SELECT sum(label) AS P, count(*) - sum(label) AS N FROM scored)))
UNION ALL SELECT 0, NULL, 0.0, 0.0, round(max(auc), 9)
FROM (SELECT sum(n_pos * (N - fp_cum + n_neg / 2.0)) OVER () / (P * N) AS auc
      FROM (SELECT *, sum(n_neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp_cum
            FROM (SELECT probability AS score, count(*) FILTER (WHERE label = 1) AS n_pos,
                         count(*) FILTER (WHERE label = 0) AS n_neg FROM scored GROUP BY probability),
                 (SELECT sum(label) AS P, count(*) - sum(label) AS N FROM scored)))"""))
def m9_auc_roc(spark, sf_dir):
    roc = threshold.roc_auc(_scored(spark, sf_dir))
    return roc.select("r", *[F.round(c, 9).alias(c) for c in ("score", "tpr", "fpr", "auc")])


@register("m7_baselines", with_prelude("""
SELECT count(*) AS customers,
       greatest(sum(label), count(*) - sum(label)) * 1.0 / count(*) AS majority_accuracy,
       sum(label) * 1.0 / count(*) AS base_rate, cast(0.5 as double) AS chance_auc FROM scored"""))
def m7_baselines(spark, sf_dir):
    return threshold.baselines(_scored(spark, sf_dir))


@register("w4_call_list", with_prelude("""
SELECT customer_id, round(probability, 9) AS probability FROM scored
WHERE probability >= 0.5 ORDER BY probability DESC, customer_id LIMIT 25"""))
def w4_call_list(spark, sf_dir):
    top = threshold.call_list(_scored(spark, sf_dir), 0.5)
    return top.select("customer_id", F.round("probability", 9).alias("probability"))


@register("f6_risk_band", with_prelude("""
SELECT CASE WHEN probability >= 0.6 THEN 'High' WHEN probability >= 0.3 THEN 'Medium'
            ELSE 'Low' END AS risk_band,
       count(*) AS customers, round(sum(mrr), 2) AS mrr
FROM scored GROUP BY 1"""))
def f6_risk_band(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("risk_band", risk_band("probability"))
    return s.groupBy("risk_band").agg(F.count("*").alias("customers"),
                                      F.round(F.sum("mrr"), 2).alias("mrr"))


@register("w7_avg_rank", with_prelude("""
SELECT customer_id, round(support_tickets, 9) AS support_tickets,
       count(*) OVER (ORDER BY support_tickets RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         - (count(*) OVER (PARTITION BY support_tickets) - 1) / 2.0 AS support_tickets_rank
FROM model_frame"""))
def w7_avg_rank(spark, sf_dir):
    """Tie-averaged rank (pandas ``method='average'``) of a tied feature."""
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    r = average_rank(mf.select("customer_id", "support_tickets"), "support_tickets")
    return r.select("customer_id", F.round("support_tickets", 9).alias("support_tickets"),
                    "support_tickets_rank")


@register("f12_zscore", with_prelude("""
SELECT customer_id,
  round((usage_per_seat - avg(usage_per_seat) OVER ()) / coalesce(nullif(stddev_pop(usage_per_seat) OVER (), 0), 1), 9) AS z_usage_per_seat,
  round((support_tickets - avg(support_tickets) OVER ()) / coalesce(nullif(stddev_pop(support_tickets) OVER (), 0), 1), 9) AS z_support_tickets,
  round((discount_pct - avg(discount_pct) OVER ()) / coalesce(nullif(stddev_pop(discount_pct) OVER (), 0), 1), 9) AS z_discount_pct,
  round((seats - avg(seats) OVER ()) / coalesce(nullif(stddev_pop(seats) OVER (), 0), 1), 9) AS z_seats,
  round((nps_score - avg(nps_score) OVER ()) / coalesce(nullif(stddev_pop(nps_score) OVER (), 0), 1), 9) AS z_nps_score,
  round((mrr - avg(mrr) OVER ()) / coalesce(nullif(stddev_pop(mrr) OVER (), 0), 1), 9) AS z_mrr
FROM model_frame"""))
def f12_zscore(spark, sf_dir):
    """population z-scores with a zero-std guard; the means/stds are one
    1-row aggregate broadcast back (no global window)."""
    from ..operators.stats import standardize
    mf = churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))
    cols = ["usage_per_seat", "support_tickets", "discount_pct", "seats", "nps_score", "mrr"]
    z = standardize(mf, cols, ddof=0, prefix="z_")
    return z.select("customer_id", *[F.round(f"z_{c}", 9).alias(f"z_{c}") for c in cols])


@register("f4_clip", with_prelude("""
SELECT count(*) FILTER (WHERE usage_per_seat < 12.0) AS clipped_low,
       count(*) FILTER (WHERE usage_per_seat > 18.0) AS clipped_high,
       round(sum(least(greatest(usage_per_seat, 12.0), 18.0)), 6) AS clipped_total
FROM clean"""))
def f4_clip(spark, sf_dir):
    c = quality.clean(spark, sf_dir, label=False)
    u = F.col("usage_per_seat")
    return c.agg(F.count_if(u < 12.0).alias("clipped_low"), F.count_if(u > 18.0).alias("clipped_high"),
                 F.round(F.sum(clip(u, 12.0, 18.0)), 6).alias("clipped_total"))


@register("f5_slug", with_prelude("""
SELECT customer_id,
       regexp_replace(regexp_replace(lower(strip_accents(company_name)), '[^a-z0-9]+', '-', 'g'),
                      '^-+|-+$', '', 'g') AS company_slug,
       regexp_replace(regexp_replace(lower(strip_accents(nation_name)), '[^a-z0-9]+', '-', 'g'),
                      '^-+|-+$', '', 'g') AS nation_slug
FROM dim_customer"""))
def f5_slug(spark, sf_dir):
    c = star.dim_customer(spark, sf_dir)
    return c.select("customer_id", slug("company_name").alias("company_slug"),
                    slug("nation_name").alias("nation_slug"))


@register("f9_date_reformat", with_prelude("""
SELECT customer_id,
  strftime(CASE WHEN regexp_matches(signup_date, '^\\d{4}-\\d{2}-\\d{2}$')
         THEN try_strptime(signup_date, '%Y-%m-%d')::date
       WHEN regexp_matches(signup_date, '^\\d{2}/\\d{2}/\\d{4}$')
         THEN try_strptime(signup_date, '%d/%m/%Y')::date END, '%d/%m/%Y') AS signup_day_first
FROM dim_customer"""))
def f9_date_reformat(spark, sf_dir):
    c = star.dim_customer(spark, sf_dir)
    return c.select("customer_id",
                    F.date_format(parse_mixed_date("signup_date"), "dd/MM/yyyy").alias("signup_day_first"))


@register("u1_union_append", with_prelude("""
SELECT part, count(*) AS rows, count(DISTINCT customer_id) AS customers FROM (
  SELECT 'baseline' AS part, customer_id FROM fact
    WHERE period_key IN (SELECT period_key FROM baseline_periods)
  UNION ALL
  SELECT 'later', customer_id FROM fact
    WHERE period_key NOT IN (SELECT period_key FROM baseline_periods))
GROUP BY part"""))
def u1_union_append(spark, sf_dir):
    """Append two slices of the fact (baseline window and the rest) and
    count per slice; the parts add up to the whole."""
    f = quality.dedup_panel(spark, sf_dir)
    periods = churn.baseline_periods(f)
    inside = f.where(F.col("period_key").isin(periods)).select(F.lit("baseline").alias("part"), "customer_id")
    outside = f.where(~F.col("period_key").isin(periods)).select(F.lit("later").alias("part"), "customer_id")
    return inside.unionByName(outside).groupBy("part").agg(
        F.count("*").alias("rows"), F.countDistinct("customer_id").alias("customers"))
