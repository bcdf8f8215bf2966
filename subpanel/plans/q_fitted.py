"""The payload on fitted results: out-of-fold scores and best-k k-means labels.

The same operators as in ``q_scores`` and ``q_cluster``, which check them by
value on deterministic inputs; here they run on what the models say, as the
report needs it. Both frames are written once per session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import risk_band
from ..operators import churn, cluster, models, quality, threshold
from ..session import materialized
from .registry import register


def oof_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored customer frame with each customer's out-of-fold probability."""
    def build():
        scored = churn.scored_frame(spark, sf_dir, quality.clean(spark, sf_dir))
        oof = models.out_of_fold(scored.select("customer_id", "label", *churn.CHURN_FEATURES),
                                 churn.CHURN_FEATURES, "label")
        return scored.drop("probability", "logit").join(oof.select(
            "customer_id", F.col("oof_probability").alias("probability")), "customer_id")
    return materialized(spark, sf_dir, "oof_scored", build)


def best_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster frame labelled by the k-means model of the best k."""
    def build():
        panel = quality.clean(spark, sf_dir)
        return cluster.best_k_labels(cluster.cluster_frame(panel, churn.baseline_periods(panel)))
    return materialized(spark, sf_dir, "best_k_labels", build)


@register("m10_sweep_fitted")
def m10_sweep_fitted(spark, sf_dir):
    return threshold.threshold_sweep(oof_scored(spark, sf_dir))


@register("m11_optimal_fitted")
def m11_optimal_fitted(spark, sf_dir):
    return threshold.optimal_threshold(threshold.threshold_sweep(oof_scored(spark, sf_dir)))


@register("m12_confusion_fitted")
def m12_confusion_fitted(spark, sf_dir):
    s = oof_scored(spark, sf_dir)
    return threshold.confusion_at(s, 0.2).unionByName(threshold.confusion_at(s, 0.5))


@register("m9_roc_fitted")
def m9_roc_fitted(spark, sf_dir):
    return threshold.roc_auc(oof_scored(spark, sf_dir))


@register("w4_call_list_fitted")
def w4_call_list_fitted(spark, sf_dir):
    return threshold.call_list(oof_scored(spark, sf_dir), 0.5).select("customer_id", "probability")


@register("m16_risk_table_fitted")
def m16_risk_table_fitted(spark, sf_dir):
    """The customer risk table on out-of-fold scores and best-k labels, riskiest first."""
    j = oof_scored(spark, sf_dir).join(
        best_labels(spark, sf_dir).select("customer_id", "cluster"), "customer_id", "left")
    return j.orderBy(F.col("probability").desc(), F.col("customer_id")).select(
        "customer_id", F.col("company_name").alias("company"), "segment", "industry",
        F.col("region_name").alias("region"), F.round("seats", 1).alias("seats"),
        F.round("mrr", 2).alias("mrr"), F.round("usage_per_seat", 2).alias("usage_per_seat"),
        F.round("nps_score", 1).alias("nps_score"), F.round("discount_pct", 6).alias("discount_pct"),
        F.round("probability", 4).alias("churn_probability"),
        risk_band("probability").alias("risk_band"), F.col("label").alias("actual_churn"), "cluster")


@register("a18_profiles_fitted")
def a18_profiles_fitted(spark, sf_dir):
    return cluster.profiles(best_labels(spark, sf_dir))


@register("a19_crosstab_fitted")
def a19_crosstab_fitted(spark, sf_dir):
    return cluster.crosstab(best_labels(spark, sf_dir))


@register("g11_profile_z_fitted")
def g11_profile_z_fitted(spark, sf_dir):
    return cluster.profile_z(cluster.profiles(best_labels(spark, sf_dir)))
