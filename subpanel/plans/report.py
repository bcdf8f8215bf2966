"""Result sections (S5, §2.11): the numbers behind each figure and payload
section, as named DataFrames, written as one JSON directory per section.

Each section is a registered query, so the report is exactly what the
oracle-checked queries return; nothing is assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import write_results
from .registry import load_all

# section name → registered query (figure data and payload sections)
SECTIONS = {
    "repairs": "c9_repair_log",
    "invoice_reconciliation": "a24_reconcile",
    "revenue_overview": "a4_revenue_overview",
    "fig01_mrr_trend": "a3_revenue_monthly",
    "fig02_mrr_by_segment": "a14_month_segment",
    "fig03_churn_by_dimension": "a15_churn_by_dimension",
    "fig04_distributions": "a5_distribution",
    "fig04_histograms": "t10_marked_histograms",
    "fig05_feature_correlations": "t1_spearman",
    "fig06_baseline_features": "a10_baseline_features",
    "fig06_medians": "fig06_medians",
    "fig07_churn_split": "a17_split",
    "fig08_topics": "a12_topics",
    "fig09_churn_by_topic": "a16_churn_by_topic",
    "fig10_mrr_identity": "t5_identity_r2",
    "fig10_points": "fig10_fitted_actual",
    "fig11_ols_coefficients": "t4_ols",
    "fig12_residuals": "t8_residuals",
    "fig12_residual_skew": "t8_residual_skew",
    "fig12_qq": "t9_qq",
    "fig12_histogram": "t10_histogram",
    "fig13_regressors": "m14_regressors",
    "fig14_roc": "m9_roc_fitted",
    "fig15_thresholds": "m10_sweep_fitted",
    "fig16_confusion": "m12_confusion_fitted",
    "fig17_importance": "m13_permutation_fitted",
    "fig18_logit": "t7_logit_compare",
    "fig19_cluster_search": "g2_g3_kmeans_search",
    "fig20_pca": "g8_pca",
    "fig20_points": "g8_points",
    "fig21_cluster_profiles": "g11_profile_z_fitted",
    "fig22_stability": "g7_stability",
    "concentration": "a6_concentration",
    "churn_breakdowns": "a7_a8_churn_wilson",
    "revenue_by_dimension": "a13_revenue_by_dim",
    "optimal_threshold": "m11_optimal_fitted",
    "model_comparison": "m6_model_comparison",
    "customers": "m16_risk_table_fitted",
    "call_list": "w4_call_list_fitted",
    "cluster_profiles": "a18_profiles_fitted",
    "cluster_vs_segment": "a19_crosstab_fitted",
    "quality_report": "s6_quality_report",
}


def sections(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    queries, _ = load_all()
    chosen = names or list(SECTIONS)
    return {n: queries[SECTIONS[n]](spark, sf_dir) for n in chosen}


def write_report(spark: SparkSession, sf_dir: str, out_dir: str, names=None) -> dict[str, str]:
    """Every section to ``out_dir/<section>`` as JSON part files."""
    return write_results(sections(spark, sf_dir, names), out_dir)
