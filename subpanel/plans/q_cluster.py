"""Registered clustering queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.scalar import (SILHOUETTE_BANDS, STABILITY_BANDS, UNSTABLE_VERDICT, risk_band,
                                silhouette_verdict, stability_verdict)
from ..operators import churn, cluster, lloyd, quality
from ..session import stored
from .oracle import with_prelude
from .registry import register

FEATS = cluster.CLUSTER_FEATURES


def _frame(spark, sf_dir):
    panel = quality.clean(spark, sf_dir)
    return cluster.cluster_frame(panel, churn.baseline_periods(panel))


def _labelled(spark, sf_dir):
    return cluster.fixed_centre_labels(_frame(spark, sf_dir))


@register("g1_cluster_frame", with_prelude(
    "SELECT customer_id, " + ", ".join(f"round(z_{c}, 9) AS z_{c}" for c in FEATS)
    + " FROM cluster_frame"))
def g1_cluster_frame(spark, sf_dir):
    f = _frame(spark, sf_dir)
    return f.select("customer_id", *[F.round(f"z_{c}", 9).alias(f"z_{c}") for c in FEATS])


_CENTROIDS = ("centroids", "SELECT cluster, count(*) AS n_c, "
              + ", ".join(f"avg(z_{c}) AS c_{c}, sum(z_{c}) AS s_{c}" for c in FEATS)
              + ", sum(" + " + ".join(f"z_{c} * z_{c}" for c in FEATS) + ") AS psi"
              + " FROM cluster_labelled GROUP BY cluster")
_OWN = ("own", "SELECT l.cluster, " + " + ".join(
    f"(l.z_{c} - c.c_{c}) * (l.z_{c} - c.c_{c})" for c in FEATS)
    + " AS d2 FROM cluster_labelled l JOIN centroids c USING (cluster)")
_OVERALL = ("overall", "SELECT " + ", ".join(f"avg(z_{c}) AS o_{c}" for c in FEATS)
            + " FROM cluster_labelled")
_SPREAD = ("spread", "SELECT cluster, sum(d2) AS w, avg(sqrt(d2)) AS s FROM own GROUP BY cluster")
_DB = ("db_terms", "SELECT a.cluster, max((sa.s + sb.s) / sqrt(" + " + ".join(
    f"(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})" for c in FEATS)
    + ")) AS worst FROM centroids a JOIN centroids b ON a.cluster <> b.cluster "
    "JOIN spread sa ON sa.cluster = a.cluster JOIN spread sb ON sb.cluster = b.cluster "
    "GROUP BY a.cluster")
_SIL_SUMS = ("sil_sums", "SELECT l.customer_id, l.cluster AS own_c, c.cluster AS other_c, c.n_c, "
             "c.n_c * (" + " + ".join(f"l.z_{f} * l.z_{f}" for f in FEATS) + ") - 2.0 * ("
             + " + ".join(f"l.z_{f} * c.s_{f}" for f in FEATS) + ") + c.psi AS sumsq "
             "FROM cluster_labelled l CROSS JOIN centroids c")
_SIL = ("sil", """SELECT customer_id,
      max(CASE WHEN other_c = own_c THEN n_c END) AS own_n,
      max(CASE WHEN other_c = own_c THEN sumsq / greatest(n_c - 1, 1) END) AS a,
      min(CASE WHEN other_c <> own_c THEN sumsq / n_c END) AS b
    FROM sil_sums GROUP BY customer_id""")


@register("g3_indices_fixed_centres", with_prelude("""
SELECT (SELECT count(*) FROM centroids) AS k, (SELECT count(*) FROM cluster_labelled) AS n,
       round((SELECT sum(w) FROM spread), 6) AS inertia,
       round((SELECT avg(worst) FROM db_terms), 6) AS davies_bouldin,
       round(((SELECT sum(n_c * (""" + " + ".join(
    f"(c_{c} - o_{c}) * (c_{c} - o_{c})" for c in FEATS) + """)) FROM centroids, overall)
              / ((SELECT count(*) FROM centroids) - 1))
             / ((SELECT sum(w) FROM spread) / ((SELECT count(*) FROM cluster_labelled)
                                               - (SELECT count(*) FROM centroids))), 6)
         AS calinski_harabasz,
       round((SELECT avg(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END) FROM sil), 6)
         AS silhouette_sq""", [_CENTROIDS, _OWN, _OVERALL, _SPREAD, _DB, _SIL_SUMS, _SIL]))
def g3_indices_fixed_centres(spark, sf_dir):
    """G3 given labels: indices of the deterministic fixed-centre labelling."""
    idx = cluster.label_indices(_labelled(spark, sf_dir))
    return idx.select(F.col("k").cast("long").alias("k"), "n",
                      *[F.round(c, 6).alias(c) for c in
                        ("inertia", "davies_bouldin", "calinski_harabasz", "silhouette_sq")])


@register("a18_profiles", with_prelude("""
SELECT p.cluster, p.size, round(p.churn_rate, 9) AS churn_rate, """ + ", ".join(
    f"round(p.mean_{c}, 9) AS mean_{c}" for c in FEATS) + """,
       d.segment AS dominant_segment, round(d.n * 1.0 / p.size, 9) AS purity
FROM (SELECT cluster, count(*) AS size, avg(is_churned) AS churn_rate, """ + ", ".join(
    f"avg({c}) AS mean_{c}" for c in FEATS) + """ FROM cluster_labelled GROUP BY cluster) p
JOIN (SELECT cluster, segment, n FROM (SELECT cluster, segment, count(*) AS n,
        row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, segment) AS rn_
      FROM cluster_labelled GROUP BY cluster, segment) WHERE rn_ = 1) d USING (cluster)"""))
def a18_profiles(spark, sf_dir):
    p = cluster.profiles(_labelled(spark, sf_dir))
    return p.select("cluster", "size", F.round("churn_rate", 9).alias("churn_rate"),
                    *[F.round(f"mean_{c}", 9).alias(f"mean_{c}") for c in FEATS],
                    "dominant_segment", F.round("purity", 9).alias("purity"))


@register("a19_crosstab", with_prelude("""
SELECT cluster, segment, count(*) AS customers,
       round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY cluster), 9) AS share
FROM cluster_labelled GROUP BY cluster, segment"""))
def a19_crosstab(spark, sf_dir):
    c = cluster.crosstab(_labelled(spark, sf_dir))
    return c.select("cluster", "segment", "customers", F.round("share", 9).alias("share"))


@register("g11_profile_z", with_prelude(
    "SELECT cluster, " + ", ".join(
        f"round((m_{c} - avg(m_{c}) OVER ()) / coalesce(nullif(stddev_pop(m_{c}) OVER (), 0), 1), 6)"
        f" AS z_mean_{c}" for c in FEATS)
    + " FROM (SELECT cluster, " + ", ".join(f"avg({c}) AS m_{c}" for c in FEATS)
    + " FROM cluster_labelled GROUP BY cluster)"))
def g11_profile_z(spark, sf_dir):
    z = cluster.profile_z(cluster.profiles(_labelled(spark, sf_dir)))
    return z.select("cluster", *[F.round(f"z_mean_{c}", 6).alias(f"z_mean_{c}") for c in FEATS])


@register("g12_scatter", with_prelude("""
SELECT customer_id, company_name, round(usage_per_seat, 9) AS usage_per_seat,
       round(nps_score, 9) AS nps_score, cluster FROM cluster_labelled"""))
def g12_scatter(spark, sf_dir):
    lab = _labelled(spark, sf_dir)
    return lab.select("customer_id", "company_name", F.round("usage_per_seat", 9).alias("usage_per_seat"),
                      F.round("nps_score", 9).alias("nps_score"), "cluster")


@register("u2_distinct_sorted", with_prelude(
    "SELECT DISTINCT cluster FROM cluster_labelled ORDER BY cluster"))
def u2_distinct_sorted(spark, sf_dir):
    return _labelled(spark, sf_dir).select("cluster").distinct().orderBy("cluster")


@register("g7_ari", with_prelude("""
SELECT CASE WHEN mx = expected THEN 1.0 ELSE round((idx - expected) / (mx - expected), 9) END AS ari
FROM (SELECT idx, sa * sb / (n * (n - 1) / 2.0) AS expected, (sa + sb) / 2.0 AS mx FROM
  (SELECT sum(nij * (nij - 1) / 2.0) AS idx, sum(nij) AS n FROM
     (SELECT cluster, segment, count(*) AS nij FROM cluster_labelled GROUP BY cluster, segment)),
  (SELECT sum(a * (a - 1) / 2.0) AS sa FROM (SELECT count(*) AS a FROM cluster_labelled GROUP BY cluster)),
  (SELECT sum(b * (b - 1) / 2.0) AS sb FROM (SELECT count(*) AS b FROM cluster_labelled GROUP BY segment)))"""))
def g7_ari(spark, sf_dir):
    """G7 given labels: ARI between the fixed-centre clusters and the segments."""
    a = cluster.ari(_labelled(spark, sf_dir), "cluster", "segment")
    return a.select(F.when(F.col("ari") == 1.0, F.col("ari")).otherwise(F.round("ari", 9)).alias("ari"))


@register("m16_risk_table", with_prelude("""
SELECT s.customer_id, s.company_name AS company, s.segment, s.industry, s.region_name AS region,
       round(s.seats, 1) AS seats, round(s.mrr, 2) AS mrr, round(s.usage_per_seat, 2) AS usage_per_seat,
       round(s.nps_score, 1) AS nps_score, round(s.discount_pct, 6) AS discount_pct,
       round(s.probability, 4) AS churn_probability,
       CASE WHEN s.probability >= 0.6 THEN 'High' WHEN s.probability >= 0.3 THEN 'Medium'
            ELSE 'Low' END AS risk_band,
       s.label AS actual_churn, l.cluster
FROM scored s LEFT JOIN cluster_labelled l USING (customer_id)"""))
def m16_risk_table(spark, sf_dir):
    """14-field customer risk table, riskiest first (distributed sort)."""
    panel = quality.clean(spark, sf_dir)
    scored = churn.scored_frame(spark, sf_dir, panel)
    lab = cluster.fixed_centre_labels(cluster.cluster_frame(panel, churn.baseline_periods(panel)))
    j = scored.join(lab.select("customer_id", "cluster"), "customer_id", "left")
    out = j.select(
        "customer_id", F.col("company_name").alias("company"), "segment", "industry",
        F.col("region_name").alias("region"), F.round("seats", 1).alias("seats"),
        F.round("mrr", 2).alias("mrr"), F.round("usage_per_seat", 2).alias("usage_per_seat"),
        F.round("nps_score", 1).alias("nps_score"), F.round("discount_pct", 6).alias("discount_pct"),
        F.round("probability", 4).alias("churn_probability"),
        risk_band("probability").alias("risk_band"), F.col("label").alias("actual_churn"), "cluster",
        F.col("probability").alias("_p"))
    return out.orderBy(F.col("_p").desc(), F.col("customer_id")).drop("_p")


@register("g2_lloyd_step", with_prelude("""
SELECT c.cid AS cluster, count(*) AS n, """ + ", ".join(f"round(avg(f.z_{c}), 6) AS c_{c}" for c in FEATS) + """,
       round(sum(sum(d.d)) OVER (), 6) AS inertia
FROM (SELECT customer_id, min(d) AS d FROM cluster_dists GROUP BY customer_id) d
JOIN cluster_labelled f USING (customer_id) JOIN centres c ON c.cid = f.cluster GROUP BY c.cid"""))
def g2_lloyd_step(spark, sf_dir):
    """One step of the many-model search from the fixed centres: new centres and inertia."""
    f = _frame(spark, sf_dir)
    n, sums, inertia = lloyd.step(f, cluster.Z_FEATURES, [np.array(cluster.fixed_centres(f))])[0]
    rows = [(i, int(c), *[round(float(v / c), 6) for v in s], round(inertia, 6))
            for i, (c, s) in enumerate(zip(n, sums)) if c]
    return spark.createDataFrame(rows, "cluster long, n long, " + ", ".join(f"c_{c} double" for c in FEATS)
                                 + ", inertia double")


@register("g2_g3_kmeans_search")
def g2_g3_kmeans_search(spark, sf_dir):
    """k = 2…6, best of 10 seeds each; indices, best k and verdict."""
    res = cluster.kmeans_search(_frame(spark, sf_dir))
    best = cluster.best_k(res)["k"]
    rows = [(r["k"], round(r["inertia"], 6), round(r["silhouette_sq"], 6),
             round(r["davies_bouldin"], 6), round(r["calinski_harabasz"], 6), r["k"] == best)
            for r in res]
    df = spark.createDataFrame(rows, "k int, inertia double, silhouette_sq double, "
                                     "davies_bouldin double, calinski_harabasz double, is_best boolean")
    return df.withColumn("verdict", silhouette_verdict("silhouette_sq"))


def _bands_sql(x: str, bands, default: str) -> str:
    return ("CASE " + " ".join(f"WHEN {x} >= {cut} THEN '{name}'" for cut, name in bands)
            + f" ELSE '{default}' END")


_ARI_SQL = """(SELECT CASE WHEN mx = expected THEN 1.0 ELSE (idx - expected) / (mx - expected) END
FROM (SELECT idx, sa * sb / (n * (n - 1) / 2.0) AS expected, (sa + sb) / 2.0 AS mx FROM
  (SELECT sum(nij * (nij - 1) / 2.0) AS idx, sum(nij) AS n FROM
     (SELECT cluster, segment, count(*) AS nij FROM cluster_labelled GROUP BY cluster, segment)),
  (SELECT sum(a * (a - 1) / 2.0) AS sa FROM (SELECT count(*) AS a FROM cluster_labelled GROUP BY cluster)),
  (SELECT sum(b * (b - 1) / 2.0) AS sb FROM (SELECT count(*) AS b FROM cluster_labelled GROUP BY segment))))"""

_F7_SQL = with_prelude(
    "SELECT s AS silhouette_sq, a AS ari, "
    + _bands_sql("s", SILHOUETTE_BANDS, "no substantial structure") + " AS silhouette_verdict, "
    + _bands_sql("a", STABILITY_BANDS, UNSTABLE_VERDICT) + " AS stability_verdict "
    "FROM (SELECT round(avg(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS s "
    "FROM sil), (SELECT round(" + _ARI_SQL + ", 6) AS a)",
    [_CENTROIDS, _SIL_SUMS, _SIL])


@register("f7_verdicts", _F7_SQL)
def f7_verdicts(spark, sf_dir):
    """the silhouette and stability verdict bands applied to the
    fixed-centre labelling's silhouette and its ARI against the segments."""
    lab = stored(_labelled(spark, sf_dir))
    sil = cluster.label_indices(lab).select(F.round("silhouette_sq", 6).alias("silhouette_sq"))
    a = cluster.ari(lab, "cluster", "segment").select(F.round("ari", 6).alias("ari"))
    j = sil.crossJoin(a)
    return j.select("silhouette_sq", "ari",
                    silhouette_verdict("silhouette_sq").alias("silhouette_verdict"),
                    stability_verdict("ari").alias("stability_verdict"))


@register("g7_stability")
def g7_stability(spark, sf_dir):
    """ARI of 10 k-means seeds against the first at the best k, with the
    mean/min/max and the stability verdict."""
    from .q_fitted import best_labels
    k = best_labels(spark, sf_dir).agg(F.count_distinct("cluster")).first()[0]
    scores = cluster.stability(_frame(spark, sf_dir), k)
    mean = sum(scores) / len(scores)
    df = spark.createDataFrame([(i + 1, round(float(s), 6)) for i, s in enumerate(scores)],
                               "seed int, ari double")
    return df.select("*", F.lit(round(mean, 6)).alias("ari_mean"),
                     F.lit(round(min(scores), 6)).alias("ari_min"),
                     F.lit(round(max(scores), 6)).alias("ari_max"),
                     stability_verdict(F.lit(mean)).alias("verdict"))


@register("g8_pca")
def g8_pca(spark, sf_dir):
    """Variance explained by the first two principal components."""
    v = cluster.pca_variance(_frame(spark, sf_dir))
    return spark.createDataFrame([(i + 1, round(x, 6)) for i, x in enumerate(v)],
                                 "component int, explained_variance_ratio double")


@register("g8_points")
def g8_points(spark, sf_dir):
    """Every customer's place on the first two principal components."""
    p = cluster.pca_points(_frame(spark, sf_dir))
    return p.select("customer_id", "segment", "is_churned", F.round("pc1", 6).alias("pc1"),
                    F.round("pc2", 6).alias("pc2"))
