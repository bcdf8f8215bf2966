"""Clustering.

Value-checkable parts run on labels that are a pure function of the data:
``fixed_centre_labels`` takes as centres the standardised rows of the ``k``
customers with the smallest hash ``u('centre', id)`` and assigns every
customer to the nearest (ties to the lower index). Everything that only
depends on labels — inertia, Davies-Bouldin, Calinski-Harabasz, the
squared-Euclidean silhouette, profiles, crosstabs, ARI — is a per-cluster
aggregate (k bounded), so no pairwise distances are ever formed.
The k-means search fits all restarts together (``lloyd``).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import u
from ..session import stored
from . import lloyd
from .stats import standardize

CLUSTER_FEATURES = ["usage_per_seat", "support_tickets", "discount_pct", "seats", "nps_score",
                    "mrr"]
Z_FEATURES = [f"z_{c}" for c in CLUSTER_FEATURES]
K_RANGE = range(2, 7)
N_INIT = 10
STABILITY_SEEDS = 10
FIXED_K = 3


def cluster_frame(panel: DataFrame, periods: list) -> DataFrame:
    """G1: baseline means of the six features per customer, listwise deletion
    on them, population z-scores (zero-spread guard)."""
    base = panel.where(F.col("period_key").isin(periods)).groupBy("customer_id").agg(
        *[F.avg(c).alias(c) for c in CLUSTER_FEATURES],
        F.max("segment").alias("segment"), F.max("is_churned").alias("is_churned"),
        F.max("company_name").alias("company_name"))
    base = base.na.drop(subset=CLUSTER_FEATURES)
    return standardize(base, CLUSTER_FEATURES, ddof=0, prefix="z_")


def fixed_centres(frame: DataFrame, k: int = FIXED_K) -> list[list[float]]:
    """k deterministic centres (bounded action: k rows)."""
    rows = frame.orderBy(u("centre", F.col("customer_id")), F.col("customer_id")) \
                .select(*Z_FEATURES).limit(k).collect()
    return [[float(r[c]) for c in Z_FEATURES] for r in rows]


def sq_distance(centre: list[float]):
    expr = None
    for c, v in zip(Z_FEATURES, centre):
        term = (F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v))
        expr = term if expr is None else expr + term
    return expr


def assign_nearest(frame: DataFrame, centres: list[list[float]], out: str = "cluster") -> DataFrame:
    """Nearest centre by squared Euclidean distance, ties to the lower index."""
    d = [sq_distance(c) for c in centres]
    best = F.lit(0)
    best_d = d[0]
    for i in range(1, len(d)):
        closer = d[i] < best_d
        best = F.when(closer, F.lit(i)).otherwise(best)
        best_d = F.when(closer, d[i]).otherwise(best_d)
    return frame.withColumn(out, best.cast("int"))


def fixed_centre_labels(frame: DataFrame, k: int = FIXED_K) -> DataFrame:
    return assign_nearest(frame, fixed_centres(frame, k))


def label_indices(labelled: DataFrame, label: str = "cluster", cols=Z_FEATURES) -> DataFrame:
    """G3 given labels: inertia (to centroids), Davies-Bouldin, Calinski-Harabasz
    and the squared-Euclidean silhouette, all from per-cluster aggregates.

    Squared distance from x to every point of cluster C is
    ``n_C‖x‖² − 2x·ΣC + Σ‖y‖²``; own-cluster mean divides by ``n_C − 1``.
    """
    sq = sum(F.col(c) * F.col(c) for c in cols)
    per = labelled.groupBy(label).agg(
        F.count("*").alias("n_c"), *[F.sum(c).alias(f"s_{c}") for c in cols],
        F.sum(sq).alias("psi"))
    rows = per.collect()  # k rows (bounded)
    k = len(rows)
    stats = {r[label]: r for r in rows}
    n = sum(r["n_c"] for r in rows)
    cent = {c: [r[f"s_{f}"] / r["n_c"] for f in cols] for c, r in stats.items()}
    overall = [sum(r[f"s_{f}"] for r in rows) / n for f in cols]
    # inertia and S_i (mean Euclidean distance to own centroid) need one more pass
    dist_own = None
    for cid, c in cent.items():
        d2 = sum((F.col(f) - F.lit(v)) * (F.col(f) - F.lit(v)) for f, v in zip(cols, c))
        dist_own = F.when(F.col(label) == cid, d2) if dist_own is None else dist_own.when(F.col(label) == cid, d2)
    own = labelled.select(label, dist_own.alias("d2"))
    agg = own.groupBy(label).agg(F.sum("d2").alias("w"), F.avg(F.sqrt("d2")).alias("s")).collect()
    W = sum(r["w"] for r in agg)
    S = {r[label]: r["s"] for r in agg}
    B = sum(stats[c]["n_c"] * sum((a - b) ** 2 for a, b in zip(cent[c], overall)) for c in cent)
    ch = (B / (k - 1)) / (W / (n - k)) if k > 1 and n > k and W > 0 else float("nan")
    db_terms = []
    for i in cent:
        worst = 0.0
        for j in cent:
            if i == j:
                continue
            sep = math.sqrt(sum((a - b) ** 2 for a, b in zip(cent[i], cent[j])))
            worst = max(worst, (S[i] + S[j]) / sep if sep > 0 else float("inf"))
        db_terms.append(worst)
    db = sum(db_terms) / len(db_terms) if k > 1 else float("nan")
    # squared-Euclidean silhouette, O(n·k)
    xs = sum(F.col(f) * F.col(f) for f in cols)
    sums = {}
    for cid, r in stats.items():
        dot = sum(F.col(f) * F.lit(float(r[f"s_{f}"])) for f in cols)
        sums[cid] = F.lit(float(r["n_c"])) * xs - F.lit(2.0) * dot + F.lit(float(r["psi"]))
    own_n = None
    a_expr = None
    for cid, r in stats.items():
        cond = F.col(label) == cid
        a_val = sums[cid] / F.lit(float(max(r["n_c"] - 1, 1)))
        a_expr = F.when(cond, a_val) if a_expr is None else a_expr.when(cond, a_val)
        own_n = F.when(cond, F.lit(r["n_c"])) if own_n is None else own_n.when(cond, F.lit(r["n_c"]))
    b_expr = None
    for cid, r in stats.items():
        other = F.when(F.col(label) != cid, sums[cid] / F.lit(float(r["n_c"])))
        b_expr = other if b_expr is None else F.least(b_expr, other)
    sil = F.when(own_n <= 1, F.lit(0.0)).otherwise(
        (b_expr - a_expr) / F.greatest(a_expr, b_expr))
    silhouette = labelled.select(sil.alias("s")).agg(F.avg("s")).collect()[0][0] if k > 1 else None
    return labelled.sparkSession.createDataFrame(
        [(k, int(n), float(W), float(db), float(ch), None if silhouette is None else float(silhouette))],
        "k int, n long, inertia double, davies_bouldin double, calinski_harabasz double, "
        "silhouette_sq double")


def vectors(frame: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=Z_FEATURES, outputCol="features").transform(frame)


def kmeans_search(frame: DataFrame, ks=K_RANGE, seeds=range(N_INIT)) -> list[dict]:
    """Per k the best of the restarts, its inertia and label indices."""
    frame = stored(frame.select("customer_id", *Z_FEATURES))
    best = lloyd.fit(frame, Z_FEATURES, [(k, s) for k in ks for s in seeds], group=lambda k, _: k)

    def indices(k):
        centres = best[k].centres.tolist()
        idx = label_indices(assign_nearest(frame, centres)).first()
        return {"k": k, "inertia": best[k].inertia, "silhouette_sq": idx["silhouette_sq"],
                "davies_bouldin": idx["davies_bouldin"],
                "calinski_harabasz": idx["calinski_harabasz"], "centres": centres}

    with ThreadPoolExecutor(max_workers=len(best) or 1) as pool:
        return list(pool.map(indices, sorted(best)))


def best_k(search: list[dict]) -> dict:
    """The searched k of largest silhouette, the smaller k on ties."""
    return max(search, key=lambda r: (r["silhouette_sq"], -r["k"]))


def best_k_labels(frame: DataFrame) -> DataFrame:
    """The frame with the cluster that the best k's model assigns; the frame is written once for both."""
    frame = stored(frame)
    return assign_nearest(frame, best_k(kmeans_search(frame))["centres"])


def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand Index from the contingency table (bounded by
    #labels_a × #labels_b), 1 when both partitions are trivial."""
    cont = df.groupBy(a, b).agg(F.count("*").alias("nij"))
    c2 = lambda x: x * (x - 1) / 2.0
    idx = cont.agg(F.sum(c2(F.col("nij"))).alias("idx"), F.sum("nij").alias("n"))
    ai = cont.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(c2(F.col("ai"))).alias("sa"))
    bj = cont.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(c2(F.col("bj"))).alias("sb"))
    j = idx.crossJoin(ai).crossJoin(bj)
    expected = F.col("sa") * F.col("sb") / c2(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2.0
    return j.select(F.when(mx == expected, F.lit(1.0))
                    .otherwise((F.col("idx") - expected) / (mx - expected)).alias("ari"))


def stability(frame: DataFrame, k: int, seeds=range(STABILITY_SEEDS)) -> list[float]:
    """ARI of each seed's labelling vs the first seed's; a seed's labelling is the
    best of its own restarts, and all seeds' restarts are fitted together."""
    seeds = list(seeds)
    frame = stored(frame.select("customer_id", *Z_FEATURES))
    best = lloyd.fit(frame, Z_FEATURES, [(k, s * N_INIT + r) for s in seeds for r in range(N_INIT)],
                     group=lambda _, start: start // N_INIT)
    labels = frame
    for s in seeds:
        labels = assign_nearest(labels, best[s].centres.tolist(), f"l{s}")
    labels = stored(labels.select(*[f"l{s}" for s in seeds]))
    return [ari(labels, f"l{seeds[0]}", f"l{s}").first()["ari"] for s in seeds[1:]]


def pca_variance(frame: DataFrame, k: int = 2) -> list[float]:
    """Explained variance ratio of the first k components (features are
    already centred z-scores; Spark's PCA does not centre)."""
    m = PCA(k=k, inputCol="features", outputCol="pc").fit(vectors(frame))
    return [float(v) for v in m.explainedVariance]


def pca_points(frame: DataFrame, k: int = 2) -> DataFrame:
    """Each customer's place on the first k components, one column expression a component.

    A component's sign is such that its largest loading is positive.
    """
    loadings = PCA(k=k, inputCol="features", outputCol="pc").fit(vectors(frame)).pc.toArray()
    places = []
    for j in range(k):
        v = loadings[:, j]
        v = v if v[abs(v).argmax()] > 0 else -v
        places.append(sum((F.col(c) * F.lit(float(w)) for c, w in zip(Z_FEATURES, v)), F.lit(0.0)).alias(f"pc{j + 1}"))
    return frame.select("customer_id", "segment", "is_churned", *places)


def profiles(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """Size, churn rate, feature means, dominant segment, purity."""
    seg = labelled.groupBy(label, "segment").agg(F.count("*").alias("_n"))
    dom = seg.groupBy(label).agg(
        F.min_by("segment", F.struct(-F.col("_n"), F.col("segment"))).alias("dominant_segment"),
        F.max("_n").alias("_top"))
    base = labelled.groupBy(label).agg(
        F.count("*").alias("size"), F.avg("is_churned").alias("churn_rate"),
        *[F.avg(c).alias(f"mean_{c}") for c in CLUSTER_FEATURES])
    return base.join(dom, label).withColumn("purity", F.col("_top") / F.col("size")).drop("_top")


def crosstab(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """Cluster × segment counts and row-normalised shares."""
    c = labelled.groupBy(label, "segment").agg(F.count("*").alias("customers"))
    tot = c.groupBy(label).agg(F.sum("customers").alias("_t"))
    return c.join(tot, label).withColumn("share", F.col("customers") / F.col("_t")).drop("_t")


def profile_z(profile: DataFrame, label: str = "cluster") -> DataFrame:
    """Cluster means z-scored across clusters (ddof 0, zero-spread guard)."""
    cols = [f"mean_{c}" for c in CLUSTER_FEATURES]
    return standardize(profile.select(label, *cols), cols, ddof=0, prefix="z_")
