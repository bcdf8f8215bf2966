"""Operators on hand-computed micro frames: ties, nulls, guards, layouts."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from subpanel.operators import cluster, quality, revenue, stats, threshold
from subpanel.operators.quantiles import exact_median_value, exact_quantile, exact_quantiles
from subpanel.operators.rank import average_rank, global_rank
from subpanel.sources.star import keep_first


def test_median_after_negatives(spark):
    df = spark.createDataFrame([(10.0,), (None,), (-5.0,), (30.0,)], "usage_events double")
    assert exact_median_value(df.select(quality.usage_nonneg().alias("u")), "u") == 20.0


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_quantile_matches_pandas(spark, parts):
    rng = random.Random(3)
    rows = [(g, float(rng.choice([1, 2, 2, 3, 5, 8]) if g == "ties" else rng.gauss(0, 1)))
            for g in ("ties", "cont") for _ in range(1001 if g == "ties" else 2000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    got = {r["g"]: r["v"] for r in exact_quantile(df, "v", ["g"], buckets=16).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, expect in pdf.groupby("g")["v"].median().items():
        assert got[g] == pytest.approx(expect, abs=1e-12)


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "region_name string")
    assert quality.modal_value(df, "region_name") == "a"


@pytest.mark.parametrize("parts", [1, 8])
def test_dedupe_keeps_smallest_in_any_layout(spark, parts):
    df = spark.createDataFrame([(1, 5.0, "z"), (1, 3.0, "y"), (2, 1.0, "x")],
                               "fact_id int, l_partkey double, other string").repartition(parts)
    got = sorted(tuple(r) for r in keep_first(df, "fact_id", ["l_partkey"]).collect())
    assert got == [(1, 3.0, "y"), (2, 1.0, "x")]


def test_global_rank_is_total_and_layout_free(spark):
    df = spark.range(0, 500).select(F.col("id"), (F.col("id") % 7).alias("k")).repartition(9)
    r = global_rank(df, [F.col("k").desc(), F.col("id").asc()], "r").toPandas()
    expect = r.sort_values(["k", "id"], ascending=[False, True]).reset_index(drop=True)
    assert list(expect["r"]) == list(range(1, 501))


def test_average_rank_matches_pandas(spark):
    vals = [1.0, 1.0, 2.0, 4.0, 4.0, 4.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    got = average_rank(df, "x").toPandas().sort_values("id")["x_rank"].tolist()
    expect = pd.Series(vals).rank(method="average").tolist()
    assert got[:6] == expect[:6] and got[6] is None or np.isnan(got[6])


def test_top_share_k_is_half_even(spark):
    # 25 customers with totals 1..25: k = max(1, round_half_even(2.5)) = 2
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 26)], "customer_id int, mrr double")
    row = revenue.concentration(df).collect()[0]
    total = sum(range(1, 26))
    assert row["top_10_pct_share_of_mrr"] == round((25 + 24) / total, 4)
    small = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "customer_id int, mrr double")
    assert revenue.concentration(small).collect()[0]["top_10_pct_share_of_mrr"] == round(5 / 15, 4)


def test_confusion_and_cost(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.5, 1), (0.1, 0)], "probability double, label int")
    r = threshold.confusion_at(df, 0.5).collect()[0]
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["expected_cost"]) == (2, 1, 0, 1, 50)
    none = threshold.confusion_at(df, 0.95).collect()[0]
    assert none["precision"] == 0.0


def test_sweep_agrees_with_confusion_and_recall_is_monotone(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.random(), rng.randint(0, 1)) for _ in range(400)],
                               "probability double, label int")
    sweep = threshold.threshold_sweep(df).orderBy("threshold").collect()
    assert len(sweep) == 17
    for r in sweep:
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == 400
    recalls = [r["recall"] for r in sweep]
    assert recalls == sorted(recalls, reverse=True)
    c = threshold.confusion_at(df, 0.35).collect()[0]
    s = [r for r in sweep if r["threshold"] == 0.35][0]
    assert (c["tp"], c["fp"]) == (s["tp"], s["fp"])


def test_auc_ties_and_perfect(spark):
    ties = spark.createDataFrame([(0.5, 1), (0.5, 0)], "probability double, label int")
    assert threshold.auc_value(ties).collect()[0]["auc"] == 0.5
    perfect = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.1, 0)], "probability double, label int")
    assert threshold.auc_value(perfect).collect()[0]["auc"] == 1.0


def test_spearman_ties(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (2.0, 5.0), (4.0, 1.0)], "a double, b double")
    m = {(r["row"], r["col"]): r["value"] for r in stats.spearman_long(df, ["a", "b"]).collect()}
    assert m[("a", "b")] == pytest.approx(-0.316228, abs=1e-6)


def test_skew_is_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert stats.skew_of(df, "x").collect()[0][0] == pytest.approx(1.018234, abs=1e-6)


def test_zero_spread_z_is_zero(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "customer_id int, x double")
    assert [r["z_x"] for r in stats.standardize(df, ["x"]).collect()] == [0.0, 0.0]


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x1, x2 = rng.normal(size=200), rng.normal(size=200)
    y = 1.5 + 2.0 * x1 - 0.5 * x2 + rng.normal(scale=0.3, size=200)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "x1": x1, "x2": x2}))
    fit = stats.solve_ols(stats.gram(df, "y", ["x1", "x2"]), ["x1", "x2"])
    X = np.column_stack([np.ones(200), x1, x2])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert fit["intercept"] == pytest.approx(beta[0], abs=1e-9)
    assert fit["beta"]["x1"] == pytest.approx(beta[1], abs=1e-9)
    resid = y - X @ beta
    r2 = 1 - resid @ resid / ((y - y.mean()) @ (y - y.mean()))
    assert fit["r2"] == pytest.approx(r2, abs=1e-9)
    s2 = resid @ resid / (200 - 3)
    se = np.sqrt(np.diag(s2 * np.linalg.inv(X.T @ X)))
    got = {t["term"]: t["std_err"] for t in fit["terms"]}
    assert got["Intercept"] == pytest.approx(se[0], rel=1e-6)
    assert got["x2"] == pytest.approx(se[2], rel=1e-6)


def test_ari_identical_and_permuted(spark):
    df = spark.createDataFrame([(0, 1, 5), (0, 1, 5), (1, 0, 6), (2, 2, 7)], "a int, b int, c int")
    assert cluster.ari(df, "a", "a").collect()[0]["ari"] == 1.0
    assert cluster.ari(df, "a", "b").collect()[0]["ari"] == pytest.approx(1.0)
    assert cluster.ari(df, "a", "c").collect()[0]["ari"] == pytest.approx(1.0)


def test_silhouette_sq_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(0, 1, (30, 6)), rng.normal(4, 1, (25, 6))])
    lab = [0] * 30 + [1] * 25
    pdf = pd.DataFrame(pts, columns=cluster.Z_FEATURES)
    pdf["cluster"] = lab
    got = cluster.label_indices(spark.createDataFrame(pdf)).collect()[0]["silhouette_sq"]
    d = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    lab = np.array(lab)
    s = []
    for i in range(len(pts)):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = d[i, ~own].mean()
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(s), abs=1e-9)


def test_leakage_guard(spark):
    from subpanel.operators.churn import check_leakage
    frame = spark.createDataFrame([(1.0, 3)], "usage_per_seat double, months_active int")
    with pytest.raises(ValueError):
        check_leakage(frame, ["usage_per_seat", "months_active"])
    with pytest.raises(ValueError):
        check_leakage(frame, ["usage_per_seat", "seats"])
    assert check_leakage(frame, ["usage_per_seat"]) is frame


def test_apply_repairs_micro(spark):
    rows = [
        # usage, discount, industry, region, country, signup, hire, seats
        (1, 10.0, 1.2, "  ", None, None, "2024-04-03", "2024-05-01", 0),
        (2, -4.0, 0.1, None, "EUROPE", "FR", "03/04/2024", "2024-03-01", 2),
        (3, None, 0.5, "RETAIL", "EUROPE", "DE", "junk", "2024-03-01", 5),
    ]
    df = spark.createDataFrame(rows, "customer_id int, usage_events double, discount_pct double, "
                                     "industry string, region_name string, country string, "
                                     "signup_date string, hire_date string, seats int")
    out = {r["customer_id"]: r for r in
           quality.apply_repairs(df, quality.CleanParams(7.0, "EUROPE")).collect()}
    assert out[1]["discount_pct"] == pytest.approx(0.2) and out[2]["discount_pct"] == 0.1
    assert out[1]["industry"] == "Unknown" and out[2]["industry"] == "Unknown"
    assert out[3]["industry"] == "RETAIL"
    assert (out[1]["region_name"], out[1]["country"]) == ("EUROPE", "Unknown")
    assert out[2]["usage_events"] is None and out[2]["usage_events_filled"] == 7.0
    assert out[3]["usage_events_filled"] == 7.0
    assert out[1]["usage_per_seat"] == 10.0  # seats 0 → divided by 1
    assert out[1]["rep_assignment_valid"] is False  # signed before the rep was hired
    assert out[2]["rep_assignment_valid"] is True
    assert out[3]["rep_assignment_valid"] is True  # unparseable date → valid
    assert out[2]["usage_events_raw"] == -4.0 and out[1]["region_missing"] is True


def test_hot_key_a_third_of_rows(spark):
    """One key holding a third of all rows: dedupe, global rank and exact
    median stay exact (the unique id breaks ties inside the hot key)."""
    n = 9000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id"), (F.col("id") % 101).cast("double").alias("v"))
    ranked = global_rank(df.repartition(6), [F.col("k").asc(), F.col("id").asc()], "r")
    pdf = ranked.toPandas().sort_values(["k", "id"]).reset_index(drop=True)
    assert list(pdf["r"]) == list(range(1, n + 1))
    first = keep_first(df.select("k", "v", "id"), "k", ["v", "id"])
    hot = first.where("k = 7").collect()[0]
    assert (hot["v"], hot["id"]) == (0.0, 0)
    med = exact_quantile(df, "v", ["k"], buckets=8).where("k = 7").collect()[0]["v"]
    assert med == pd.Series([float(i % 101) for i in range(0, n, 3)]).median()


def test_fitted_payload(spark):
    """Out-of-fold scores and best-k labels reach the risk table, riskiest first, bands agreeing."""
    import __spark_entry__ as entry
    from .conftest import SF_SMALL
    q = entry.queries()
    rows = q["m16_risk_table_fitted"](spark, SF_SMALL).collect()
    scored = q["m8_oof_scores"](spark, SF_SMALL).count()
    assert len(rows) == len({r["customer_id"] for r in rows}) == scored
    p = [r["churn_probability"] for r in rows]
    assert p == sorted(p, reverse=True) and 0 <= p[-1] <= p[0] <= 1
    assert all(r["risk_band"] == ("High" if r["churn_probability"] >= 0.6 else "Medium"
               if r["churn_probability"] >= 0.3 else "Low")
               for r in rows if min(abs(r["churn_probability"] - c) for c in (0.3, 0.6)) > 1e-4)
    clusters = {r["cluster"] for r in rows}
    profiles = q["a18_profiles_fitted"](spark, SF_SMALL).collect()
    assert len(profiles) == len(clusters - {None}) >= 2
    sweep = sorted((r["threshold"], r["recall"]) for r in q["m10_sweep_fitted"](spark, SF_SMALL).collect())
    assert [x for _, x in sweep] == sorted((x for _, x in sweep), reverse=True) and sweep[0][1] > sweep[-1][1]
    calls = q["w4_call_list_fitted"](spark, SF_SMALL).collect()
    assert 0 < len(calls) <= 25 and all(r["probability"] >= 0.5 for r in calls)


@pytest.mark.parametrize("cells,gathered", [(2000, 100_000), (50, 200), (20, 3)])
def test_exact_quantiles_of_several_columns(spark, cells, gathered):
    """All columns at once, by one gathering pass and by several sketched ones; ties, nulls, NaN."""
    rng = random.Random(11)
    rows = [(rng.gauss(0, 1e6), float(rng.choice([1, 1, 1, 7])), None if i % 3 else rng.random(),
             float("nan") if i % 5 == 0 else -float(i), None) for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    pdf = pd.DataFrame(rows, columns=list("abcde")).astype(float)
    for q in (0.0, 0.25, 0.5, 0.999, 1.0):
        got = exact_quantiles(df, list("abcde"), q=q, cells=cells, gathered=gathered).collect()[0]
        for c in "abcd":
            assert got[c] == pytest.approx(pdf[c].quantile(q), rel=1e-12, abs=1e-12), (c, q)
        assert got["e"] is None


def test_exact_quantiles_of_empty_tables(spark):
    df = spark.createDataFrame([], "g string, a double")
    assert exact_quantiles(df, ["a"]).collect() == []
    assert exact_quantiles(df, ["a"], ["g"]).collect() == []


def test_pca_points_against_numpy(spark):
    """Places on the components: their variances are the eigenvalues, and they don't correlate."""
    from subpanel.plans.registry import load_all
    from tests.conftest import SF_SMALL

    queries, _ = load_all()
    frame = queries["g1_cluster_frame"](spark, SF_SMALL).toPandas()
    z = frame[[c for c in frame.columns if c.startswith("z_")]].to_numpy()
    points = queries["g8_points"](spark, SF_SMALL).toPandas()[["pc1", "pc2"]].to_numpy()
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T, bias=True)))[::-1]
    found = np.cov(points.T, bias=True)
    assert len(cluster.Z_FEATURES) == z.shape[1] and len(points) == len(z)
    assert np.allclose(np.diag(found), values[:2], atol=1e-4) and abs(found[0, 1]) < 1e-4


def test_marked_histograms_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, None, 5.0), (9.0, None, None)], "a double, b double, c double")
    rows = {(r["column"], r["bin"]): r for r in stats.histograms(df, ["a", "b", "c"], 4).collect()}
    assert {k: r["count"] for k, r in rows.items()} == {("a", 0): 2, ("a", 3): 1, ("c", 0): 2}
    assert rows["a", 3]["median"] == 2.0 and rows["a", 0]["mean"] == 4.0 and rows["a", 3]["bin_high"] == 9.0


def test_fitted_revenue_is_the_least_squares_one(spark):
    """Figure 10: fitted rows have the mean of the actual ones and the R² of T5."""
    from subpanel.plans.registry import load_all
    from tests.conftest import SF_SMALL

    queries, _ = load_all()
    rows = queries["fig10_fitted_actual"](spark, SF_SMALL).toPandas()
    r2 = queries["t5_identity_r2"](spark, SF_SMALL).first()
    assert len(rows) == r2["n"] and rows["fitted"].mean() == pytest.approx(rows["actual"].mean(), rel=1e-5)
    left = ((rows["actual"] - rows["fitted"]) ** 2).sum() / ((rows["actual"] - rows["actual"].mean()) ** 2).sum()
    assert 1 - left == pytest.approx(r2["r2"], abs=1e-4)
