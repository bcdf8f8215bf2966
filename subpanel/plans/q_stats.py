"""Registered statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import churn, models, quality, stats
from ..operators.quantiles import exact_quantiles
from .oracle import with_prelude
from .registry import register

T1_COLUMNS = ["usage_per_seat", "support_tickets", "discount_pct", "nps_score", "seats", "mrr",
              "is_churned"]


def _model_frame(spark, sf_dir):
    return churn.model_frame(spark, sf_dir, quality.clean(spark, sf_dir))


def _scored(spark, sf_dir):
    return churn.scored_frame(spark, sf_dir, quality.clean(spark, sf_dir))


def _t1_sql():
    ranks = ",\n".join(
        f"count(*) OVER (ORDER BY round({c}, 9) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        f" - (count(*) OVER (PARTITION BY round({c}, 9)) - 1) / 2.0 AS r_{c}" for c in T1_COLUMNS)
    pairs = "\nUNION ALL\n".join(
        f"SELECT '{a}' AS row, '{b}' AS col, round(corr(r_{a}, r_{b}), 6) AS value FROM t1_ranks"
        for a in T1_COLUMNS for b in T1_COLUMNS)
    return with_prelude(pairs, [("t1_ranks", f"SELECT {ranks} FROM model_frame")])


@register("t1_spearman", _t1_sql())
def t1_spearman(spark, sf_dir):
    """Spearman matrix of the baseline features and the panel label."""
    mf = _model_frame(spark, sf_dir)
    # means that are equal in exact arithmetic can differ in the last bit by
    # summation order; rounding to 9 dp restores their ties before ranking
    mf = mf.select(*[F.round(F.col(c).cast("double"), 9).alias(c) for c in T1_COLUMNS])
    long = stats.spearman_long(mf, T1_COLUMNS)
    return long.select("row", "col", F.round("value", 6).alias("value"))


@register("t2_pearson", with_prelude("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr({c}, label), 6) AS correlation FROM scored"
    for c in churn.CHURN_FEATURES)))
def t2_pearson(spark, sf_dir):
    """Pearson correlation of each churn feature with the scored label."""
    p = stats.pearson_with(_scored(spark, sf_dir), churn.CHURN_FEATURES, "label")
    return p.select("feature", F.round("correlation", 6).alias("correlation"))


def _ols_inputs(spark, sf_dir):
    mf = _model_frame(spark, sf_dir)
    mf, dummies = stats.segment_dummies(mf, "segment")
    return mf, churn.MODEL_NUMERIC_FEATURES + dummies


@register("t4_ols")
def t4_ols(spark, sf_dir):
    """T4: nps_score ~ numeric features + C(segment), with full inference."""
    mf, xs = _ols_inputs(spark, sf_dir)
    fit = stats.solve_ols(stats.gram(mf, "nps_score", xs), xs)
    return stats.ols_frame(spark, fit)


_T5_SQL = with_prelude("""
SELECT round(1.0 - (syy - (b1 * d1 + b2 * d2 + b3 * d3) / det) / syy, 6) AS r2, n
FROM (SELECT *,
        a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det,
        b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3) AS d1,
        a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13) AS d2,
        a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13) AS d3
      FROM (SELECT n,
              sum((x1 - m1) * (x1 - m1)) AS a11, sum((x1 - m1) * (x2 - m2)) AS a12,
              sum((x1 - m1) * (x3 - m3)) AS a13, sum((x2 - m2) * (x2 - m2)) AS a22,
              sum((x2 - m2) * (x3 - m3)) AS a23, sum((x3 - m3) * (x3 - m3)) AS a33,
              sum((x1 - m1) * (y - my)) AS b1, sum((x2 - m2) * (y - my)) AS b2,
              sum((x3 - m3) * (y - my)) AS b3, sum((y - my) * (y - my)) AS syy
            FROM (SELECT mrr AS y, cast(seats as double) AS x1, list_price_per_seat AS x2,
                         discount_pct AS x3 FROM clean) d,
                 (SELECT avg(mrr) AS my, avg(seats) AS m1, avg(list_price_per_seat) AS m2,
                         avg(discount_pct) AS m3, count(*) AS n FROM clean) c
            GROUP BY n))""")


@register("t5_identity_r2", _T5_SQL)
def t5_identity_r2(spark, sf_dir):
    """T5: mrr ~ seats + list price + discount at panel grain; R² only."""
    panel = quality.clean(spark, sf_dir, label=False)
    xs = ["seats", "list_price_per_seat", "discount_pct"]
    fit = stats.solve_ols(stats.gram(panel, "mrr", xs), xs)
    return spark.createDataFrame([(round(float(fit["r2"]), 6), int(fit["n"]))], "r2 double, n long")


@register("t6_parsimony")
def t6_parsimony(spark, sf_dir):
    """Intercept-only, one-feature and all-feature models from one Gram pass."""
    mf, xs = _ols_inputs(spark, sf_dir)
    gm = stats.gram(mf, "nps_score", xs)
    rows = []
    for name, sub in (("intercept_only", []), ("one_feature", ["usage_per_seat"]),
                      ("all_features", xs)):
        fit = stats.solve_ols(gm, sub)
        rows.append((name, len(sub), round(float(fit["r2"]), 6), round(float(fit["adj_r2"]), 6)))
    return spark.createDataFrame(rows, "model string, terms int, r2 double, adj_r2 double")


@register("t8_residuals")
def t8_residuals(spark, sf_dir):
    """Fitted, residual and standardised residual per customer."""
    mf, xs = _ols_inputs(spark, sf_dir)
    fit = stats.solve_ols(stats.gram(mf, "nps_score", xs), xs)
    r = stats.residuals(mf, "nps_score", fit)
    return r.select("customer_id", *[F.round(c, 6).alias(c) for c in
                                     ("fitted", "residual", "std_residual")])


@register("t9_qq")
def t9_qq(spark, sf_dir):
    """Q-Q points of the standardised OLS residuals and the fit line."""
    mf, xs = _ols_inputs(spark, sf_dir)
    fit = stats.solve_ols(stats.gram(mf, "nps_score", xs), xs)
    r = stats.residuals(mf, "nps_score", fit)
    q = stats.qq_points(r, "std_residual")
    return q.select("i", *[F.round(c, 6).alias(c) for c in
                           ("theoretical", "ordered", "slope", "intercept", "r")])


@register("t10_histogram", with_prelude("""
SELECT bin, round(lo + (hi - lo) * bin / 30, 9) AS bin_low,
       round(lo + (hi - lo) * (bin + 1) / 30, 9) AS bin_high, count(*) AS count
FROM (SELECT CASE WHEN hi - lo = 0 THEN 0
                  ELSE cast(least(floor((nps_score - lo) / (hi - lo) * 30), 29) as integer) END AS bin,
             lo, hi
      FROM model_frame, (SELECT min(nps_score) AS lo, max(nps_score) AS hi FROM model_frame))
GROUP BY bin, lo, hi"""))
def t10_histogram(spark, sf_dir):
    """30 equal-width bins of customer NPS."""
    h = stats.histogram(_model_frame(spark, sf_dir), "nps_score", 30)
    return h.select("bin", F.round("bin_low", 9).alias("bin_low"),
                    F.round("bin_high", 9).alias("bin_high"), "count")


@register("t7_logit_compare")
def t7_logit_compare(spark, sf_dir):
    """Discount alone vs with usage, seats and NPS (binomial GLM, Wald)."""
    s = _scored(spark, sf_dir).persist()
    alone = models.logit_inference(s, "label", ["discount_pct"])["discount_pct"]
    together = models.logit_inference(
        s, "label", ["discount_pct", "usage_per_seat", "seats", "nps_score"])["discount_pct"]
    corr = s.agg(F.corr("discount_pct", "label")).collect()[0][0]
    s.unpersist()
    grows = abs(together["coef"]) > abs(alone["coef"])
    supported = alone["p"] < 0.05 or together["p"] < 0.05
    r = lambda x, d: round(float(x), d)
    row = ("discount_pct", r(corr, 4), r(alone["coef"], 4), r(together["coef"], 4),
           r(alone["ci"][0], 3), r(alone["ci"][1], 3), r(together["ci"][0], 3),
           r(together["ci"][1], 3), r(alone["p"], 4), r(together["p"], 4),
           bool(grows), bool(supported))
    return spark.createDataFrame([row], "feature string, marginal_correlation double, "
                                        "coefficient_alone double, coefficient_with_others double, "
                                        "ci_alone_low double, ci_alone_high double, "
                                        "ci_with_others_low double, ci_with_others_high double, "
                                        "p_value_alone double, p_value_with_others double, "
                                        "effect_grows_when_controlled boolean, "
                                        "statistically_supported boolean")


@register("t11_sign_recovery")
def t11_sign_recovery(spark, sf_dir):
    """Standardised logistic fit on the scored label; fitted vs true signs."""
    s = _scored(spark, sf_dir)
    coefs = models.fitted_logistic_coefficients(s, churn.CHURN_FEATURES, "label")
    rows = []
    for f, true in churn.TRUE_COEFFICIENTS.items():
        fitted = coefs[f]
        rows.append((f, float(true), round(float(fitted), 6), bool((fitted > 0) == (true > 0))))
    return spark.createDataFrame(rows, "feature string, true_coefficient double, "
                                       "fitted_coefficient double, sign_matches boolean")


_T3_COLS = ["usage_per_seat", "support_tickets", "discount_pct", "nps_score", "seats", "mrr"]


@register("t3_skewness", with_prelude("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature,
       round((avg({c} * {c} * {c}) - 3 * avg({c}) * avg({c} * {c}) + 2 * avg({c}) * avg({c}) * avg({c}))
             / pow(avg({c} * {c}) - avg({c}) * avg({c}), 1.5), 4) AS skew FROM model_frame"""
    for c in _T3_COLS)))
def t3_skewness(spark, sf_dir):
    """Population skewness (scipy's default, not the bias-corrected form)
    of the customer-level baseline features."""
    mf = _model_frame(spark, sf_dir)
    agg = mf.agg(*[F.skewness(c).alias(c) for c in _T3_COLS])
    return agg.unpivot([], _T3_COLS, "feature", "skew").select(
        "feature", F.round("skew", 4).alias("skew"))


_T4_COLS = ["nps_score", *churn.MODEL_NUMERIC_FEATURES]


@register("t4_gram", with_prelude("\nUNION ALL\n".join(
    f"SELECT '{a}' AS row, '{b}' AS col, round(covar_pop({a}, {b}) * count(*), 4) AS value, count(*) AS n "
    "FROM model_frame" for i, a in enumerate(_T4_COLS) for b in _T4_COLS[i:])))
def t4_gram(spark, sf_dir):
    """T4: the centred cross-products that the regression is solved from (upper triangle)."""
    gm = stats.gram(_model_frame(spark, sf_dir), _T4_COLS[0], _T4_COLS[1:])
    rows = [(a, b, round(float(gm["G"][i, j]), 4), int(gm["n"]))
            for i, a in enumerate(_T4_COLS) for j, b in enumerate(_T4_COLS) if j >= i]
    return spark.createDataFrame(rows, "row string, col string, value double, n long")


@register("t6_one_feature", with_prelude("""
SELECT 'intercept_only' AS model, 0 AS terms, 0.0::double AS r2, 0.0::double AS adj_r2
UNION ALL
SELECT 'one_feature', 1, round(r2, 6), round(1.0 - (1.0 - r2) * (n - 1) / (n - 2), 6)
FROM (SELECT regr_r2(nps_score, usage_per_seat) AS r2, count(*) AS n FROM model_frame)"""))
def t6_one_feature(spark, sf_dir):
    """The mean and the one-feature model of the parsimony table."""
    mf = _model_frame(spark, sf_dir)
    gm = stats.gram(mf, "nps_score", ["usage_per_seat"])
    rows = []
    for name, xs in (("intercept_only", []), ("one_feature", ["usage_per_seat"])):
        fit = stats.solve_ols(gm, xs)
        rows.append((name, len(xs), round(float(fit["r2"]), 6), round(float(fit["adj_r2"]), 6)))
    return spark.createDataFrame(rows, "model string, terms int, r2 double, adj_r2 double")


_ONE_FEATURE = [("line", "SELECT regr_slope(nps_score, usage_per_seat) AS b, "
                         "regr_intercept(nps_score, usage_per_seat) AS a FROM model_frame"),
                ("fits", "SELECT customer_id, a + b * usage_per_seat AS fitted, "
                         "nps_score - (a + b * usage_per_seat) AS residual FROM model_frame, line"),
                ("marks", """SELECT stddev_samp(residual) AS sd,
      (avg(residual * residual * residual) - 3 * avg(residual) * avg(residual * residual)
       + 2 * avg(residual) * avg(residual) * avg(residual))
      / pow(avg(residual * residual) - avg(residual) * avg(residual), 1.5) AS skew FROM fits""")]


def _one_feature_residuals(spark, sf_dir):
    mf = _model_frame(spark, sf_dir)
    fit = stats.solve_ols(stats.gram(mf, "nps_score", ["usage_per_seat"]), ["usage_per_seat"])
    return stats.residuals(mf, "nps_score", fit)


@register("t8_one_feature_residuals", with_prelude("""
SELECT customer_id, round(fitted, 6) AS fitted, round(residual, 6) AS residual,
       round(residual / sd, 6) AS std_residual, round(skew, 4) AS residual_skew
FROM fits, marks""", _ONE_FEATURE))
def t8_one_feature_residuals(spark, sf_dir):
    """T8 of the one-feature model, with the skewness of its residuals."""
    r = _one_feature_residuals(spark, sf_dir)
    skew = r.agg(F.round(F.skewness("residual"), 4).alias("residual_skew"))
    return r.crossJoin(F.broadcast(skew)).select(
        "customer_id", *[F.round(c, 6).alias(c) for c in ("fitted", "residual", "std_residual")], "residual_skew")


@register("t8_residual_skew")
def t8_residual_skew(spark, sf_dir):
    """Skewness and spread of the full model's residuals."""
    mf, xs = _ols_inputs(spark, sf_dir)
    fit = stats.solve_ols(stats.gram(mf, "nps_score", xs), xs)
    return stats.residuals(mf, "nps_score", fit).agg(
        F.count("*").alias("n"), F.round(F.skewness("residual"), 4).alias("residual_skew"),
        F.round(F.stddev_samp("residual"), 6).alias("residual_std"))


@register("t9_order_points", with_prelude("""
SELECT i, round(CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n)
            ELSE (i - 0.3175) / (n + 0.365) END, 9) AS probability, round(ordered, 6) AS ordered
FROM (SELECT row_number() OVER (ORDER BY residual, customer_id) AS i, count(*) OVER () AS n,
             residual / sd AS ordered FROM fits, marks)""", _ONE_FEATURE))
def t9_order_points(spark, sf_dir):
    """T9 of the one-feature model: places, Filliben's medians and ordered residuals."""
    q = stats.qq_points(_one_feature_residuals(spark, sf_dir), "std_residual")
    return q.select("i", F.round("probability", 9).alias("probability"), F.round("ordered", 6).alias("ordered"))


def _t10_sql(c):
    return f"""SELECT '{c}' AS "column", bin, round(lo + (hi - lo) * bin / 30, 6) AS bin_low,
       round(lo + (hi - lo) * (bin + 1) / 30, 6) AS bin_high, count(*) AS count,
       round(mean, 6) AS mean, round(med, 6) AS median, round(skew, 4) AS skew
FROM (SELECT cast(least(floor(({c} - lo) / (hi - lo) * 30), 29) as integer) AS bin, s.* FROM clean,
       (SELECT min({c}) AS lo, max({c}) AS hi, avg({c}) AS mean, median({c}) AS med,
               (avg({c} * {c} * {c}) - 3 * avg({c}) * avg({c} * {c}) + 2 * avg({c}) * avg({c}) * avg({c}))
               / pow(avg({c} * {c}) - avg({c}) * avg({c}), 1.5) AS skew FROM clean) s
      WHERE {c} IS NOT NULL)
GROUP BY bin, lo, hi, mean, med, skew"""


@register("t10_marked_histograms", with_prelude("\nUNION ALL\n".join(
    _t10_sql(c) for c in ("mrr", "usage_per_seat"))))
def t10_marked_histograms(spark, sf_dir):
    """Panel histograms of revenue and usage with mean and median marks and the skewness."""
    h = stats.histograms(quality.clean(spark, sf_dir, label=False), ["mrr", "usage_per_seat"])
    return h.select("column", "bin", "count", *[F.round(c, 6).alias(c) for c in (
        "bin_low", "bin_high", "mean", "median")], F.round("skew", 4).alias("skew"))


_FIG10_X = ["seats", "list_price_per_seat", "discount_pct"]


@register("fig06_medians", with_prelude("""
SELECT round(median(usage_per_seat), 6) AS usage_per_seat, round(median(support_tickets), 6) AS support_tickets
FROM model_frame"""))
def fig06_medians(spark, sf_dir):
    """Figure 6: where its median lines lie (exact medians of the customers' baseline means)."""
    cols = ["usage_per_seat", "support_tickets"]
    return exact_quantiles(_model_frame(spark, sf_dir), cols).select(*[F.round(c, 6).alias(c) for c in cols])


@register("fig10_fitted_actual")
def fig10_fitted_actual(spark, sf_dir):
    """Figure 10: every panel row's revenue against the revenue fitted from seats, price and discount."""
    panel = quality.clean(spark, sf_dir, label=False)
    fit = stats.solve_ols(stats.gram(panel, "mrr", _FIG10_X), _FIG10_X)
    return panel.select("fact_id", F.round("mrr", 2).alias("actual"),
                        F.round(stats.fitted_expr(fit), 2).alias("fitted"))
