"""Statistics (T1-T11, F12) as aggregates; only p×p results reach the driver.

OLS builds the centred Gram matrix ``XᵀX``, ``Xᵀy``, ``yᵀy`` in one Spark
aggregate (after one pass for the means), solves the p×p system with numpy,
and derives standard errors, t/p values, intervals, R², adjusted R² and F.
Residuals, Q-Q points and histograms go back to the cluster as column
expressions with the fitted coefficients as literals.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import f_sf, t_ppf, t_sf2
from ..session import reliable_checkpoint
from .quantiles import exact_quantiles
from .rank import global_rank

SIGNIFICANCE = 0.05


def standardize(df: DataFrame, cols: list[str], ddof: int = 0, prefix: str = "z_") -> DataFrame:
    """z-scores; a zero (or undefined) spread becomes 1 so z = 0."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                   *[std(c).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    for c in cols:
        spread = F.coalesce(F.when(F.col(f"_s_{c}") != 0, F.col(f"_s_{c}")), F.lit(1.0))
        j = j.withColumn(f"{prefix}{c}", (F.col(c) - F.col(f"_m_{c}")) / spread)
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def segment_dummies(df: DataFrame, col: str) -> tuple[DataFrame, list[str]]:
    """Treatment coding against the alphabetically first level (levels bounded)."""
    levels = sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)
    names = []
    for lvl in levels[1:]:
        name = f"{col}[T.{lvl}]"
        df = df.withColumn(name, (F.col(col) == F.lit(lvl)).cast("double"))
        names.append(name)
    return df, names


def gram(df: DataFrame, y: str, xs: list[str]) -> dict:
    """Means, centred cross-products and n in two aggregate passes."""
    cols = [y] + xs
    means_row = df.agg(F.count("*").alias("n"),
                       *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(cols)]).collect()[0]
    n = means_row["n"]
    means = [means_row[f"m{i}"] for i in range(len(cols))]
    centred = [(F.col(f"`{c}`") - F.lit(m)) for c, m in zip(cols, means)]
    prods = []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            prods.append(F.sum(centred[i] * centred[j]).alias(f"p{i}_{j}"))
    row = df.agg(*prods).collect()[0]
    k = len(cols)
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"p{i}_{j}"]
    return {"n": n, "means": np.array(means), "cols": cols, "G": g}


def solve_ols(gm: dict, xs: list[str]) -> dict:
    """Fit ``y ~ 1 + xs`` from a centred Gram (xs ⊆ the Gram's columns)."""
    cols = gm["cols"]
    idx = [cols.index(x) for x in xs]
    n = gm["n"]
    G = gm["G"]
    syy = G[0, 0]
    p = len(xs) + 1
    if xs:
        Gxx = G[np.ix_(idx, idx)]
        gxy = G[idx, 0]
        inv = np.linalg.pinv(Gxx)
        beta = inv @ gxy
        sse = float(syy - beta @ gxy)
    else:
        inv = np.zeros((0, 0))
        beta = np.zeros(0)
        sse = float(syy)
    mx = gm["means"][idx] if xs else np.zeros(0)
    intercept = float(gm["means"][0] - (beta @ mx if xs else 0.0))
    dfree = n - p
    s2 = sse / dfree if dfree > 0 else float("nan")
    se_b = np.sqrt(np.maximum(np.diag(inv) * s2, 0.0)) if xs else np.zeros(0)
    se_0 = math.sqrt(max(s2 * (1.0 / n + (mx @ inv @ mx if xs else 0.0)), 0.0)) if n else float("nan")
    r2 = 1.0 - sse / syy if xs and syy > 0 else 0.0
    adj = 1.0 - (1.0 - r2) * (n - 1) / dfree if xs and dfree > 0 else 0.0
    if xs and dfree > 0 and sse > 0:
        fstat = ((syy - sse) / (p - 1)) / (sse / dfree)
        fp = f_sf(fstat, p - 1, dfree)
    else:
        fstat, fp = float("nan"), float("nan")
    tq = t_ppf(0.975, dfree) if dfree > 0 else float("nan")
    terms = [("Intercept", intercept, se_0)] + [(x, float(b), float(s)) for x, b, s in zip(xs, beta, se_b)]
    rows = []
    for name, b, s in terms:
        t = b / s if s > 0 else float("nan")
        pv = t_sf2(t, dfree) if dfree > 0 and not math.isnan(t) else float("nan")
        rows.append({"term": name, "coef": b, "std_err": s, "t_value": t, "p_value": pv,
                     "ci_low": b - tq * s, "ci_high": b + tq * s})
    return {"terms": rows, "r2": r2, "adj_r2": adj, "f_stat": fstat, "f_p_value": fp, "n": n,
            "df_resid": dfree, "intercept": intercept, "beta": dict(zip(xs, map(float, beta))),
            "sigma2": s2}


def ols_frame(spark, fit: dict, digits: int = 6) -> DataFrame:
    """One row per term with the model statistics repeated (bounded by p)."""
    sig = sum(1 for r in fit["terms"][1:] if r["p_value"] < SIGNIFICANCE)
    rows = []
    for r in fit["terms"]:
        rows.append((r["term"], *[_r(r[k], digits) for k in
                                  ("coef", "std_err", "t_value", "p_value", "ci_low", "ci_high")],
                     _r(fit["r2"], digits), _r(fit["adj_r2"], digits), _r(fit["f_stat"], digits),
                     _r(fit["f_p_value"], digits), int(fit["n"]), sig))
    return spark.createDataFrame(rows, "term string, coef double, std_err double, t_value double, "
                                       "p_value double, ci_low double, ci_high double, r2 double, "
                                       "adj_r2 double, f_stat double, f_p_value double, n long, "
                                       "significant_terms int")


def _r(x, d):
    return None if x is None or (isinstance(x, float) and math.isnan(x)) else round(float(x), d)


def fitted_expr(fit: dict):
    expr = F.lit(fit["intercept"])
    for name, b in fit["beta"].items():
        expr = expr + F.lit(b) * F.col(f"`{name}`")
    return expr


def residuals(df: DataFrame, y: str, fit: dict) -> DataFrame:
    """Fitted, residual, standardised residual (residual / sample std)."""
    r = df.withColumn("fitted", fitted_expr(fit)).withColumn("residual", F.col(y) - F.col("fitted"))
    s = r.agg(F.stddev_samp("residual").alias("_sd"))
    return r.crossJoin(F.broadcast(s)).withColumn("std_residual", F.col("residual") / F.col("_sd")) \
            .drop("_sd")


def inv_norm(p):
    """Inverse standard-normal CDF as a column expression (rational
    approximation, relative error ~1e-9)."""
    # Coefficients of the public rational approximation.
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00]
    p_low = 0.02425

    def poly(coefs, x):
        out = F.lit(coefs[0])
        for k in coefs[1:]:
            out = out * x + F.lit(k)
        return out

    q_lo = F.sqrt(-2 * F.log(p))
    lower = poly(c, q_lo) / (poly(d, q_lo) * q_lo + 1)
    q_hi = F.sqrt(-2 * F.log(1 - p))
    upper = -poly(c, q_hi) / (poly(d, q_hi) * q_hi + 1)
    q = p - 0.5
    rr = q * q
    central = poly(a, rr) * q / (poly(b, rr) * rr + 1)
    return F.when(p < p_low, lower).when(p > 1 - p_low, upper).otherwise(central)


def qq_points(df: DataFrame, col: str, id_col: str = "customer_id") -> DataFrame:
    """Ordered values vs normal quantiles at Filliben's order-statistic
    medians, plus the least-squares line (slope, intercept, r)."""
    ranked = global_rank(df.select(id_col, col).where(F.col(col).isNotNull()),
                         [F.col(col).asc(), F.col(id_col).asc()], "i")
    n = df.where(F.col(col).isNotNull()).agg(F.count("*").alias("n"))
    j = ranked.crossJoin(F.broadcast(n))
    last = F.pow(F.lit(0.5), F.lit(1.0) / F.col("n"))
    m = (F.when(F.col("i") == F.col("n"), last)
          .when(F.col("i") == 1, F.lit(1.0) - last)
          .otherwise((F.col("i") - 0.3175) / (F.col("n") + 0.365)))
    pts = j.select("i", m.alias("probability"), inv_norm(m).alias("theoretical"), F.col(col).alias("ordered"))
    line = pts.agg(F.regr_slope("ordered", "theoretical").alias("slope"),
                   F.regr_intercept("ordered", "theoretical").alias("intercept"),
                   F.corr("ordered", "theoretical").alias("r"))
    return pts.crossJoin(F.broadcast(line))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max (last bin closed on the right)."""
    v = F.col(col)
    mm = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo"))
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    j = df.where(v.isNotNull()).crossJoin(F.broadcast(mm))
    counts = j.groupBy(b.alias("bin"), "_lo", "_hi").agg(F.count("*").alias("count"))
    return counts.select("bin", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins)
                         .alias("bin_low"),
                         (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins)
                         .alias("bin_high"), "count")


def histograms(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """T10 for several columns: bins of equal width with each column's mean, median and skewness.

    One aggregate for all ranges and marks, the exact medians, and one pass
    that counts (column, bin). Null values are in no bin; a column without
    values has none; a column of one value has bin 0 alone.
    """
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    marks = wide.agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.min(c).alias("_lo"), F.max(c).alias("_hi"), F.avg(c).alias("mean"),
        F.skewness(c).alias("skew")) for c in cols]).alias("_m")).select(F.inline("_m"))
    medians = exact_quantiles(wide, cols).unpivot([], cols, "column", "median")
    marks = marks.join(F.broadcast(medians), "column")      # a row a column
    values = wide.unpivot([], cols, "column", "_v").where(F.col("_v").isNotNull())
    width = F.col("_hi") - F.col("_lo")
    place = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    counts = values.join(F.broadcast(marks.select("column", "_lo", "_hi")), "column") \
        .groupBy("column", place.alias("bin")).agg(F.count("*").alias("count"))
    edge = lambda b: F.col("_lo") + width * b / bins
    return counts.join(F.broadcast(marks), "column").select(
        "column", "bin", edge(F.col("bin")).alias("bin_low"), edge(F.col("bin") + 1).alias("bin_high"),
        "count", "mean", "median", "skew")


def spearman_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Spearman matrix, long as (row, col, value): Pearson of tie-averaged ranks.

    Ranks are taken at the grain of distinct (column, value) pairs, all columns
    in one global order, so tied rows are counted instead of gathered; rows
    get their ranks by a join that AQE may split where a value is common.
    """
    rows = df.select(F.monotonically_increasing_id().alias("_id"),
                     *[F.col(c).cast("double").alias(c) for c in cols])
    long = reliable_checkpoint(rows.unpivot(["_id"], cols, "_c", "_v"))
    counts = long.where("_v is not null").groupBy("_c", "_v").agg(F.count("*").alias("_n"))
    before = global_rank(counts, [F.col("_c"), F.col("_v")], "_r", {"_before": "_n"})
    start = before.groupBy("_c").agg(F.min("_before").alias("_start"))  # a row a column
    ranks = before.join(F.broadcast(start), "_c").select(
        "_c", "_v", (F.col("_before") - F.col("_start") + (F.col("_n") + 1) / 2.0).alias("_rank"))
    wide = long.join(ranks, ["_c", "_v"]).groupBy("_id").agg(
        *[F.max(F.when(F.col("_c") == c, F.col("_rank"))).alias(c) for c in cols])
    pairs = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.corr(a, b).alias("value"))
             for a in cols for b in cols]
    return wide.agg(F.array(*pairs).alias("_m")).select(F.inline("_m"))


def pearson_with(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, one aggregate."""
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return agg.unpivot([], cols, "feature", "correlation")


def skew_of(df: DataFrame, col: str):
    """Population skewness (bias not corrected, as scipy's default)."""
    return df.agg(F.skewness(col).alias("skew"))
