"""Folds, splits and MLlib models.

Fold and split membership comes from md5 hashes of ids, so it is the same in
every layout and in SQL. The exact-stratified variants rank rows by
(label, hash, id) with the distributed global rank and take the rank within
the label modulo k. Model fits are MLlib pipelines fitted inside each fold
(preprocessing included, M15); fold metrics use the exact AUC of
``operators.threshold``.
"""

from __future__ import annotations

import contextlib
import math
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import NORMAL_975, norm_sf2
from ..functions.hashing import hash32
from ..session import stored
from . import fold_gram
from .rank import global_rank
from .threshold import auc_value

SEED = 42
N_FOLDS = 5
TEST_SHARE = 0.25
# Model settings of the reference.
RF_TREES, RF_DEPTH = 300, 4
GBT_ROUNDS, GBT_DEPTH, GBT_STEP = 300, 3, 0.05
GBR_ROUNDS, GBR_DEPTH, GBR_STEP = 200, 2, 0.05
RIDGE_ALPHA = 1.0


def stratified_folds(df: DataFrame, label: str, k: int = N_FOLDS, seed: int = SEED,
                     id_col: str = "customer_id", out: str = "fold") -> DataFrame:
    """K1: exact stratified k-fold: within each label, rows ordered by
    (hash(seed-id), id) are dealt round-robin into k folds."""
    h = hash32(str(seed), F.col(id_col))
    ranked = global_rank(df.withColumn("_h", h), [F.col(label).asc(), F.col("_h").asc(),
                                                  F.col(id_col).asc()], "_r")
    counts = df.groupBy(label).agg(F.count("*").alias("_c"))
    # one row per label value: a bounded frame
    offs = counts.select(label, F.coalesce(F.sum("_c").over(
        Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = ranked.join(F.broadcast(offs), label)
    return j.withColumn(out, F.pmod(F.col("_r") - F.col("_off") - 1, F.lit(k)).cast("int")) \
            .drop("_h", "_r", "_off")


def stratified_split(df: DataFrame, label: str, share: float = TEST_SHARE, seed: int = SEED,
                     id_col: str = "customer_id", out: str = "is_test") -> DataFrame:
    """K2: exact stratified hold-out: the first bround(share·n_label) rows of each
    label in (hash, id) order are the test set."""
    h = hash32(str(seed), F.col(id_col))
    ranked = global_rank(df.withColumn("_h", h), [F.col(label).asc(), F.col("_h").asc(),
                                                  F.col(id_col).asc()], "_r")
    counts = df.groupBy(label).agg(F.count("*").alias("_c"))
    offs = counts.select(label, "_c", F.coalesce(F.sum("_c").over(
        Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    j = ranked.join(F.broadcast(offs), label)
    within = F.col("_r") - F.col("_off")
    return j.withColumn(out, (within <= F.bround(F.col("_c") * F.lit(share), 0)).cast("int")) \
            .drop("_h", "_r", "_off", "_c")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """M3: balanced weights n / (2·n_c) per class."""
    n = df.agg(F.count("*").alias("_n"))
    c = df.groupBy(label).agg(F.count("*").alias("n_class"))
    return c.crossJoin(F.broadcast(n)).select(
        label, "n_class", (F.col("_n") / (F.lit(2.0) * F.col("n_class"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label)  # ≤ 2 rows


def _logistic(features, label, n_train, weight_col=None):
    stages = [VectorAssembler(inputCols=features, outputCol="_raw"),
              StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)]
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / n_train,
                            elasticNetParam=0.0, standardization=False, maxIter=100)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=stages + [lr])


def classifier(name: str, features, label, n_train, rounds_scale: float = 1.0):
    """M2/M3/M4/M5 pipelines by name."""
    if name == "logistic":
        return _logistic(features, label, n_train)
    if name == "logistic_balanced":
        return _logistic(features, label, n_train, "weight")
    vec = VectorAssembler(inputCols=features, outputCol="features")
    if name == "random_forest":
        return Pipeline(stages=[vec, RandomForestClassifier(
            labelCol=label, numTrees=RF_TREES, maxDepth=RF_DEPTH, seed=SEED)])
    if name == "gradient_boosting":
        return Pipeline(stages=[vec, GBTClassifier(
            labelCol=label, maxIter=max(1, int(GBT_ROUNDS * rounds_scale)), maxDepth=GBT_DEPTH,
            stepSize=GBT_STEP, seed=SEED)])
    raise ValueError(name)


MODEL_NAMES = ["logistic", "logistic_balanced", "random_forest", "gradient_boosting"]


def positive_probability(pred: DataFrame, out: str = "p") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


def _fold_metrics(name, model, test, label):
    pred = positive_probability(model.transform(test))
    auc = auc_value(pred, "p", label).collect()[0]["auc"]
    acc = pred.agg(F.avg(((F.col("p") >= 0.5).cast("int") == F.col(label)).cast("double"))
                   .alias("a")).collect()[0]["a"]
    return auc, acc


def _turn(name: str) -> int:
    """Place in the order of fits: the longest chain first, those that wait for each other last."""
    return {"gradient_boosting": 0, "random_forest": 2}.get(name, 1)


def compare_models(frame: DataFrame, features, label, names=MODEL_NAMES, k=N_FOLDS,
                   rounds_scale: float = 1.0, threads: int = 8) -> list[dict]:
    """M6: stratified k-fold AUC mean/std (population) and accuracy per model.

    The fold-labelled frame is persisted once; the k·models fits run from a
    small thread pool (each fit is itself a distributed job). Boosting starts
    first, as its rounds are the longest chain of jobs and the other fits run
    beside it. Forests are fitted one at a time: each holds its rows with a
    bootstrap weight for every tree."""
    folded = stratified_folds(frame, label, k).persist()
    jobs = []
    for name in sorted(names, key=_turn):
        for f in range(k):
            jobs.append((name, f))
    forest = threading.Lock()

    def run(job):
        name, f = job
        train = folded.where(F.col("fold") != f)
        test = folded.where(F.col("fold") == f)
        n_train = train.count()
        if name == "logistic_balanced":
            train = with_class_weight(train.drop("weight"), label)
        with forest if name == "random_forest" else contextlib.nullcontext():
            model = classifier(name, features, label, n_train, rounds_scale).fit(train)
        return (name, f) + _fold_metrics(name, model, test, label)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        results = list(pool.map(run, jobs))
    folded.unpersist()
    out = []
    for name in names:
        aucs = [r[2] for r in results if r[0] == name]
        accs = [r[3] for r in results if r[0] == name]
        mean = sum(aucs) / len(aucs)
        std = math.sqrt(sum((a - mean) ** 2 for a in aucs) / len(aucs))
        out.append({"model": name, "auc_mean": mean, "auc_std": std,
                    "accuracy_mean": sum(accs) / len(accs), "fold_aucs": aucs})
    out.sort(key=lambda r: (-r["auc_mean"], r["model"]))
    return out


def out_of_fold(frame: DataFrame, features, label, k=N_FOLDS) -> DataFrame:
    """M8: each row scored by a logistic model that did not see it (the k
    fold fits are independent jobs, run from a thread pool)."""
    folded = stored(stratified_folds(frame, label, k))

    def fit(f):
        train = folded.where(F.col("fold") != f)
        return _logistic(features, label, train.count()).fit(train)

    with ThreadPoolExecutor(max_workers=k) as pool:
        fitted = list(pool.map(fit, range(k)))
    parts = [positive_probability(m.transform(folded.where(F.col("fold") == f))).select(
        "customer_id", "fold", label, F.col("p").alias("oof_probability"))
        for f, m in enumerate(fitted)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def logit_inference(frame: DataFrame, label: str, features: list[str]) -> dict:
    """T7 building block: binomial GLM with Wald SE, z p-values and 95% CI."""
    vec = VectorAssembler(inputCols=features, outputCol="features").transform(frame)
    glr = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label,
                                      maxIter=100, tol=1e-10)
    m = glr.fit(vec)
    s = m.summary
    coefs = list(m.coefficients) + [m.intercept]
    ses = list(s.coefficientStandardErrors)
    names = features + ["Intercept"]
    out = {}
    for name, b, se in zip(names, coefs, ses):
        b, se = float(b), float(se)
        out[name] = {"coef": b, "se": se, "p": norm_sf2(b / se) if se > 0 else float("nan"),
                     "ci": (b - NORMAL_975 * se, b + NORMAL_975 * se)}
    return out


def fitted_logistic_coefficients(frame: DataFrame, features, label) -> dict:
    """Standardised logistic fit; coefficient per feature."""
    frame = frame.select(*features, label)
    model = _logistic(features, label, frame.count()).fit(frame)
    return dict(zip(features, [float(c) for c in model.stages[-1].coefficients]))


def _fold_block(frame: DataFrame, target: str, numeric, categorical, k: int):
    """The rows' block with hashed folds, written once, and its Gram matrix by fold."""
    folded = frame.where(F.col(target).isNotNull()).withColumn(
        "fold", F.pmod(hash32(str(SEED), F.col("customer_id")), F.lit(k)).cast("int"))
    rows, facts = fold_gram.block(folded, list(numeric), list(categorical), target)
    rows = stored(rows)
    return rows, fold_gram.fold_grams(rows, facts)


def linear_fold_r2(frame: DataFrame, target: str, numeric, categorical, one_feature,
                   k=N_FOLDS) -> dict[str, dict[int, float]]:
    """R² by fold of the mean baseline, the one-feature model and Ridge."""
    rows, facts = _fold_block(frame, target, numeric, categorical, k)
    return fold_gram.out_of_fold(facts, fold_gram.training_medians(rows, facts), one_feature, RIDGE_ALPHA)


def regressor_cv(frame: DataFrame, target: str, numeric, categorical, one_feature, k=N_FOLDS,
                 rounds_scale: float = 1.0) -> list[dict]:
    """5-fold R² of a mean baseline, a one-feature linear model, Ridge and gradient
    boosting, the latter two on the same block: numbers with gaps filled by the training
    median, and a 0/1 column for every category level. The linear ones come from one
    Gram matrix a fold (``fold_gram``)."""
    rows, facts = _fold_block(frame, target, numeric, categorical, k)
    medians = fold_gram.training_medians(rows, facts)
    results = fold_gram.out_of_fold(facts, medians, one_feature, RIDGE_ALPHA)
    levels = [f"_l{i}" for i in range(len(facts.levels))]

    def boosted(f):
        own = rows.na.fill(medians.get(f, {}))
        model = Pipeline(stages=[
            VectorAssembler(inputCols=[*numeric, *levels], outputCol="features"),
            GBTRegressor(labelCol=target, maxIter=max(1, int(GBR_ROUNDS * rounds_scale)), maxDepth=GBR_DEPTH,
                         stepSize=GBR_STEP, seed=SEED)]).fit(own.where(F.col("fold") != f))
        scored = model.transform(own.where(F.col("fold") == f))
        r = scored.agg(F.sum((F.col(target) - F.col("prediction")) ** 2).alias("sse"),
                       (F.var_pop(target) * F.count(target)).alias("sst")).first()
        return 1.0 - r["sse"] / r["sst"] if r["sst"] else float("nan")

    folds = sorted(facts.grams)
    with ThreadPoolExecutor(max_workers=k) as pool:
        results["gradient_boosting"] = dict(zip(folds, pool.map(boosted, folds)))
    out = []
    for name, by_fold in results.items():
        vals = [by_fold[f] for f in folds]
        mean = sum(vals) / len(vals)
        std = math.sqrt(sum((v - mean) ** 2 for v in vals) / len(vals))
        out.append({"model": name, "r2_mean": mean, "r2_std": std, "fold_r2": vals, "folds": folds})
    return out


def grouped_auc(df: DataFrame, group: str, score: str, label: str, group_size: int,
                positives: int, negatives: int) -> DataFrame:
    """Exact tie-aware AUC per group, for groups that all hold ``group_size``
    rows with the same class counts (permutation replicas of one hold-out).

    Mann-Whitney on average ranks: scores are reduced to (group, score) counts,
    globally ranked by (group, score), and the rows before each score inside
    its group are the distributed cumulative count minus ``group·group_size``.
    No group is ever gathered into one task."""
    c = df.groupBy(group, score).agg(
        F.count("*").alias("_cnt"), F.count_if(F.col(label) == 1).alias("_pos"))
    cum = global_rank(c, [F.col(group).asc(), F.col(score).asc()], "_r", {"_before_all": "_cnt"})
    before = F.col("_before_all") - F.col(group).cast("long") * F.lit(group_size)
    avg_rank = before + (F.col("_cnt") + 1) / 2.0
    p, n = float(positives), float(negatives)
    return cum.groupBy(group).agg(F.sum(F.col("_pos") * avg_rank).alias("_rs")).select(
        group, ((F.col("_rs") - F.lit(p * (p + 1) / 2.0)) / F.lit(p * n)).alias("auc"))
