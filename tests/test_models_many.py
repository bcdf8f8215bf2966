import numpy as np
import pytest
from pyspark.sql import functions as F

from subpanel.operators import cluster, fold_gram, importance, lloyd, models


@pytest.mark.parametrize("m", [1, 2, 3, 7, 64, 375, 1000])
def test_shuffled_ranks_are_bijections(spark, m):
    keys = [F.array(*[F.lit(k).cast("long") for k in importance.round_keys("x", r)]) for r in range(3)]
    rows = spark.range(m).select("id", *[importance.shuffled_rank(F.col("id"), k, m).alias(f"p{i}")
                                         for i, k in enumerate(keys)]).collect()
    for i in range(3):
        assert sorted(r[f"p{i}"] for r in rows) == list(range(m))
    if m > 300:
        moved = np.array([[r[f"p{i}"] for i in range(3)] for r in rows])
        assert np.abs(np.corrcoef(np.column_stack((np.arange(m), moved)), rowvar=False) - np.eye(4)).max() < 0.15
        assert (moved[:, 0] != moved[:, 1]).mean() > 0.9


def test_fitted_importance_finds_the_feature_that_matters(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 3))
    label = (2.0 * x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=1200) * 0.5 > 0).astype(int)
    frame = spark.createDataFrame([(i, int(label[i]), *map(float, x[i]), 1.0) for i in range(1200)],
                                  "customer_id long, label int, a double, b double, c double, d double")
    rows = importance.fitted_importance(frame, ["a", "b", "c", "d"], {"a": 2.0}, repeats=5).collect()
    by = {r["feature"]: r for r in rows}
    assert rows[0]["feature"] == "a" and by["a"]["importance_mean"] > 0.2 > by["b"]["importance_mean"] > 0.005
    assert abs(by["c"]["importance_mean"]) < 0.01 and by["d"]["importance_mean"] == 0
    assert by["a"]["true_coefficient"] == 2.0 and by["b"]["true_coefficient"] is None


def points(spark, n=400):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(n // 4, 6)) + 3 * rng.normal(size=6) for _ in range(4)])
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "customer_id long, " + ", ".join(
        f"{c} double" for c in cluster.Z_FEATURES))


def test_lloyd_step_and_inertia(spark):
    from pyspark.ml.clustering import KMeans

    x, frame = points(spark)
    starts = [x[:3].copy(), x[[5, 150]].copy()]
    for centres, (n, sums, inertia) in zip(starts, lloyd.step(frame, cluster.Z_FEATURES, starts), strict=True):
        square = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        near = square.argmin(axis=1)
        assert n.tolist() == np.bincount(near, minlength=len(centres)).tolist()
        assert np.allclose(sums, [x[near == i].sum(axis=0) for i in range(len(centres))])
        assert np.isclose(inertia, square.min(axis=1).sum())
    best = lloyd.fit(frame, cluster.Z_FEATURES, [(k, s) for k in (2, 4) for s in range(4)], group=lambda k, _: k)
    vec = cluster.vectors(frame)
    for k in (2, 4):
        theirs = min(KMeans(k=k, seed=s, maxIter=300, tol=1e-4).fit(vec).summary.trainingCost for s in range(4))
        assert best[k].inertia <= theirs * (1 + 1e-9)
    again = lloyd.fit(frame.repartition(7), cluster.Z_FEATURES, [(4, 0)], group=lambda k, _: k)
    once = lloyd.fit(frame, cluster.Z_FEATURES, [(4, 0)], group=lambda k, _: k)
    assert np.allclose(again[4].centres, once[4].centres)


def test_lloyd_step_takes_models_of_several_sizes_together():
    x, rng = np.random.default_rng(3).integers(-2, 3, (700, 6)).astype(float), np.random.default_rng(4)
    models = [rng.integers(-2, 3, (k, 6)).astype(float) for k in (2, 2, 5, 2, 1)]     # many ties
    models.append(models[2][[0, 0, 1]])     # one centre twice
    slots = np.cumsum([0, *map(len, models)])
    total = np.zeros((slots[-1], 8))
    for at in range(0, len(x), 300):
        lloyd._add_slice(total, x[at:at + 300], np.concatenate(models), slots)
    for centres, a, b in zip(models, slots, slots[1:], strict=False):
        square = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        near = square.argmin(axis=1)
        assert total[a:b, 0].tolist() == np.bincount(near, minlength=len(centres)).tolist()
        assert total[a:b, 1].sum() == square.min(axis=1).sum()
        assert total[a:b, 2:].tolist() == [x[near == i].sum(axis=0).tolist() for i in range(len(centres))]


def test_best_k_labels_write_the_frame_once(spark):
    _, frame = points(spark)
    labelled = cluster.best_k_labels(frame.withColumn("_at", F.expr("uuid()")))
    plan = labelled._jdf.queryExecution().optimizedPlan().toString()
    assert "uuid" not in plan and "/steps/" in labelled.inputFiles()[0]
    assert labelled.count() == frame.count()


def test_lloyd_on_few_rows(spark):
    _, frame = points(spark)
    assert lloyd.fit(frame.limit(0), cluster.Z_FEATURES, [(2, 0)], group=lambda k, _: k) == {}
    same = frame.limit(1).unionByName(frame.limit(1))
    assert lloyd.fit(same, cluster.Z_FEATURES, [(3, 0)], group=lambda k, _: k)[3].inertia == 0


def test_fold_grams_equal_plain_fits(spark):
    rng = np.random.default_rng(2)
    n = 300
    a, b = rng.normal(size=n) * 5 + 100, rng.normal(size=n)
    gap, level = rng.random(n) < 0.2, rng.integers(0, 3, n)
    y = 0.7 * a - b + level + rng.normal(size=n)
    frame = spark.createDataFrame(
        [(i, float(a[i]), None if gap[i] else float(b[i]), "xyz"[level[i]] if i % 50 else None, float(y[i]), i % 3)
         for i in range(n)], "customer_id long, a double, b double, s string, y double, fold int")
    rows, facts = fold_gram.block(frame, ["a", "b"], ["s"], "y")
    facts = fold_gram.fold_grams(rows, facts)
    medians = fold_gram.training_medians(rows, facts)
    found = fold_gram.out_of_fold(facts, medians, "a", 1.0)
    fold, hot = np.arange(n) % 3, np.array([[level[i] == j and i % 50 > 0 for j in range(3)] for i in range(n)], float)
    for f in range(3):
        train, test = fold != f, fold == f
        filled = np.where(gap, medians[f]["b"], b)
        assert abs(medians[f]["b"] - np.median(b[train & ~gap])) < 0.1
        spread = ((y[test] - y[test].mean()) ** 2).sum()

        def r2(columns, alpha):
            mean, std = columns[train].mean(axis=0), np.ones(columns.shape[1])
            std[:2] = columns[train].std(axis=0)[:2]
            z = (columns - mean) / std
            beta = np.linalg.solve(z[train].T @ z[train] + alpha * np.eye(z.shape[1]),
                                   z[train].T @ (y[train] - y[train].mean()))
            return 1 - ((y[test] - y[train].mean() - z[test] @ beta) ** 2).sum() / spread

        assert np.isclose(found["mean_baseline"][f], 1 - ((y[test] - y[train].mean()) ** 2).sum() / spread)
        assert np.isclose(found["one_feature_linear"][f], r2(a[:, None], 0.0))
        assert np.isclose(found["ridge"][f], r2(np.column_stack((a, filled, hot)), 1.0))


def test_regressors_use_levels_and_gaps(spark):
    rows = [(i, None if i % 7 == 0 else float(i % 11), "pq"[i % 2], 10.0 * (i % 2)) for i in range(400)]
    frame = spark.createDataFrame(rows, "customer_id long, a double, s string, y double")
    got = {r["model"]: r["r2_mean"] for r in models.regressor_cv(frame, "y", ["a"], ["s"], "a", k=2, rounds_scale=0.2)}
    assert got["gradient_boosting"] > 0.8 and got["ridge"] > 0.95 and got["mean_baseline"] < 0.01


def test_boosting_is_fitted_first_and_forests_one_at_a_time(spark, monkeypatch):
    import threading
    import time

    lock, running, begun, most = threading.Lock(), [], [], []

    class Fit:
        def __init__(self, name):
            self.name = name

        def fit(self, train):
            with lock:
                begun.append(self.name)
                running.append(self.name)
                most.append(running.count("random_forest"))
            time.sleep(0.3)
            with lock:
                running.remove(self.name)

    monkeypatch.setattr(models, "classifier", lambda name, *_: Fit(name))
    monkeypatch.setattr(models, "_fold_metrics", lambda name, model, test, label: (len(name) / 100, test.count() / 100))
    frame = spark.createDataFrame([(i, i % 2, float(i)) for i in range(60)], "customer_id long, label int, x double")
    rows = {r["model"]: r for r in models.compare_models(frame, ["x"], "label", k=3)}
    assert begun[0] == "gradient_boosting" and max(most) == 1
    assert {n: begun.count(n) for n in rows} == dict.fromkeys(models.MODEL_NAMES, 3)
    assert all(r["fold_aucs"] == [len(n) / 100] * 3 and abs(r["accuracy_mean"] - 0.2) < 1e-9 for n, r in rows.items())
