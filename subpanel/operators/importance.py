"""Permutation importance (M13) by keyed bijections of ranks.

Shuffling a column of the hold-out means giving the row of rank r the value of
the row of rank pi(r), where pi is a bijection of 0 ... m - 1. Each of the
features x repeats replicas has its own pi, computed from the rank alone: a
Feistel network over ranks written as (left, right) in mixed radix a x b, the
smallest near-square that covers m. Its alternating rounds add a keyed hash of
one half to the other, which is a bijection of a * b; results beyond m walk on
along their cycle until they fall below it. So no replica is sorted, written
or numbered: rows are fanned out, meet their donor's value in one narrow join
by (feature, rank), and are scored again. The bijections are array code over
Arrow batches: as a column expression (``shuffled_rank``, which states the
same) each use of an intermediate value is computed anew for every row.

The scorer is linear in the features (a margin and its weights), either with
given weights or fitted on the other 75 % of the rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .models import _logistic, grouped_auc, stratified_split
from .rank import global_rank

REPEATS = 30
ROUNDS = 4
PRIME = (1 << 31) - 1
FACTOR = 48_271
ROWS = 2000    # rows a task fans out by all replicas
WALK = 64      # steps of a cycle walk that are written out; each misses with a chance below 1 / sqrt(m)


def round_keys(feature: str, repeat: int) -> list[int]:
    """Keys of a replica's rounds."""
    return [int(hashlib.md5(f"perm-{feature}:{repeat}:{i}".encode()).hexdigest()[:8], 16) % PRIME
            for i in range(ROUNDS)]


def radix(m: int) -> tuple[int, int]:
    """The halves' sizes a, b: a * b >= m > a * b - a."""
    a = math.isqrt(max(m - 1, 0)) + 1
    return a, -(-m // a) or 1


def _mixed(value: Column, key: Column) -> Column:
    prime = F.lit(PRIME)
    t = (value + key) % prime
    t = (t * t % prime * F.lit(FACTOR) + key) % prime
    return t * t % prime


def shuffled_rank(rank: Column, keys: Column, m: int) -> Column:
    """pi(rank) for ranks 0 ... m - 1; ``keys`` is an array of ROUNDS longs."""
    a, b = radix(m)

    def step(x: Column) -> Column:
        halves = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), (x % F.lit(b)).alias("r"))

        def turn(h: Column, i: Column) -> Column:
            left = (h["l"] + _mixed(h["r"], keys[i])) % F.lit(a)
            return F.struct(left.alias("l"), ((h["r"] + _mixed(left, keys[i + 1])) % F.lit(b)).alias("r"))
        turns = F.array(*[F.lit(i) for i in range(0, ROUNDS, 2)])
        return F.aggregate(turns, halves, turn, lambda h: h["l"] * F.lit(b) + h["r"])

    walk = min(a * b - m, WALK)
    out = step(rank)
    if walk:
        out = F.aggregate(F.sequence(F.lit(1), F.lit(walk)), out,
                          lambda x, _: F.when(x < m, x).otherwise(step(x)))
    return F.when(out < m, out).otherwise(F.raise_error(F.lit("a cycle walk didn't return")))


def shuffled_ranks(ranks: np.ndarray, keys: list[int], m: int) -> np.ndarray:
    """:func:`shuffled_rank` of an array of ranks."""
    a, b = radix(m)

    def mixed(value: np.ndarray, key: int) -> np.ndarray:
        t = (value + key) % PRIME
        t = (t * t % PRIME * FACTOR + key) % PRIME
        return t * t % PRIME

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for i in range(0, ROUNDS, 2):
            left = (left + mixed(right, keys[i])) % a
            right = (right + mixed(left, keys[i + 1])) % b
        return left * b + right

    out = step(ranks.astype(np.int64))
    while len(beyond := np.nonzero(out >= m)[0]):    # ends: a bijection's cycle returns below m
        out[beyond] = step(out[beyond])
    return out


def _fanned(batches: Iterator[pa.RecordBatch], grid: list[tuple[int, str, float, list[int]]], m: int, margin: str,
            label: str) -> Iterator[pa.RecordBatch]:
    """(gidx, f, donor, label, margin without the replica's feature) of every row and replica."""
    for batch in batches:
        n, ranks = batch.num_rows, batch.column("_r").to_numpy()
        rest = {f: pc.subtract(batch.column(margin), pc.multiply(batch.column(name), weight))
                for f, name, weight, _ in grid[:n and len(grid)]}
        for gidx, (f, *_, keys) in enumerate(grid[:n and len(grid)]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, gidx, np.int32)), pa.array(np.full(n, f, np.int32)),
                 pa.array(shuffled_ranks(ranks, keys, m)), batch.column(label), rest[f]],
                names=["gidx", "f", "donor", label, "rest"])


def _importance(hold: DataFrame, weights: dict, margin: str, label: str, repeats: int) -> DataFrame:
    """Drops in AUC on the hold-out rows (customer_id, label, margin, features)."""
    feats = list(weights)
    counts = hold.agg(F.count("*").alias("m"), F.sum(label).alias("p")).first()
    m, p = int(counts["m"]), int(counts["p"] or 0)
    base = stored(global_rank(hold, [F.col("customer_id").asc()], "_r").withColumn("_r", F.col("_r") - 1))
    grid = [(i, f, float(weights[f]), round_keys(f, r)) for i, f in enumerate(feats) for r in range(repeats)]
    wide = base.select("_r", label, F.col(margin).cast("double").alias(margin),
                       *[F.col(f).cast("double").alias(f) for f in feats])
    long = wide.repartition(-(-m // ROWS) or 1).mapInArrow(
        lambda batches: _fanned(batches, grid, m, margin, label),
        f"gidx int, f int, donor long, {label} {base.schema[label].dataType.simpleString()}, rest double")
    own = F.array(*[F.lit(float(weights[f])) * F.col(f) for f in feats])
    donors = wide.select(F.col("_r").alias("donor"), F.posexplode(own).alias("f", "shuffled"))
    rescored = long.join(donors.hint("merge"), ["f", "donor"]).select(
        "gidx", label, (F.col("rest") + F.col("shuffled")).alias("m2"))
    aucs = grouped_auc(rescored, "gidx", "m2", label, m, p, m - p)
    base_auc = grouped_auc(base.select(F.lit(0).alias("gidx"), F.col(margin).alias("m2"), label),
                           "gidx", "m2", label, m, p, m - p).select(F.col("auc").alias("base_auc"))
    names = F.array(*[F.lit(f) for f in feats])
    return aucs.crossJoin(F.broadcast(base_auc)).select(      # one row
        names[F.floor(F.col("gidx") / repeats).cast("int")].alias("feature"),
        (F.col("base_auc") - F.col("auc")).alias("drop"), "base_auc").groupBy("feature").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"),
        F.first("base_auc").alias("base_auc"))


def _with_truth(importance: DataFrame, truth: dict) -> DataFrame:
    known = [x for f, w in truth.items() for x in (F.lit(f), F.lit(float(w)))]
    return importance.withColumn("true_coefficient", F.create_map(*known)[F.col("feature")])


def permutation_importance(scored: DataFrame, weights: dict, margin: str = "logit", label: str = "label",
                           repeats: int = REPEATS) -> DataFrame:
    """M13 for a given linear scorer, on the exact stratified 25 % hold-out (K2)."""
    hold = stratified_split(scored.select("customer_id", label, margin, *weights), label) \
        .where("is_test = 1").drop("is_test")
    return _with_truth(_importance(hold, weights, margin, label, repeats), weights)


def fitted_importance(frame: DataFrame, features: list[str], truth: dict, label: str = "label",
                      repeats: int = REPEATS) -> DataFrame:
    """M13 of the logistic model fitted on the 75 % and scored on the 25 % it hasn't seen,
    most important feature first; ``truth`` names features' real effects (others: null)."""
    split = stored(stratified_split(frame.select("customer_id", label, *features), label))
    train = split.where("is_test = 0")
    *_, scaler, model = _logistic(features, label, train.count()).fit(train).stages
    weights = {f: float(c / s) if s else 0.0 for f, c, s in
               zip(features, model.coefficients, scaler.std, strict=True)}
    margin = sum((F.lit(w) * F.col(f) for f, w in weights.items()), F.lit(0.0))
    hold = split.where("is_test = 1").drop("is_test").withColumn("margin", margin)
    out = _with_truth(_importance(hold, weights, "margin", label, repeats), truth)
    return out.orderBy(F.desc("importance_mean"), "feature")
