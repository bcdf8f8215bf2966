"""Out-of-fold least squares from one Gram matrix a fold.

One aggregate takes, for every fold, the sums of products of a row's block:
the constant, each number (0 where it is missing), a flag where numbers are
missing, a 0/1 column for each category level, and the target. A training set
is all folds' matrices less its own test fold's, so mean, one-feature and Ridge
models of all folds are solved, and scored on their test folds, without
another look at the rows: filling a gap by the training median adds median
times the flag, and a residual's square sum is a quadratic form.

The block is bounded by the columns and the category levels; the driver sees
one such matrix a fold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEDIAN_ERROR = 0.001    # relative rank error of training medians (only where numbers are missing)


@dataclass
class FoldGram:
    """Gram matrices by fold over columns [1, numbers, flags, levels, y], numbers and y about ``centre``."""

    grams: dict[int, np.ndarray]
    numeric: list[str]
    gaps: list[str]
    levels: list[tuple[str, str]]
    centre: dict[str, float]
    target: str

    @property
    def total(self) -> np.ndarray:
        return sum(self.grams.values())


def block(frame: DataFrame, numeric: list[str], categorical: list[str], target: str) -> tuple[DataFrame, FoldGram]:
    """The frame with its 0/1 level columns (``_l0``, ...) and flags (``_g_name``), and an empty FoldGram."""
    facts = frame.agg(*[F.avg(c).alias(f"m_{c}") for c in [*numeric, target]],
                      *[F.count_if(F.col(c).isNull()).alias(f"g_{c}") for c in numeric]).first()
    centre = {c: float(facts[f"m_{c}"] or 0.0) for c in [*numeric, target]}
    gaps = [c for c in numeric if facts[f"g_{c}"]]
    levels = [(c, r[0]) for c in categorical
              for r in frame.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).collect()]
    out = frame.select("*", *[(F.coalesce(F.col(c) == v, F.lit(False))).cast("double").alias(f"_l{i}")
                              for i, (c, v) in enumerate(levels)],
                       *[F.col(c).isNull().cast("double").alias(f"_g_{c}") for c in gaps])
    return out, FoldGram({}, numeric, gaps, levels, centre, target)


def fold_grams(frame: DataFrame, facts: FoldGram, fold: str = "fold") -> FoldGram:
    """Fills in the Gram matrices: one aggregate over the rows."""
    about = lambda c: F.coalesce(F.col(c).cast("double") - F.lit(facts.centre[c]), F.lit(0.0))
    columns = [F.lit(1.0), *map(about, facts.numeric), *[F.col(f"_g_{c}") for c in facts.gaps],
               *[F.col(f"_l{i}") for i in range(len(facts.levels))], about(facts.target)]
    p = len(columns)
    at = [(i, j) for i in range(p) for j in range(i, p)]
    for r in frame.groupBy(fold).agg(*[F.sum(columns[i] * columns[j]).alias(f"p{i}_{j}") for i, j in at]).collect():
        gram = np.zeros((p, p))
        for i, j in at:
            gram[i, j] = gram[j, i] = r[f"p{i}_{j}"]
        facts.grams[r[fold]] = gram
    return facts


def _filled(facts: FoldGram, medians: dict[str, float]) -> np.ndarray:
    """Maps block columns to [1, filled numbers, levels, y]."""
    q, g, l = len(facts.numeric), len(facts.gaps), len(facts.levels)  # noqa: E741
    out = np.zeros((2 + q + g + l, 2 + q + l))
    for to, of in enumerate([0, *range(1, 1 + q), *range(1 + q + g, 2 + q + g + l)]):
        out[of, to] = 1.0
    for i, c in enumerate(facts.gaps):
        out[1 + q + i, 1 + facts.numeric.index(c)] = medians[c] - facts.centre[c]
    return out


def ridge(gram: np.ndarray, columns: list[int], scaled: list[int], alpha: float) -> np.ndarray:
    """Weights (constant first, as long as the block less y) of a penalised fit on ``columns``;
    ``scaled`` ones are standardised first, so the penalty sees their spread as 1."""
    n, y = gram[0, 0], len(gram) - 1
    weights = np.zeros(y)
    mean = gram[0] / n
    if columns:
        cross = gram[np.ix_(columns, columns)] - n * np.outer(mean[columns], mean[columns])
        toward = gram[columns, y] - n * mean[columns] * mean[y]
        spread = np.array([math.sqrt(max(cross[i, i], 0) / n) or 1.0 if c in scaled else 1.0
                           for i, c in enumerate(columns)])
        system = cross / np.outer(spread, spread) + alpha * np.eye(len(columns))
        weights[columns] = np.linalg.lstsq(system, toward / spread, rcond=None)[0] / spread
    weights[0] = mean[y] - weights[columns] @ mean[columns]
    return weights


def r_squared(gram: np.ndarray, weights: np.ndarray) -> float:
    """R² of a linear fit on the rows that ``gram`` sums up; nan without spread."""
    y = len(gram) - 1
    v = np.append(-weights, 1.0)
    spread = gram[y, y] - gram[0, y] ** 2 / gram[0, 0] if gram[0, 0] else 0.0
    return float(1.0 - v @ gram @ v / spread) if spread > 0 else float("nan")


def out_of_fold(facts: FoldGram, medians: dict[int, dict[str, float]], one_feature: str,
                alpha: float) -> dict[str, dict[int, float]]:
    """R² on each test fold of the mean, the one-feature fit and the Ridge fit on the other folds."""
    q, l = len(facts.numeric), len(facts.levels)  # noqa: E741
    numbers = list(range(1, 1 + q))
    plans = {"mean_baseline": ([], 0.0), "one_feature_linear": ([1 + facts.numeric.index(one_feature)], 0.0),
             "ridge": (list(range(1, 1 + q + l)), alpha)}
    out: dict[str, dict[int, float]] = {name: {} for name in plans}
    for fold, test in facts.grams.items():
        to = _filled(facts, medians.get(fold, {}))
        train, test = to.T @ (facts.total - test) @ to, to.T @ test @ to
        for name, (columns, penalty) in plans.items():
            out[name][fold] = r_squared(test, ridge(train, columns, numbers, penalty)) if train[0, 0] else float("nan")
    return out


def training_medians(frame: DataFrame, facts: FoldGram, fold: str = "fold") -> dict[int, dict[str, float]]:
    """Median of each gappy column in each fold's training set."""
    if not facts.gaps:
        return {}
    out = {}
    for f in facts.grams:
        found = frame.where(F.col(fold) != f).approxQuantile(facts.gaps, [0.5], MEDIAN_ERROR)
        out[f] = {c: v[0] if v else facts.centre[c] for c, v in zip(facts.gaps, found, strict=True)}
    return out
