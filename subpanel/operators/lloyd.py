"""Many k-means models at once (G2, G7): all restarts advance in one aggregate a Lloyd step.

A model is a (k, seed) pair. Every pass over the rows serves all models that
still move: tasks assign their rows to each model's centres and return counts
and sums by centre, which Spark adds up. What reaches the driver is one row a
centre, whatever the number of rows. Starts follow k-means++: the next centre
is drawn with a chance in proportion to the squared distance from those drawn,
as an exponential race of hashed row numbers - one pass a centre, again for
all models together.

Rows are read from a table written once, so a lost executor costs a reread.
A centre that no row is nearest to stays where it is. Ties go to the lower
centre; draws depend on ids alone, not on the layout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

MAX_STEPS = 300
SLICE = 1 << 16      # distances measured at once, rows by centres
LOOSE = 1e-2         # while restarts compete: a model whose centres move less altogether rests
TIGHT = 1e-5         # for the winners


@dataclass
class Model:
    k: int
    seed: int
    centres: np.ndarray
    inertia: float = float("inf")
    moving: bool = True


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centres)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - centres[None, :, i]) ** 2
    return out


def _uniform(number: np.ndarray, seed: int, draw: int) -> np.ndarray:
    """Hashed uniforms in (0, 1] (splitmix64 finaliser)."""
    salt = (seed * 1_000_003 + draw + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    z = number.astype(np.uint64) ^ np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0 ** -54


def _draw(table: DataFrame, cols: list[str], models: list[Model]) -> None:
    """One further start centre for each of ``models``."""
    width, starts = len(cols), [(m.seed, m.centres) for m in models]

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, number = _rows(batch, width), batch.column(width).to_numpy()
            for i, (seed, centres) in enumerate(starts):
                chance = _squares(x, centres).min(axis=1) if len(centres) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    time = -np.log(_uniform(number, seed, len(centres))) / chance
                at = np.lexsort((number, time))[0]
                best[i] = min(best.get(i, (np.inf, 0, [])), (float(time[at]), int(number[at]), x[at].tolist()))
        rows = [(i, *b) for i, b in best.items() if b[2]]
        columns = zip(*rows, strict=True) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.float64())), strict=True)],
            names=["m", "time", "number", "x"])

    won = table.select(*cols, "number").mapInArrow(race, "m int, time double, number long, x array<double>") \
        .groupBy("m").agg(F.min_by("x", F.struct("time", "number")).alias("x")).collect()
    for r in won:
        models[r["m"]].centres = np.append(models[r["m"]].centres, [r["x"]], axis=0)


def _add_slice(total: np.ndarray, x: np.ndarray, stacked: np.ndarray, slots: np.ndarray) -> None:
    """Add rows ``x`` to each model's counts and sums by centre, and to its inertia.

    Distances lie centre by centre in one block that stays in the cache;
    models of equal k that follow each other are compared together.
    """
    square, term = np.zeros((2, len(stacked), len(x)))
    for i in range(x.shape[1]):
        np.subtract.outer(stacked[:, i], x[:, i], out=term)
        np.multiply(term, term, out=term)
        np.add(square, term, out=square)
    own = term      # its room serves for who belongs to whom
    sizes = np.diff(slots)
    runs = np.flatnonzero(np.diff(sizes, prepend=-1, append=-1))
    for first, last in zip(runs, runs[1:], strict=False):
        k, a, b = sizes[first], slots[first], slots[last]
        to = square[a:b].reshape(last - first, k, len(x))
        least = to[:, 0].copy()
        near = np.zeros(least.shape, np.int16)
        for j in range(1, k):
            np.copyto(near, j, where=to[:, j] < least)
            np.minimum(least, to[:, j], out=least)
        mine = own[a:b].reshape(to.shape)
        for j in range(k):
            mine[:, j] = near == j
        total[a:b:k, 1] += least.sum(axis=1)    # a model's sum is asked for, any of its slots may hold it
    total[:, 0] += own.sum(axis=1)
    total[:, 2:] += own @ x


def step(table: DataFrame, cols: list[str], models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each model's centres: rows by centre, their sums, and the inertia - one aggregate."""
    width = len(cols)
    slots = np.cumsum([0, *map(len, models)])
    stacked = np.concatenate(models)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(stacked), width + 2))
        height = max(1, SLICE // len(stacked))
        for batch in batches:
            x = _rows(batch, width)
            for at in range(0, len(x), height):
                _add_slice(total, x[at:at + height], stacked, slots)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), *[pa.array(np.ascontiguousarray(total[:, i])) for i in range(width + 2)]],
            names=["slot", "n", "d", *[f"s{i}" for i in range(width)]])

    names = ["n", "d", *[f"s{i}" for i in range(width)]]
    rows = table.select(*cols).mapInArrow(sums, "slot long, " + ", ".join(f"{c} double" for c in names)) \
        .groupBy("slot").agg(*[F.sum(c).alias(c) for c in names]).orderBy("slot").collect()
    whole = np.array([[r[c] for c in names] for r in rows]) if rows else np.zeros((len(stacked), width + 2))
    return [(whole[a:b, 0], whole[a:b, 2:], float(whole[a:b, 1].sum()))
            for a, b in zip(slots, slots[1:], strict=False)]


def settle(table: DataFrame, cols: list[str], models: list[Model], tolerance: float) -> None:
    """Lloyd steps for all models until each one's centres move less than ``tolerance`` altogether."""
    for m in models:
        m.moving = True
    for _ in range(MAX_STEPS):
        moving = [m for m in models if m.moving]
        if not moving:
            break
        for m, (n, sums, m.inertia) in zip(moving, step(table, cols, [m.centres for m in moving]), strict=True):
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], m.centres)
            m.moving = bool(((new - m.centres) ** 2).sum() > tolerance ** 2)
            m.centres = new


def fit(frame: DataFrame, cols: list[str], models: list[tuple[int, int]], group, id_col: str = "customer_id") -> dict:
    """The model of least inertia of each group of (k, seed) pairs (ties: the lesser seed).

    ``group`` maps (k, seed) to its group. All restarts run until they move
    little; the winners alone run on to rest. A frame with fewer distinct rows
    than k gives fewer centres; one without rows gives no model.
    """
    table = stored(frame.na.drop(subset=cols).select(
        *[F.col(c).cast("double").alias(c) for c in cols], F.xxhash64(id_col).alias("number")))
    out = [Model(k, seed, np.zeros((0, len(cols)))) for k, seed in models]
    for draw in range(max(k for k, _ in models)):
        _draw(table, cols, [m for m in out if m.k > draw and len(m.centres) == draw])
    out = [m for m in out if len(m.centres)]
    if not out:
        return {}
    settle(table, cols, out, LOOSE)
    best: dict = {}
    for m, (*_, m.inertia) in zip(out, step(table, cols, [m.centres for m in out]), strict=True):
        key = group(m.k, m.seed)
        best[key] = min(best.get(key, m), m, key=lambda x: (x.inertia, x.seed))
    winners = list(best.values())
    settle(table, cols, winners, TIGHT)
    for m, (*_, m.inertia) in zip(winners, step(table, cols, [m.centres for m in winners]), strict=True):
        m.moving = False
    return best
