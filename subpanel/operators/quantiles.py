"""Exact quantiles without gathering a group into one task.

Spark's ``median``/``percentile`` keep a map of every distinct value of a
group in one aggregation buffer; for a continuous column over a whole fact
table that is the whole column in one task. Here a mergeable quantile sketch
(``percentile_approx``) brackets every target of every column in one pass over
the pruned columns, and one counting pass gathers the distinct values inside
the brackets with their counts, and the number of values below, so that the
order statistics are read off exactly. Nothing is unpivoted or persisted.

Two passes do up to about 10^8 values. Where a bracket still holds more than
``GATHERED`` values, a pass counts it and sketches its inside again, which
leaves about one part in 700: three passes up to about 10^11 values. A sketch
only steers; a bracket that turns out to miss its rank is moved to the side
where the rank is. The driver sees at most targets × ``GATHERED`` distinct
values.

Interpolation follows pandas / Spark ``median``: position ``h = (n-1)q``,
value ``x[floor h] + (h - floor h)(x[ceil h] - x[floor h])``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GATHERED = 100_000
SKETCH = 5    # sketch accuracy over cells


@dataclass
class _Target:
    group: str
    column: str
    n: int
    low: int           # ranks of the two order statistics, from 0
    high: int
    part: float        # how far between them
    least: float
    most: float
    lo: float          # the bracket
    hi: float
    expected: float    # values strictly inside the bracket, as far as known
    value: float | None = None


def _value(column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def _group_key(group_cols) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in group_cols])) if group_cols else F.lit("")


def _of_group(target: _Target, group_cols) -> Column:
    return F.col("_group") == F.lit(target.group) if group_cols else F.lit(True)


def _gather(rows: DataFrame, targets: list[_Target], group_cols) -> dict[int, tuple[int, list]]:
    """For each target the number of values below its bracket, and (value, count) inside, in order.

    A row is fanned out to the targets whose bracket it is in or below; values
    below share one key, so that they are added up before the exchange.
    """
    hits = [F.when(_of_group(t, group_cols) & (_value(t.column) <= F.lit(t.hi)), F.struct(
        F.lit(i).alias("target"),
        F.when(_value(t.column) >= F.lit(t.lo), _value(t.column)).alias("value")))
        for i, t in enumerate(targets)]
    counted = rows.select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h")) \
        .groupBy("h.target", "h.value").agg(F.count("*").alias("n")).collect()
    out = {i: [0, []] for i in range(len(targets))}
    for row in counted:
        if row["value"] is None:
            out[row["target"]][0] = row["n"]
        else:
            out[row["target"]][1].append((row["value"], row["n"]))
    return {i: (below, sorted(inside)) for i, (below, inside) in out.items()}


def _settle(target: _Target, below: int, inside: list) -> None:
    """The target's value, or a bracket on the side where its ranks are."""
    total = below + sum(n for _, n in inside)
    if target.low < below:
        target.lo, target.expected = target.least, math.inf
    if target.high >= total:
        target.hi, target.expected = target.most, math.inf
    if target.low < below or target.high >= total:
        return
    found, seen = {}, below
    for value, n in inside:
        for rank in (target.low, target.high):
            if seen <= rank < seen + n:
                found[rank] = value
        seen += n
    a, b = found[target.low], found[target.high]
    target.value = a + target.part * (b - a) if target.part else a


def _narrow(rows: DataFrame, targets: list[_Target], group_cols, cells: int) -> None:
    """Count each bracket and sketch its inside; keep the cells that hold the ranks."""
    grid = F.lit(np.linspace(0.0, 1.0, cells + 1))
    aggs = []
    for i, t in enumerate(targets):
        v = F.when(_of_group(t, group_cols), _value(t.column))
        inside = F.when((v >= F.lit(t.lo)) & (v <= F.lit(t.hi)), v)
        aggs += [F.count_if(v < F.lit(t.lo)).alias(f"below{i}"), F.count(inside).alias(f"n{i}"),
                 F.percentile_approx(inside, grid, SKETCH * cells).alias(f"cuts{i}")]
    row = rows.agg(*aggs).collect()[0]
    for i, t in enumerate(targets):
        below, n, cuts = row[f"below{i}"], row[f"n{i}"], row[f"cuts{i}"]
        if t.low < below or t.high >= below + n:
            t.lo = t.least if t.low < below else t.lo
            t.hi = t.most if t.high >= below + n else t.hi
            continue
        first = math.floor((t.low - below) / n * cells) - 1
        last = math.ceil((t.high - below + 1) / n * cells) + 1
        if first <= 0 and last >= cells:    # too few cells to tell the ranks apart: all values are needed
            t.expected = 0.0
            continue
        t.lo = cuts[first] if first > 0 else t.lo
        t.hi = cuts[last] if last < cells else t.hi
        t.expected = n * (last - first + 1) / cells


def _first_brackets(rows: DataFrame, columns, group_cols, q: float, cells: int, gathered: int):
    """One pass: counts, extremes and a sketched bracket for every group and column."""
    accuracy = SKETCH * cells
    around = [max(0.0, q - 2.0 / accuracy), min(1.0, q + 2.0 / accuracy)]
    aggs = []
    for i, c in enumerate(columns):
        v = _value(c)
        aggs += [F.count(v).alias(f"_n{i}"), F.min(v).alias(f"_least{i}"), F.max(v).alias(f"_most{i}"),
                 F.percentile_approx(v, around, accuracy).alias(f"_cuts{i}")]
    found = rows.groupBy("_group").agg(*[F.first(c).alias(c) for c in group_cols], *aggs).collect()
    targets = []
    for row in found:
        for i, c in enumerate(columns):
            n, least, most = row[f"_n{i}"], row[f"_least{i}"], row[f"_most{i}"]
            if n == 0:
                continue
            h = (n - 1) * q
            t = _Target(row["_group"], c, n, math.floor(h), math.ceil(h), h - math.floor(h), least, most,
                        least, most, float(n))
            if least == most:
                t.value = least
            elif n > gathered:
                t.lo = row[f"_cuts{i}"][0] if around[0] > 0.0 else least
                t.hi = row[f"_cuts{i}"][1] if around[1] < 1.0 else most
                t.expected = 6.0 * n / accuracy
            targets.append(t)
    return found, targets


def exact_quantiles(df: DataFrame, columns, group_cols=(), q: float = 0.5, cells: int = 2000,
                    gathered: int = GATHERED) -> DataFrame:
    """Exact interpolated ``q``-quantiles of several columns, one row a group.

    Returns ``(*group_cols, *columns)``; nulls and NaN are ignored, a column
    without values is null, a group without any value is absent. Groups and
    columns must be bounded (categories). An input read several times should
    be a table: it is scanned once a pass.
    """
    columns, group_cols = list(columns), list(group_cols)
    rows = df.select(*dict.fromkeys(group_cols + columns)).withColumn("_group", _group_key(group_cols))
    found, targets = _first_brackets(rows, columns, group_cols, q, cells, gathered)
    while True:
        open_ = [t for t in targets if t.value is None]
        if not open_:
            break
        ready = [t for t in open_ if t.lo == t.hi or t.expected <= gathered]
        if ready:
            for i, (below, inside) in _gather(rows, ready, group_cols).items():
                _settle(ready[i], below, inside)
        else:
            _narrow(rows, open_, group_cols, cells)
    values = {(t.group, t.column): t.value for t in targets}
    out = []
    for row in found:
        result = [values.get((row["_group"], c)) for c in columns]
        if any(v is not None for v in result):
            out.append(tuple(row[c] for c in group_cols) + tuple(result))
    fields = [df.schema[c] for c in group_cols] + [T.StructField(c, T.DoubleType()) for c in columns]
    return df.sparkSession.createDataFrame(out, T.StructType(fields))


def exact_quantile(df: DataFrame, value_col: str, group_cols=(), q: float = 0.5,
                   buckets: int = 2000) -> DataFrame:
    """:func:`exact_quantiles` of one column: ``(*group_cols, value_col)``."""
    return exact_quantiles(df, [value_col], group_cols, q, buckets, gathered=min(GATHERED, 50 * buckets))


def exact_median_value(df: DataFrame, value_col: str) -> float | None:
    """Global exact median of a column as a Python float (None if all null)."""
    rows = exact_quantile(df, value_col).collect()
    return rows[0][value_col] if rows else None
