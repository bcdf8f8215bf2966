"""Whitening of embeddings by an exact characteristic polynomial (operator 13).

Entries become integers x = floor(SCALE * c) + OFFSET. Then

1. one pass sums x and its products exactly (integer limbs, partial sums by
   task, added by Spark), giving the integer scatter M = n * sum(x x') - S S',
   which is n^2 times the centred covariance V;
2. M's characteristic polynomial is found modulo many 31-bit primes, each by
   Hessenberg reduction in a Spark task, and joined by Chinese remaindering;
   as M is positive semi-definite, its coefficients are bounded through the
   trace, which fixes how many primes are needed (one more checks the result);
3. roots are isolated exactly: a polynomial whose roots are all real has as
   many roots above a as its shift by a has sign changes. Each is bisected to
   ``ROOT_BITS`` bits;
4. components come from inverse iteration on M - root in integer fixed point,
   a Spark task for each distinct root; equal roots share a task, which keeps
   its vectors orthogonal;
5. rows are projected and scaled in one pass; the covariance of the result is
   a Spark aggregate (``covar_pop``, which centres before multiplying).

What reaches the driver is bounded by the dimension d: d * d sums, primes * d
residues, components * d entries; nothing follows the number of rows.

Defined results: vectors that are null or hold null or non-finite entries, or
entries beyond 2^43 (no exact long), or whose length isn't the most frequent
one (the smaller of equally frequent), are dropped. Components of eigenvalue 0
don't exist, so equal vectors, or one alone, give no rows, as does an empty
table; ids aren't interpreted: null and repeated ones are rows of their own.
A deviation beyond a long is null. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
MAX_ENTRY = float(1 << 43)
ROOT_BITS = 200     # bits of a root's relative precision
GUARD_BITS = 96     # further bits of the fixed point in inverse iteration
PRIME_TASK = 16     # primes in one task
LIMB = 20           # bits of a limb in exact products of float64
PART = 40           # bits of a part of a partial sum in Spark's long sums
PARTS = 4


# -- 1. exact sums ---------------------------------------------------------

def _integers(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and y = x - OFFSET as array<long>, of rows that take part."""
    entry = lambda c: F.floor(c.cast("double") * F.lit(float(SCALE)))
    fits = F.forall(F.col(vector), lambda c: F.coalesce(
        F.abs(c.cast("double")) < F.lit(MAX_ENTRY), F.lit(False)) & ~F.isnan(c.cast("double")))
    usable = vectors.where(F.col(vector).isNotNull()).where(fits)
    sizes = usable.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("rows")) \
        .orderBy(F.desc("rows"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return usable.where(F.size(vector) == d).select(
        F.col(vec_id).alias("vec_id"), F.transform(F.col(vector), entry).alias("y"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact_sums(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns and of all their products, as Python integers."""
    d = y.shape[1]
    sums, products = np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
    for at in range(0, len(y), 4096):      # 2^40 * 2^12 < 2^53: exact in float64
        block = y[at:at + 4096]
        size, sign = np.abs(block), np.sign(block)
        limbs = []
        while not limbs or size.any():
            limbs.append((sign * (size & ((1 << LIMB) - 1))).astype(np.float64))
            size = size >> LIMB
        for i, a in enumerate(limbs):
            sums += a.sum(axis=0).astype(np.int64).astype(object) << (LIMB * i)
            for j, b in enumerate(limbs):
                products += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return sums, products


def _parts(value: int) -> tuple[int, ...]:
    low = tuple((value >> (PART * i)) & ((1 << PART) - 1) for i in range(PARTS - 1))
    return (*low, value >> (PART * (PARTS - 1)))


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, products = 0, None, None
    for batch in batches:
        if batch.num_rows:
            s, p = _exact_sums(_matrix(batch.column(0)))
            n += batch.num_rows
            sums, products = (s, p) if sums is None else (sums + s, products + p)
    if n:
        d = len(sums)
        values = [n, *sums, *products[np.triu_indices(d)]]
        columns = list(zip(*map(_parts, map(int, values)), strict=True))
        yield pa.RecordBatch.from_pydict({"entry": pa.array(range(len(values)), pa.int64()), **{
            f"part{i}": pa.array(c, pa.int64()) for i, c in enumerate(columns)}})


def scatter(y: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, sums of y, and the integer scatter n * sum(y y') - S S', all exact."""
    names = [f"part{i}" for i in range(PARTS)]
    schema = "entry long, " + ", ".join(f"{c} long" for c in names)
    found = y.select("y").mapInArrow(_sum_batches, schema).groupBy("entry").agg(
        *[F.sum(c).alias(c) for c in names]).orderBy("entry").collect()
    values = [sum(row[c] << (PART * i) for i, c in enumerate(names)) for row in found]
    if not values:
        return 0, [], []
    d = (math.isqrt(8 * len(values) + 1) - 3) // 2   # len = 1 + d + d (d + 1) / 2
    n, sums, upper = values[0], values[1:1 + d], iter(values[1 + d:])
    matrix = [[0] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            matrix[i][j] = matrix[j][i] = n * next(upper) - sums[i] * sums[j]
    return n, sums, matrix


# -- 2. characteristic polynomial ------------------------------------------

def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``."""
    small = [p for p in range(2, math.isqrt(top) + 1) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    out, high = [], top
    while len(out) < count and high > 2:
        low = max(2, high - (1 << 16))
        prime = np.ones(high - low, dtype=bool)
        for p in small:
            prime[max(p * p, -(-low // p) * p) - low::p] = False
        out += [int(low + i) for i in np.flatnonzero(prime)[::-1]]
        high = low
    return out[:count]


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t I - M) mod p, by rising degree, by Hessenberg reduction."""
    h, d = matrix.copy(), len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), dtype=np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, dtype=np.int64)
        new[1:] = polys[k, :-1]
        weights, chain = np.zeros(k + 1, dtype=np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else 0
        polys[k + 1] = (new - (weights[:, None] * polys[:k + 1] % p).sum(axis=0)) % p
    return [int(c) for c in polys[d]]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(t I - M), by rising degree, of a positive semi-definite M."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # coefficients of a positive semi-definite matrix are at most (1 + trace / d)^d in size
    bits = int(d * math.log2(2 + trace // d)) + d.bit_length() + 4
    primes = primes_below(1 << 31, bits // 30 + 2)
    rows = [",".join(map(str, row)) for row in matrix]

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array([[int(x) for x in row.split(",")] for row in rows], dtype=object)
        for frame in frames:
            yield pd.DataFrame({"prime": frame["prime"], "residues": [
                polynomial_mod((whole % int(p)).astype(np.int64), int(p)) for p in frame["prime"]]})

    tasks = -(-len(primes) // PRIME_TASK)
    found = {r["prime"]: r["residues"] for r in spark.createDataFrame(
        [(p,) for p in primes], "prime long").repartition(tasks).mapInPandas(
        solve, "prime long, residues array<long>").collect()}
    values, modulus = [0] * (d + 1), 1
    for p in primes[:-1]:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, found[p], strict=True)]
        modulus *= p
    values = [v - modulus if 2 * v > modulus else v for v in values]
    if [v % primes[-1] for v in values] != list(found[primes[-1]]):
        raise ArithmeticError("the checking prime disagrees with the characteristic polynomial")
    return values


# -- 3. roots ---------------------------------------------------------------

def roots_above(poly: list[int], a: int, shift: int) -> int:
    """How many roots of a real-rooted polynomial exceed a / 2^shift, with multiplicity."""
    d = len(poly) - 1
    c = np.array([(v << (shift * (d - k))) * a ** k for k, v in enumerate(poly)], dtype=object) \
        if a else np.array(poly, dtype=object)
    if a:
        c = c[::-1]
        for k in range(d):       # p(a (u + 1)): repeated synthetic division
            c[:d + 1 - k] = np.add.accumulate(c[:d + 1 - k])
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], a: int, shift: int) -> int:
    """Sign-true value of the polynomial at a / 2^shift, times 2^(shift * degree)."""
    total, scale = 0, 0
    for v in reversed(poly):
        total = total * a + (v << scale)
        scale += shift
    return total


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int, int]]:
    """(numerator, shift, multiplicity) of the largest positive roots, ``count`` in all.

    Roots that agree in ``ROOT_BITS`` bits count as one of their joint multiplicity.
    """
    out: list[tuple[int, int, int]] = []
    taken, positive = 0, roots_above(poly, 0, 0)
    bound = (abs(poly[-2]) + 1, 0)     # the trace bounds every root
    while taken < min(count, positive):
        # exactly ``taken`` roots exceed the bound; the next one lies in (low, high]
        low, (high, shift) = 0, bound
        n_low = positive
        while n_low - taken > 1 and (low == 0 or (high - low) << ROOT_BITS > low):
            low, high, shift = low << 1, high << 1, shift + 1
            middle = (low + high) >> 1
            n = roots_above(poly, middle, shift)
            if n > taken:
                low, n_low = middle, n
            else:
                high = middle
            while shift and not (low | high) & 1:
                low, high, shift = low >> 1, high >> 1, shift - 1
        bound, multiplicity = (low, shift), n_low - taken
        if multiplicity == 1:
            above = _value(poly, high, shift)
            if above == 0:
                low = high
            while low == 0 or (high - low) << ROOT_BITS > low:
                low, high, shift = low << 1, high << 1, shift + 1
                middle = (low + high) >> 1
                value = _value(poly, middle, shift)
                if value == 0:
                    low = high = middle
                elif (value > 0) == (above > 0):
                    high = middle
                else:
                    low = middle
        out.append(((low + high) >> 1, shift, multiplicity))
        taken += multiplicity
    return out


# -- 4. components ------------------------------------------------------------

def null_vectors(matrix: np.ndarray, numerator: int, shift: int, count: int) -> np.ndarray:
    """``count`` orthonormal vectors v with (M - numerator / 2^shift) v = 0, as rows of doubles.

    Inverse iteration in integer fixed point; ``matrix`` holds Python integers.
    """
    d = len(matrix)
    work = ROOT_BITS + GUARD_BITS + max(0, numerator.bit_length() - shift)
    b = (matrix << shift) - np.diag(np.array([numerator] * d, dtype=object))
    b = b << max(0, work - shift) if work >= shift else b >> (shift - work)
    order, factors = np.arange(d), np.zeros((d, d), dtype=object)
    for k in range(d):
        pivot = k + int(np.argmax(np.abs(b[k:, k])))
        if pivot != k:
            for table in (b, factors, order):
                table[[k, pivot]] = table[[pivot, k]]
        if b[k, k] == 0:
            b[k, k] = 1
        factor = (b[k + 1:, k] << work) // b[k, k]
        factors[k + 1:, k] = factor
        b[k + 1:, k:] -= (factor[:, None] * b[k, k:]) >> work
        b[k + 1:, k] = 0
    unit = 1 << work

    def normal(x: np.ndarray) -> np.ndarray:
        length = math.isqrt(int((x * x).sum()))
        return (x << work) // length

    found: list[np.ndarray] = []
    for v in range(count):
        x = np.array([unit + unit * ((i * 7919 + (v + 1) * 104_729) % 997) // 997 * (-1) ** (i * (v + 1) // 2 % 2)
                      for i in range(d)], dtype=object)
        for _ in range(3):
            for other in found:
                x = x - ((other * (int((x * other).sum()) >> work)) >> work)
            x = normal(x)[order]
            for k in range(d):
                x[k + 1:] -= (factors[k + 1:, k] * x[k]) >> work
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] << work) // b[k, k]
                x[:k] -= (b[:k, k] * x[k]) >> work
        for other in found:
            x = x - ((other * (int((x * other).sum()) >> work)) >> work)
        found.append(normal(x))
    return np.array([[float(x / unit) for x in vector] for vector in found])


def components(spark: SparkSession, matrix: list[list[int]], count: int) -> tuple[list[float], np.ndarray]:
    """Eigenvalues of M, each over its trace, and unit eigenvectors (rows), by falling eigenvalue."""
    trace = sum(row[i] for i, row in enumerate(matrix))
    if not trace:
        return [], np.zeros((0, len(matrix)))
    roots = largest_roots(characteristic_polynomial(spark, matrix), count)
    rows = [",".join(map(str, row)) for row in matrix]

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array([[int(x) for x in row.split(",")] for row in rows], dtype=object)
        for frame in frames:
            for r in frame.itertuples():
                found = null_vectors(whole, int(r.numerator), int(r.shift), int(r.multiplicity))
                yield pd.DataFrame({"root": r.root, "place": range(len(found)), "vector": list(found)})

    tasks = spark.createDataFrame([(i, str(a), s, m) for i, (a, s, m) in enumerate(roots)],
                                  "root long, numerator string, shift long, multiplicity long")
    found = tasks.repartition(len(roots)).mapInPandas(
        solve, "root long, place long, vector array<double>").orderBy("root", "place").collect()
    shares = [a / (trace << s) for a, s, m in roots for _ in range(m)]
    return shares[:count], np.array([r["vector"] for r in found][:count])


# -- 5. rows -------------------------------------------------------------------

def whiten(vectors: DataFrame, count: int = COMPONENTS, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    y = _integers(vectors, vec_id, vector)
    n, sums, matrix = scatter(y)
    shares, basis = components(spark, matrix, count) if n else ([], np.zeros((0, 0)))
    id_type = vectors.schema[vec_id].dataType.simpleString()
    if not len(shares):
        return spark.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation long, "
                                         "whitened double, explained double, identity_error double")
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    mean = np.array([s / n for s in sums])
    scale = np.array([math.sqrt(share * (trace / (n * n))) for share in shares])
    project = basis.T / scale

    def project_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(1))
            w = (values - mean) @ project
            far = n * int(np.abs(values).max()) + max(map(abs, sums))
            if far * far * values.shape[1] < 1 << 63:
                deviation = ((values * n - np.array(sums)) ** 2).sum(axis=1).tolist()
            else:
                exact = ((values.astype(object) * n - np.array(sums, dtype=object)) ** 2).sum(axis=1)
                deviation = [v if v < 1 << 63 else None for v in exact]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(deviation, pa.int64()),
                pa.FixedSizeListArray.from_arrays(w.ravel(), w.shape[1]).cast(pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "w"])

    projected = y.mapInArrow(project_batches, f"vec_id {id_type}, deviation long, w array<double>")
    k = len(shares)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    covariance = projected.select(*[F.col("w")[i].alias(f"w{i}") for i in range(k)]).agg(
        *[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covariance, pairs, strict=True))
    explained = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), F.col("component"))
    return projected.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")) \
        .withColumn("component", (F.col("at") + 1).cast("int")).select(
            "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
            explained.alias("explained"), F.lit(float(error)).alias("identity_error"))
