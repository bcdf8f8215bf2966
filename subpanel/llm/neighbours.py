"""Nearest neighbours by a hash-prefix forest (operator 6).

Every tree gives each vector a long string of bits, the signs of its products
with the tree's random directions; a tree is the sorted array of these
strings. A query descends all trees to the rows that share its longest
prefix, then ascends them together, a bit at a time, taking in the rows that
share the shorter prefix in any tree. Rows taken in are scored exactly.

It stops by recall instead of by a number of candidates: a row whose inner
product reaches the present k-th best is at most an angle t away, shares a
prefix of x bits in a tree with probability (1 - t / pi) ** x, and is missed
by all trees with ``(1 - that) ** trees``. Ascent ends when this is
``MISS`` or less. Close neighbours end it with few candidates; where the
nearest are hardly nearer than the rest it goes on, to all rows if need be.

Rows are dealt by id into blocks of ``BLOCK_ROWS``, each with a forest of its
own, and the stated queries in blocks of ``QUERY_ROWS`` meet every block of
rows, so a task holds one block of each whatever the data's size or the
copies of one vector. The blocks' best are merged by score.

Defined results: null and zero vectors and those with null or non-finite
components take no part, as queries or candidates; vectors of different
lengths never meet; ties go to the smaller id; repeated ids are candidates of
their own but none is a candidate of its own id; every query row, repeated or
not, gets its own k nearest; a table without such vectors
gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
TREES = 32
BITS = 16            # of a hash string
MISS = 0.08          # chance of missing a row as near as the k-th best
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024
SEED = 20_06

ROUND_OFF = 1e-5     # single precision screens, double precision decides


class Forest:
    """Sorted hash strings of a block's vectors, one array a tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.vectors, self.single = vectors, vectors.astype(np.float32)
        self.bits, self.trees = bits, trees
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], trees * bits))
        codes = self.strings(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=1)
        self.longest = float(np.sqrt((vectors ** 2).sum(axis=1)).max())

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings as numbers, trees x vectors; the first bit is the highest."""
        bits = (vectors @ self.directions > 0).reshape(len(vectors), self.trees, self.bits)
        return (bits.astype(np.int64) << np.arange(self.bits - 1, -1, -1)).sum(axis=2).T

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 place of the rows sharing the first x bits: levels x trees x queries."""
        codes = self.strings(queries)
        low = np.empty((self.bits + 1, *codes.shape), dtype=np.int64)
        high = np.empty_like(low)
        for level in range(self.bits + 1):
            rest = self.bits - level
            prefix = codes >> rest
            for tree in range(self.trees):
                low[level, tree] = np.searchsorted(self.codes[tree], prefix[tree] << rest)
                high[level, tree] = np.searchsorted(self.codes[tree], (prefix[tree] + 1) << rest)
        return low, high

    def _enough(self, level: int, kth: float, length: float) -> bool:
        if level == 0:
            return True
        cosine = min(1.0, max(-1.0, kth / max(length * self.longest, 1e-300)))
        same = 1 - math.acos(cosine) / math.pi
        return (1 - same ** level) ** self.trees <= MISS

    def search(self, query: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray,
               k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Rows and inner products of the k best found; ``own`` rows are left out."""
        taken = np.zeros(len(self.vectors), dtype=bool)
        taken[own] = True
        single, length = query.astype(np.float32), float(np.sqrt((query ** 2).sum()))
        slack = ROUND_OFF * length * self.longest
        rows, approximate, kth = np.zeros(0, np.int64), np.zeros(0, np.float32), -math.inf
        widths = (high - low).sum(axis=1)
        level = max(int(np.flatnonzero(widths > 0)[-1]), 1)  # the longest prefix any row shares
        while True:
            fresh = np.zeros(len(taken), dtype=bool)
            if level == 0:
                fresh[:] = True
            else:
                for tree in range(self.trees):
                    fresh[self.order[tree, low[level, tree]:high[level, tree]]] = True
            new = np.flatnonzero(fresh & ~taken)
            if len(new):
                taken[new] = True
                near = self.single[new] @ single
                keep = near >= kth - slack
                rows = np.concatenate((rows, new[keep]))
                approximate = np.concatenate((approximate, near[keep]))
                if len(rows) >= k:
                    kth = float(np.partition(approximate, len(rows) - k)[len(rows) - k])
                    keep = approximate >= kth - slack
                    rows, approximate = rows[keep], approximate[keep]
            if level == 0 or (len(rows) >= k and self._enough(level, kth, length)):
                break
            level -= 1
        exact = (self.vectors[rows] * query).sum(axis=1)
        return rows, exact


def usable(vector: str) -> Column:
    """Whether a vector takes part: some component isn't 0, all are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id",
           embedding: str = "embedding", block_rows: int = BLOCK_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """Each query's k nearest found: query_id, rank, vec_id, score."""
    rows = vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"),
        "is_query").where(usable("v")).withColumn("length", F.size("v"))
    n, n_queries = rows.agg(F.count("*"), F.count_if("is_query")).first()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    deal = lambda count: F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int")
    all_of = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    data = rows.select("vec_id", "v", "length", deal(blocks).alias("block"),
                       all_of(query_blocks).alias("query_block"))
    queries = rows.where("is_query").withColumn("query_row", F.monotonically_increasing_id()).select(
        "query_row", "vec_id", "v", "length", deal(query_blocks).alias("query_block"),
        all_of(blocks).alias("block"))

    def meet(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(block) and len(asked):
            block = block.sort_values("vec_id", kind="stable", ignore_index=True)
            ids = block["vec_id"].to_numpy(dtype=np.int64)
            forest = Forest(np.stack(block["v"].to_numpy()))
            matrix = np.stack(asked["v"].to_numpy())
            low, high = forest.ranges(matrix)
            numbers = asked["query_row"].to_numpy(dtype=np.int64)
            for q, query_id in enumerate(asked["vec_id"].to_numpy(dtype=np.int64)):
                own = np.arange(*np.searchsorted(ids, [query_id, query_id + 1]))
                at, score = forest.search(matrix[q], low[:, :, q], high[:, :, q], own, k)
                best = np.lexsort((ids[at], -score))[:k]
                found.append((np.full(len(best), numbers[q]), np.full(len(best), query_id), ids[at][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[], [], [], []]
        whole = {name: np.asarray(x, np.int64) for name, x in zip(("query_row", "query_id", "vec_id"), columns,
                                                                  strict=False)}
        return pd.DataFrame(whole | {"score": np.asarray(columns[3], float)})

    keys = ["length", "block", "query_block"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        meet, "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
