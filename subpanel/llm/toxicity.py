"""Toxicity by nearest labelled examples (operator 5).

A text's score is the distance-weighted vote of its nearest labelled
examples by cosine over the TF-IDF weights of all terms. The neighbours are
exact. Examples lie in blocks of ``BLOCK``, alike ones side by side, in an
inverted index. A text's products with the terms that few examples hold are
summed over their postings; of the ``HEAD`` terms that most examples hold the
index keeps each block's largest weight. A block whose bound (largest sum so
far, and the smaller of the product with its maxima and of norms) stays below
the k-th cosine already surely reached is skipped; the others are multiplied
in single precision, and every example that comes within ``SLACK`` of the
k-th largest is scored again in double precision.

Terms are words and the first ``PREFIX`` bytes of longer words (inflected
forms of one stem share them). The examples are a bounded sample
(``TRAIN_ROWS``) of the labelled rows, one text an id; texts of equal terms and
counts are one example that counts both labels and votes with its rate. Every
term of theirs is in the index, with its document frequency over all documents.
A term's idf counts as many times as its toxic rate among the examples surely
exceeds the base rate, and once if it doesn't: no term is left out. A
term that no example holds adds to a text's norm with the weight of a term of
one document. The vote is calibrated on the examples themselves by isotonic
regression, each row scored without itself: neither its vote nor its label in
the terms' weights takes part.

The index is packed by Spark, a range of terms a group; the driver receives the
packed bytes, whose number ``TRAIN_ROWS`` bounds at a given length of texts.

Defined results: null and empty texts and texts without a term of an example have
no neighbour and get the toxic rate of the sampled rows without a term; with no
labelled row every score is 0. If a doc_id is labelled more than once it is toxic
if any label says so; null labels and null ids teach nothing; of several texts of
one id one (by hash) teaches. Each input row gives one output row; an empty table
gives an empty result; other columns of either table aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, id_bucket, stored
from .textops import ALNUM, Words, mix, slices

TRAIN_ROWS = 20_000   # labelled examples, about
HEAD = 1024           # terms whose block maxima are kept
BLOCK = 64            # examples a block
SLACK = 1e-4          # more than HEAD products in single precision can be off by
LANES = 128           # texts searched at a time
STEPS = 8             # within the terms of equal first bits, before a whole search
PARTS = 64            # ranges of terms the index is packed by
SEEDS = 4             # blocks whose k-th cosine the others have to reach
SMALL = 1 << 16       # counts below have their logarithms in a table
SIGNS = 32            # most frequent terms whose presence orders the examples
CHUNK = 1 << 20       # postings handled at a time on the driver
TASK_EXAMPLES = 1_000  # examples a task scores without themselves
Z = 3.0               # deviations of a term's toxic rate that are conceded
PREFIX = 4            # bytes of a stem
NEIGHBOURS = 25
PRIOR = 0.5           # weight of the base rate in a vote
PREDICT_AT = 0.3

_STEM = np.uint64(0xD6E8FEB86659FD93)


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of every word, and of the stem of every word longer than that."""
    text = words.text_of
    long = np.flatnonzero(words.end - words.start > PREFIX)
    start = words.start[long]
    stem = np.full(len(long), _STEM)
    for j in range(PREFIX):
        stem = stem * np.uint64(257) + words.data[start + j]
    return np.concatenate((text, text[long])), np.concatenate((words.hash, mix(stem)))


def _counts(words: Words):
    """(text, term, count), in that order; terms are hashes."""
    text, term = _terms(words)
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    fresh = np.flatnonzero(np.concatenate((
        [True], (text[1:] != text[:-1]) | (term[1:] != term[:-1])))) if len(text) else \
        np.zeros(0, np.int64)
    return text[fresh], term[fresh], np.diff(np.append(fresh, len(text)))


def _starts(vocabulary: np.ndarray) -> np.ndarray:
    """Where the hashes of each value of their first bits begin in a sorted vocabulary, about one a value."""
    bits = max(1, len(vocabulary).bit_length())
    return np.searchsorted(vocabulary >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(
        np.int32)


def _places(vocabulary: np.ndarray, starts: np.ndarray, term: np.ndarray) -> np.ndarray:
    """``np.searchsorted(vocabulary, term)``: a few steps from where a term's first bits begin."""
    shift = np.uint64(65 - len(starts).bit_length())
    first = (term >> shift).astype(np.int64)
    place, end = starts[first], starts[first + 1]
    last = len(vocabulary) - 1
    ahead = np.flatnonzero((place < end) & (vocabulary[np.minimum(place, last)] < term))
    for _ in range(STEPS):
        place[ahead] += 1
        at = place[ahead]
        ahead = ahead[(at < end[ahead]) & (vocabulary[np.minimum(at, last)] < term[ahead])]
        if not len(ahead):
            return place
    place[ahead] = np.searchsorted(vocabulary, term[ahead])
    return place


def _known_counts(words: Words, vocabulary: np.ndarray, starts: np.ndarray):
    """(text, term, count) of the terms in a sorted vocabulary, as places there; (text, count) of all others."""
    text, term = _terms(words)
    place = np.minimum(_places(vocabulary, starts, term), len(vocabulary) - 1)
    known = vocabulary[place] == term
    key, count = np.unique(text[known] * len(vocabulary) + place[known], return_counts=True)
    other = np.flatnonzero(~known)
    _, first, times = np.unique(mix(term[other] + mix(text[other].astype(np.uint64))),
                                return_index=True, return_counts=True)
    return key // len(vocabulary), key % len(vocabulary), count, text[other[first]], times


def _examples(documents: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
              rows: int) -> DataFrame:
    """The sampled examples: doc_id, toxic, digest of terms and counts, terms, counts, row."""
    known = labels.select(F.col(doc_id).alias("doc_id"), (F.col(label) > 0).cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = max(known.count(), 1)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    sample = known.where(place < int((1 << 40) * min(1.0, rows / total))).orderBy(place, "doc_id").limit(2 * rows)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), "doc_id")
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40  # numbered once: the rows are stored
        for batch in batches:
            for words in slices(batch.column(1), ALNUM):
                owner, term, count = _counts(words)
                row += words.n
                bounds = np.searchsorted(owner, np.arange(words.n + 1)).astype(np.int32)
                digest = np.zeros(words.n, dtype=np.uint64)
                np.add.at(digest, owner, mix(term + mix(count.astype(np.uint64))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.first, words.n),
                     batch.column(2).slice(words.first, words.n), pa.array(digest.view(np.int64)),
                     pa.ListArray.from_arrays(bounds, pa.array(term.view(np.int64))),
                     pa.ListArray.from_arrays(bounds, pa.array(count.astype(np.int32))),
                     pa.array(np.arange(row - words.n, row))],
                    names=["doc_id", "toxic", "digest", "terms", "counts", "row"])

    return stored(texts.select("doc_id", "text", "toxic").mapInArrow(
        run, f"doc_id {id_type}, toxic int, digest long, terms array<long>, counts array<int>, row long"), "examples")


def _distinct_examples(described: DataFrame) -> DataFrame:
    """One row per term vector: doc_id (the smallest), row, size (terms), toxic and held (labelled ids)."""
    of_id = described.groupBy("doc_id").agg(
        F.min(F.struct("digest", F.size("terms").alias("size"), "row", "toxic")).alias("x"))
    return of_id.groupBy("x.digest", "x.size").agg(
        F.min(F.struct("doc_id", "x.row")).alias("first"), F.sum("x.toxic").alias("toxic"),
        F.count(F.lit(1)).alias("held")).select("first.doc_id", "first.row", "size", "toxic", "held")


@dataclass
class Index:
    """Postings of all terms of the examples; matrix and weights are made where they are used."""

    vocabulary: np.ndarray   # sorted term hashes
    idf: np.ndarray          # times relevance
    unseen_idf: float        # of a term that isn't in the vocabulary
    example: np.ndarray      # per posting, term by term, those of count 1 first
    count: np.ndarray
    bounds: np.ndarray       # postings of each term: bounds[term] … bounds[term + 1]
    norm: np.ndarray         # per example
    toxic: np.ndarray        # toxic rows of each example
    held: np.ndarray         # rows of each example
    ids: list
    base_rate: float
    none_rate: float         # toxic rate of rows without a term
    rows_of: tuple[np.ndarray, np.ndarray] | None = None  # each term's rows and toxic rows, if it has a relevance
    visited: int = 0         # blocks multiplied, and all blocks a text met
    met: int = 0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k in self.__dataclass_fields__}

    @cached_property
    def starts(self) -> np.ndarray:
        return _starts(self.vocabulary)

    @cached_property
    def single(self) -> np.ndarray:
        """Postings of count 1 of each term; they lead its others."""
        out = np.zeros(len(self.bounds) - 1, np.int64)
        for a, b, term in _runs(self.bounds):
            if len(term):
                out[term[0]:term[-1] + 1] += np.bincount(term[self.count[a:b] == 1] - term[0],
                                                         minlength=term[-1] - term[0] + 1)
        return out

    @cached_property
    def tf(self) -> np.ndarray:
        """1 + log of each small count, 0 of none."""
        count = np.arange(min(int(self.count.max(initial=0)), SMALL) + 1)
        return np.log(np.maximum(count, 1)) + (count > 0)

    def times(self, count: np.ndarray) -> np.ndarray:
        """1 + log of counts, 0 of none."""
        if len(self.tf) <= SMALL:
            return self.tf.take(count)
        return np.log(np.maximum(count, 1).astype(float)) + (count > 0)

    @cached_property
    def rate(self) -> np.ndarray:
        return self.toxic / self.held

    @cached_property
    def by_id(self) -> np.ndarray:
        """Places of the examples in the order of their ids."""
        out = np.empty(len(self.ids), np.int64)
        out[sorted(range(len(self.ids)), key=self.ids.__getitem__)] = np.arange(len(self.ids))
        return out

    @cached_property
    def frequent(self) -> np.ndarray:
        return np.argsort(-np.diff(self.bounds), kind="stable")[:HEAD]

    @cached_property
    def column(self) -> np.ndarray:
        """Of the terms that most examples hold their column in ``head``, -1 for others."""
        column = np.full(len(self.vocabulary), -1)
        column[self.frequent] = np.arange(len(self.frequent))
        return column

    @cached_property
    def head(self) -> np.ndarray:
        """Counts of frequent terms, examples x columns."""
        out = np.zeros((len(self.ids), len(self.frequent)), self.count.dtype)
        for j, term in enumerate(self.frequent):
            a, b = self.bounds[term], self.bounds[term + 1]
            out[self.example[a:b], j] = self.count[a:b]
        return out

    def head_weights(self, some: np.ndarray) -> np.ndarray:
        """Weights of frequent terms of some examples, in double precision."""
        return self.times(self.head[some]) * self.idf[self.frequent] / self.norm[some][:, None]

    def head_products(self, some: np.ndarray, columns: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Products of some examples with a text's weights in some columns, in double precision."""
        return self.times(self.head[np.ix_(some, columns)]) @ (query * self.idf[self.frequent[columns]]) / self.norm[some]

    @cached_property
    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of frequent terms (examples x columns), block maxima (columns x blocks), largest norms."""
        narrow = np.concatenate([self.head_weights(np.arange(a, min(a + 1024, len(self.ids)))).astype(np.float32)
                                 for a in range(0, len(self.ids), 1024)])
        starts = np.arange(0, len(self.ids), BLOCK)
        norms = np.sqrt(np.einsum("ij,ij->i", narrow, narrow))
        return narrow, np.ascontiguousarray(np.maximum.reduceat(narrow, starts, axis=0).T), \
            np.maximum.reduceat(norms, starts)

    @cached_property
    def own_ratio(self) -> list[np.ndarray]:
        """Per label: a term's relevance without one row of that label, over its relevance."""
        if self.rows_of is None:
            return [np.ones(len(self.idf))] * 2
        held, toxic = self.rows_of
        whole = _relevance(held, toxic, self.base_rate)
        return [_relevance(np.maximum(held - 1, 0), np.clip(toxic - y, 0, np.maximum(held - 1, 0)),
                           self.base_rate) / whole for y in (0, 1)]

    def own_weights(self, first: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(example - first, term, weight) of examples first … stop - 1, example by example."""
        at = np.flatnonzero((self.example >= first) & (self.example < stop))
        order = np.argsort(self.example[at], kind="stable")
        at = at[order]
        example, term = self.example[at].astype(np.int64), np.searchsorted(self.bounds, at, "right") - 1
        return example - first, term, self.times(self.count[at]) * self.idf[term] / self.norm[example]

    def query_weights(self, text: np.ndarray, terms: np.ndarray, counts: np.ndarray, texts: int,
                      unseen: np.ndarray) -> np.ndarray:
        """Weights of texts' terms in unit vectors; ``unseen``: squares of a text's other weights."""
        query = (1 + np.log(counts)) * self.idf[terms]
        return query / np.sqrt(np.bincount(text, query * query, minlength=texts) + unseen)[text]

    def nearest(self, text: np.ndarray, terms: np.ndarray, query: np.ndarray, texts: int,
                k: int = NEIGHBOURS,
                without: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each text's k examples of largest cosine above 0 (ties: first example), and their cosines.

        ``without``: an example a text that isn't met.
        """
        at, column = np.searchsorted(text, np.arange(texts + 1)), self.column[terms]
        low = self.bounds[terms]
        size = np.where(column < 0, self.bounds[terms + 1] - low, 0)
        single, factor = np.where(column < 0, self.single[terms], 0), query * self.idf[terms]
        for start in range(0, texts, LANES):
            stop = min(start + LANES, texts)
            some = np.arange(at[start], at[stop])
            some = some[column[some] >= 0]
            dense = np.zeros((stop - start, len(self.frequent)))
            dense[text[some] - start, column[some]] = query[some]
            tail = np.zeros((stop - start, len(self.ids)))
            for i in range(start, stop):
                own = at[i] + np.flatnonzero(size[at[i]:at[i + 1]])
                if len(own):
                    one, own = single[own], np.concatenate((own, own))
                    n = np.concatenate((one, size[own[len(one):]] - one))
                    posts = np.repeat(low[own] + np.concatenate((np.zeros_like(one), one)) - np.cumsum(n) + n, n)
                    posts += np.arange(len(posts))
                    weights, plain = np.repeat(factor[own], n), int(one.sum())
                    weights[plain:] *= self.times(self.count.take(posts[plain:]))
                    np.divide(np.bincount(self.example.take(posts), weights, minlength=len(self.ids)), self.norm,
                              out=tail[i - start])
            if without is not None:
                tail[np.arange(stop - start), without[start:stop]] = -np.inf
            sums, least = self._sums(dense, tail, k)
            for i in range(stop - start):
                near = np.flatnonzero(sums[i] >= max(least[i] - SLACK, 0))
                if len(near) > k:
                    score = sums[i, near]
                    near = near[score >= np.partition(score, -k)[-k] - SLACK]
                columns = np.flatnonzero(dense[i])
                exact = tail[i, near] + self.head_products(near, columns, dense[i, columns])
                near, exact = near[exact > 0], exact[exact > 0]
                order = np.lexsort((self.by_id[near], -exact))[:k]
                yield near[order], exact[order]

    def _sums(self, dense: np.ndarray, tail: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Cosines in single precision, texts x examples, and what the k-th reaches for sure.

        Blocks that can't hold one of the k nearest have -inf.
        """
        narrow, maxima, norms = self.blocks
        texts, count = tail.shape
        thin = dense.astype(np.float32)
        bound = np.maximum.reduceat(tail, np.arange(0, count, BLOCK), axis=1)
        bound += np.minimum(thin @ maxima, np.sqrt(np.einsum("ij,ij->i", thin, thin))[:, None] * norms)
        least = np.zeros(texts)
        if count > SEEDS * BLOCK:
            for i, seeds in enumerate(np.argpartition(bound, -SEEDS, axis=1)[:, -SEEDS:]):
                blocks = [slice(b * BLOCK, (b + 1) * BLOCK) for b in seeds.tolist()]
                reached = np.concatenate([tail[i, x] + narrow[x] @ thin[i] for x in blocks])
                if len(reached) > k:
                    least[i] = max(np.partition(reached, -k)[-k], 0)
        alive = bound >= least[:, None] - SLACK
        self.met += alive.size
        self.visited += int(alive.sum())
        sums, room = np.full((texts, count), -np.inf), np.empty_like(thin)
        for b in np.flatnonzero(alive.any(axis=0)):
            block, few = slice(b * BLOCK, (b + 1) * BLOCK), np.flatnonzero(alive[:, b])
            some = np.take(thin, few, axis=0, out=room[:len(few)], mode="clip")  # into room already there
            sums[few, block] = tail[few, block] + some @ narrow[block].T
        return sums, least

    def neighbours(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS,
                   without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine of one text whose terms are all known."""
        text = np.zeros(len(terms), np.int64)
        return next(self.nearest(text, terms, self.query_weights(text, terms, counts, 1, np.zeros(1)), 1, k,
                                 np.array([without]) if without >= 0 else None))

    def vote(self, ids: np.ndarray, cosines: np.ndarray) -> float:
        weight = cosines ** 2
        return float((PRIOR * self.base_rate + (weight * self.rate[ids]).sum()) / (PRIOR + weight.sum()))

    def own_vote(self, own: int, label: int, ids: np.ndarray, cosines: np.ndarray) -> float:
        """The vote for one of an example's rows: its equals without it, and the nearest of the others."""
        equal = self.held[own] - 1
        if not equal:
            return self.vote(ids, cosines)
        weight = np.append(cosines[:NEIGHBOURS - 1] ** 2, 1.0)
        rate = np.append(self.rate[ids[:NEIGHBOURS - 1]], (self.toxic[own] - label) / equal)
        return float((PRIOR * self.base_rate + (weight * rate).sum()) / (PRIOR + weight.sum()))


@dataclass
class Fitted:
    index: Broadcast
    curve: tuple[np.ndarray, np.ndarray]  # calibration: votes, rates


def _isotonic(x: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares nondecreasing fit of y over x (pooled neighbours), as points to interpolate."""
    pools: list[list[float]] = []  # sum of x, sum of y, count
    times = np.ones(len(x)) if times is None else times
    for a, b, n in sorted(zip(x.tolist(), y.tolist(), times.tolist(), strict=True)):
        pools.append([a * n, b * n, n])
        while len(pools) > 1 and (pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]
                                  or pools[-2][0] / pools[-2][2] == pools[-1][0] / pools[-1][2]):
            top = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], top, strict=True)]
    # one more example of the other kind in each pool keeps rates off 0 and 1
    return (np.array([a / n for a, _, n in pools]),
            np.maximum.accumulate(np.array([(b + 0.5) / (n + 1) for _, b, n in pools])))


def _runs(bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Postings of about CHUNK at a time: first, end, and the term of each."""
    low, terms = 0, len(bounds) - 1
    while low < terms:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + CHUNK, "right")) - 1)
        yield int(bounds[low]), int(bounds[high]), np.repeat(
            np.arange(low, high), np.diff(bounds[low:high + 1]))
        low = high


def _smallest(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def build_index(vocabulary: np.ndarray, idf: np.ndarray, examples: pd.DataFrame,
                base_rate: float, unseen_idf: float = 1.0) -> Index:
    """``examples``: doc_id, toxic, terms (places in the vocabulary), counts; by doc_id. No term has a relevance."""
    size = examples["terms"].map(len).to_numpy(dtype=np.int64)
    toxic, holds = examples["toxic"].to_numpy(dtype=float), size > 0
    terms = np.concatenate([*map(np.asarray, examples["terms"]), np.zeros(0, np.int64)]).astype(np.int64)
    counts = np.concatenate([*map(np.asarray, examples["counts"]), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.lexsort((counts > 1, terms))
    bounds = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=len(vocabulary)))))
    return _index(vocabulary, idf, unseen_idf, bounds,
                  np.repeat(np.arange(holds.sum()), size[holds])[order], _smallest(counts[order]),
                  [x for x, y in zip(examples["doc_id"].tolist(), holds, strict=True) if y], toxic[holds],
                  np.ones(int(holds.sum())), base_rate, _none_rate(toxic[~holds].sum(), (~holds).sum(), base_rate))


def _none_rate(toxic: float, rows: float, base_rate: float) -> float:
    return float((toxic + 0.5 * base_rate) / (rows + 0.5))


def _index(vocabulary: np.ndarray, idf: np.ndarray, unseen_idf: float, bounds: np.ndarray, example: np.ndarray,
           count: np.ndarray, ids: list, toxic: np.ndarray, held: np.ndarray, base_rate: float, none_rate: float,
           relevant: bool = False) -> Index:
    """Postings term by term; examples are put in an order that brings alike ones together."""
    kept = len(ids)
    rows_of = None
    if relevant:
        rows_of = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
        for a, b, term in _runs(bounds):
            for total, each in zip(rows_of, (held, toxic), strict=True):
                if len(term):
                    total[term[0]:term[-1] + 1] += np.bincount(term - term[0], each[example[a:b]])
        idf = idf * _relevance(*rows_of, base_rate)
    sign = np.zeros(kept, np.int64)
    for j, term in enumerate(np.argsort(-np.diff(bounds), kind="stable")[:SIGNS]):
        sign[example[bounds[term]:bounds[term + 1]]] |= 1 << (SIGNS - 1 - j)
    order = np.argsort(sign, kind="stable")
    to = np.empty(kept, np.int64)
    to[order] = np.arange(kept)
    to, renamed = _smallest(to), np.empty(len(example), _smallest(np.array([max(kept - 1, 0)])).dtype)
    square = np.zeros(kept)
    for a, b, term in _runs(bounds):
        renamed[a:b] = to[example[a:b]]
        square += np.bincount(renamed[a:b], ((1 + np.log(count[a:b].astype(float))) * idf[term]) ** 2, minlength=kept)
    return Index(vocabulary, idf, unseen_idf, renamed, count, bounds, np.sqrt(square), toxic[order], held[order],
                 [ids[i] for i in order], base_rate, none_rate, rows_of)


def own_votes(spark: SparkSession, shared: Broadcast, count: int) -> pd.DataFrame:
    """(vote, toxic, times) of the rows of an index's ``count`` examples, each scored without itself; tasks share them.

    Rows of one example and label have one vote; ``times`` is their number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for first in batch.column(0).to_pylist():
                stop = min(first + TASK_EXAMPLES, count)
                text, term, weight = index.own_weights(first, stop)
                for label, rows in enumerate((index.held - index.toxic, index.toxic)):
                    own = first + np.flatnonzero(rows[first:stop] > 0)
                    here = np.isin(text + first, own)
                    ratio = index.own_ratio[label][term[here]]
                    lane = np.searchsorted(own, text[here] + first)
                    query = weight[here] * ratio
                    query *= ratio / np.sqrt(np.bincount(lane, query * query, minlength=len(own)))[lane]
                    found = index.nearest(lane, term[here], query, len(own), without=own)
                    votes = [index.own_vote(x, label, *y) for x, y in zip(own, found, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(votes, pa.float64()), pa.array(np.full(len(own), float(label))),
                         pa.array(rows[own].astype(float))], names=["vote", "toxic", "times"])

    return spark.range(0, count, TASK_EXAMPLES, -(-count // TASK_EXAMPLES)).mapInArrow(
        run, "vote double, toxic double, times double").toArrow().to_pandas()


def _relevance(held: np.ndarray, toxic: np.ndarray, base: float) -> np.ndarray:
    """How many times the base rate a term's toxic rate is at least (lower end by Wilson); 1 or more."""
    p, z2 = toxic / np.maximum(held, 1), Z ** 2
    n = np.maximum(held, 1)
    lower = (p + z2 / (2 * n) - Z * np.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return np.maximum(1.0, lower / base) if base else np.ones(len(held))


def _packed(described: DataFrame, row: np.ndarray, number: np.ndarray, vocabulary: np.ndarray):
    """Postings of the numbered rows, term by term: bounds, example, count. Spark packs each range of terms."""
    spark = described.sparkSession
    shared = spark.sparkContext.broadcast((row, number, vocabulary))
    width = -(-len(vocabulary) // PARTS)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, numbers, known = shared.value
        for batch in batches:
            at = np.minimum(np.searchsorted(rows, batch.column(2).to_numpy()), len(rows) - 1)
            chosen = np.flatnonzero(rows[at] == batch.column(2).to_numpy())
            terms, counts = batch.column(0).take(pa.array(chosen)), batch.column(1).take(pa.array(chosen))
            example = np.repeat(numbers[at[chosen]], terms.value_lengths().to_numpy()).astype(np.int32)
            place = np.searchsorted(known, terms.flatten().to_numpy().view(np.uint64)).astype(np.int32)
            order = np.argsort(place, kind="stable")
            place, example = place[order], example[order]
            count = counts.flatten().to_numpy()[order]
            cuts = np.searchsorted(place, np.arange(PARTS + 1) * width)
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)),
                 *[pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in full], pa.binary())
                   for x in (place, example, count)]], names=["part", "place", "example", "count"])

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part, known = key[0].as_py(), len(shared.value[2])
        place, example, count = (np.concatenate([np.frombuffer(x, np.int32) for x in table[name].to_pylist()])
                                 for name in ("place", "example", "count"))
        order = np.lexsort((example, count > 1, place))
        held = np.bincount(place - part * width, minlength=min(width, known - part * width)).astype(np.int32)
        return pa.table({"part": pa.array([part], pa.int32()), "held": pa.array([held.tobytes()], pa.binary()),
                         "example": pa.array([_smallest(example[order]).tobytes()], pa.binary()),
                         "count": pa.array([_smallest(count[order]).tobytes()], pa.binary())})

    found = described.select("terms", "counts", "row").mapInArrow(
        split, "part int, place binary, example binary, count binary").groupBy("part").applyInArrow(
        pack, "part int, held binary, example binary, count binary").toArrow().sort_by("part")
    held, sizes = np.zeros(len(vocabulary) + 1, np.int64), []
    for part, packed in zip(found["part"].to_pylist(), found["held"].to_pylist(), strict=True):
        some = np.frombuffer(packed, np.int32)
        held[1 + part * width:][:len(some)] = some
        sizes.append(int(some.sum()))

    def unpacked(name: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, f"u{len(x) // n}")
                               for x, n in zip(found[name].to_pylist(), sizes, strict=True)])

    return np.cumsum(held), unpacked("example"), unpacked("count")


def train(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", rows: int = TRAIN_ROWS) -> Fitted | None:
    """The index of a bounded sample of ``labels``, broadcast once, and its curve; idf counts every document."""
    spark = documents.sparkSession
    described = _examples(documents, labels, doc_id, text, label, rows)
    examples = _distinct_examples(described).toArrow().sort_by("doc_id")  # TRAIN_ROWS rows without their texts
    if not len(examples):
        return None
    row, size, toxic, held = (examples[x].to_numpy() for x in ("row", "size", "toxic", "held"))
    holds = size > 0
    base = float(toxic.sum() / held.sum())
    none_rate = _none_rate(toxic[~holds].sum(), held[~holds].sum(), base)
    ids = [x for x, y in zip(examples["doc_id"].to_pylist(), holds, strict=True) if y]
    row, toxic, held = row[holds], toxic[holds].astype(float), held[holds].astype(float)
    order = np.argsort(row)
    vocabulary = np.sort(described.select(F.explode("terms").alias("term")).distinct()
                         .toArrow()["term"].to_numpy().view(np.uint64))
    frequency, documents_n = _document_frequency(documents, text, vocabulary)
    idf = np.log((1 + documents_n) / (1 + frequency)) + 1
    bounds, example, count = _packed(described, row[order], order, vocabulary) if ids else (
        np.zeros(len(vocabulary) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    index = _index(vocabulary, idf, float(np.log((1 + documents_n) / 2) + 1), bounds, example, count, ids,
                   toxic, held, base, none_rate, relevant=True)
    del bounds, example, count
    discard(described)
    shared = spark.sparkContext.broadcast(index)
    curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    if held.sum() > 1:
        votes = own_votes(spark, shared, len(index.ids))
        curve = _isotonic(*(votes[x].to_numpy() for x in ("vote", "toxic", "times")))
    return Fitted(shared, curve)


def _document_frequency(documents: DataFrame, text: str, vocabulary: np.ndarray):
    """Documents that hold each term, and all documents; a row a term that a task meets is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, starts = np.zeros(len(shared.value) + 1, dtype=np.int64), _starts(shared.value)
        for batch in batches:
            frequency[-1] += batch.num_rows
            for words in slices(batch.column(0), ALNUM):
                if len(shared.value):
                    _, term, *_ = _known_counts(words, shared.value, starts)
                    frequency[:-1] += np.bincount(term, minlength=len(shared.value))
        met = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(frequency[met])], names=["term", "n"])

    counted = documents.select(F.col(text)).mapInArrow(run, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(len(vocabulary) + 1)
    frequency[counted["term"].to_numpy(dtype=np.int64)] = counted["n"]
    return frequency[:-1], frequency[-1]


def score(documents: DataFrame, fitted: Fitted | None, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """One row per document: doc_id, score, nearest example and its cosine."""
    id_type = documents.select(doc_id).schema[0].dataType.simpleString()
    arrow_id = pa.string() if id_type == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = fitted.index.value if fitted else None
        for batch in batches:
            n = batch.num_rows
            scores = np.full(n, index.none_rate if index else 0.0)
            nearest, cosine = [None] * n, [None] * n
            for words in slices(batch.column(1), ALNUM) if index and index.ids else ():
                owner, term, count, other, times = _known_counts(words, index.vocabulary, index.starts)
                unseen = np.bincount(other, ((1 + np.log(times)) * index.unseen_idf) ** 2, minlength=words.n)
                has, text_ = np.unique(owner, return_inverse=True)
                query = index.query_weights(text_, term, count, len(has), unseen[has])
                found = index.nearest(text_, term, query, len(has))
                for t, (ids, cosines) in zip(has, found, strict=True):
                    at = words.first + t
                    scores[at] = np.interp(index.vote(ids, cosines), *fitted.curve)
                    if len(ids):
                        nearest[at], cosine[at] = index.ids[ids[0]], float(cosines[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(nearest, arrow_id),
                 pa.array(cosine, pa.float64())], names=["doc_id", "score", "nearest_id", "nearest_cosine"])

    return documents.select(doc_id, text).mapInArrow(
        run, f"doc_id {id_type}, score double, nearest_id {'string' if id_type == 'string' else 'long'}, "
             "nearest_cosine double")


def toxicity(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Scores of all documents, learnt from labels whose id hash modulo 4 isn't 2."""
    fitted = train(documents, labels.where(id_bucket(doc_id, 4) != 2), doc_id, text)
    scored = score(documents, fitted, doc_id, text)
    return scored.select(
        "doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"), "nearest_id", "nearest_cosine")
