"""Reversible line de-duplication by sharded cuckoo filters (operator 11).

A line's key is the line without white space at its ends and with A-Z in lower
case; keys of ``LEAST_CHARS`` code points or more count. A key that several
documents hold is *shared* and stays in the document of least id alone.

The index has three tables:

* ``references``: exact, one row per document and key it holds (128-bit digest);
* ``shared``: exact reference counts and the least id of the keys that two ids
  or more refer to;
* ``filters``: a cuckoo filter for each shard of the shared keys. Each shared
  key is in its shard's filter once, so one that loses its second document
  can be taken out again - which a Bloom filter can't.

:func:`build` makes an index, :func:`insert` and :func:`delete` change it by a
batch of documents: counts are taken anew for the batch's keys alone, and the
filters of their shards take keys in or out. Every insertion can so be undone
by a deletion, to the same result as if it had never been.

:func:`deduplicate` asks the filters about every line first. Lines they don't
know can't be shared; documents without a known line are finished at once and
their texts aren't moved. Known lines are looked up in the exact table (a join
by key that Spark may split where a key is hot), and only documents that hold
one meet their dropped keys in a join. The filters are broadcast while their
measured bytes are at most ``FILTER_BYTES``; beyond that every line counts as
known and the same exact join decides, with more rows but no other result.

Defined results: null text is the empty text, one empty line; a null id counts
as the largest id of all, and rows of equal id as one document: they drop the
same keys; repeated rows give repeated rows; a text whose lines all go becomes
empty; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAST_CHARS = 10
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
NO_ID = (1 << 63) - 1
SHARD_KEYS = 50_000          # shared keys a shard's filter is laid out for
FILTER_BYTES = 48 << 20      # filters up to this size are broadcast
SLOTS = 4                    # of a bucket
KICK_ROUNDS = 200            # then a shard gets a further table
SLICE_ROWS = 256             # documents handled at a time

_KEYS = "k1 long, k2 long"


# -- keys -------------------------------------------------------------------

def line_keys(text: bytes) -> list[bytes]:
    """Key of each line of a UTF-8 text; empty where the line is too short to count."""
    keys = []
    for line in text.lower().split(b"\n"):     # bytes.lower() changes A-Z alone
        key = line.strip(SPACE)
        if len(key) < LEAST_CHARS or not key.isascii() and len(key) < 4 * LEAST_CHARS \
                and len(key.decode()) < LEAST_CHARS:
            key = b""
        keys.append(key)
    return keys


def _digests(keys: list[bytes]) -> np.ndarray:
    """n x 2 signed 64-bit halves of the keys' 128-bit digests."""
    raw = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(raw, dtype=">i8").astype(np.int64).reshape(-1, 2)


# -- cuckoo filters -----------------------------------------------------------

class CuckooFilter:
    """16-bit fingerprints in buckets of four; tables of one size, a further one when full.

    A key has the same fingerprint and pair of buckets in every table, so
    which table a deletion takes it from makes no difference.
    """

    def __init__(self, buckets: int, raw: bytes = b""):
        self.buckets = buckets
        self.tables = list(np.frombuffer(raw, np.uint16).reshape(-1, buckets, SLOTS).copy()) if raw else []

    @classmethod
    def for_keys(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(4, int(np.ceil(np.log2(max(keys, 1) / SLOTS / 0.9 + 1)))))

    def bytes(self) -> bytes:
        return b"".join(t.tobytes() for t in self.tables)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        spread = (mark.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(5)
        return bucket ^ (spread.astype(np.int64) & (self.buckets - 1))

    def _places(self, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = ((k2.view(np.uint64) >> np.uint64(40)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        bucket = k2 & (self.buckets - 1)
        return mark, bucket, self._other(bucket, mark)

    def holds(self, k2: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(k2)
        found = np.zeros(len(k2), dtype=bool)
        for t in self.tables:
            found |= (t[a] == mark[:, None]).any(axis=1) | (t[b] == mark[:, None]).any(axis=1)
        return found

    @staticmethod
    def _put(table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put marks into free slots of their buckets; which ones found none."""
        order = np.argsort(bucket, kind="stable")
        by = bucket[order]
        rank = np.arange(len(by)) - np.searchsorted(by, by)
        free = table[by] == 0
        fits = rank < free.sum(axis=1)
        slot = np.argmax(np.cumsum(free, axis=1) == (rank + 1)[:, None], axis=1)
        table[by[fits], slot[fits]] = mark[order][fits]
        left = np.ones(len(by), dtype=bool)
        left[order[fits]] = False
        return left

    def insert(self, k2: np.ndarray) -> None:
        mark, bucket, _ = self._places(k2)
        if len(mark) and not self.tables:
            self.tables.append(np.zeros((self.buckets, SLOTS), np.uint16))
        for i in range(KICK_ROUNDS):
            if not len(mark):
                return
            table = self.tables[-1]
            left = self._put(table, mark, bucket)
            mark, bucket = mark[left], self._other(bucket[left], mark[left])
            left = self._put(table, mark, bucket)
            mark, bucket = mark[left], bucket[left]
            # one mark a bucket takes the place of another, which goes to its other bucket
            _, one = np.unique(bucket, return_index=True)
            out = table[bucket[one], i % SLOTS].copy()
            table[bucket[one], i % SLOTS] = mark[one]
            mark[one], bucket[one] = out, self._other(bucket[one], out)
        while len(mark):       # what is left homeless opens a further table
            self.tables.append(np.zeros((self.buckets, SLOTS), np.uint16))
            for _ in range(2):
                left = self._put(self.tables[-1], mark, bucket)
                mark, bucket = mark[left], self._other(bucket[left], mark[left])

    def delete(self, k2: np.ndarray) -> None:
        """Take keys out that are in; each takes one copy of its fingerprint."""
        for mark, a, b in zip(*self._places(k2), strict=True):
            for t, bucket in ((t, x) for t in reversed(self.tables) for x in (a, b)):
                at = np.flatnonzero(t[bucket] == mark)
                if len(at):
                    t[bucket, at[0]] = 0
                    break
            else:
                raise KeyError("a key to delete isn't in its filter")
        self.tables = [t for t in self.tables if t.any()]


# -- index ----------------------------------------------------------------------

@dataclass
class LineIndex:
    """references (k1, k2, id), shared (k1, k2, references, first_id), filters (shard, buckets, bytes)."""

    references: DataFrame
    shared: DataFrame
    filters: DataFrame
    shards: int


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"),
                            F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
                            F.xxhash64(body).alias("hash"), body.cast("binary").alias("text"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[list[bytes]]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            texts = part.column("text").to_pylist()
            yield part, texts, [line_keys(t) for t in texts]


def _distinct(keys: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of each text's distinct keys, and the text each belongs to."""
    sets = [list({k: None for k in own if k}) for own in keys]
    return _digests([k for own in sets for k in own]), np.repeat(np.arange(len(sets)), list(map(len, sets)))


def _reference_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _, keys in _slices(batches):
        digests, owner = _distinct(keys)
        ids = part.column("id").to_numpy()[owner]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(digests[:, 0])), pa.array(np.ascontiguousarray(digests[:, 1])),
             pa.array(ids)], names=["k1", "k2", "id"])


def _references(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return _rows(documents, doc_id, text).select("id", "text").mapInArrow(
        _reference_batches, f"{_KEYS}, id long")


def _shared(references: DataFrame) -> DataFrame:
    """Counts of keys that two ids or more refer to: partial aggregates, so a hot key is no hot task."""
    return references.groupBy("k1", "k2").agg(
        F.count("*").alias("references"), F.min("id").alias("first_id"), F.max("id").alias("last_id")) \
        .where("first_id < last_id").drop("last_id")


def _shard(shards: int):
    return F.pmod(F.col("k1"), F.lit(shards)).alias("shard")


def _changed_filters(filters: DataFrame, keys: DataFrame, shards: int) -> DataFrame:
    """Filters after ``keys`` (k1, k2, add): a task holds one shard's filter and changes."""
    def change(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        add = new["add"].to_numpy(dtype=bool)
        k2 = new["k2"].to_numpy(dtype=np.int64)
        if len(old):
            table = CuckooFilter(int(old["buckets"].iloc[0]), old["bytes"].iloc[0])
        else:
            table = CuckooFilter.for_keys(max(SHARD_KEYS // 2, int(add.sum())))
        table.delete(k2[~add])
        table.insert(k2[add])
        return pd.DataFrame({"shard": [key[0]], "buckets": [table.buckets], "bytes": [table.bytes()]})

    schema = "shard long, buckets long, bytes binary"
    return filters.groupBy("shard").cogroup(
        keys.select(_shard(shards), "k2", "add").groupBy("shard")).applyInPandas(change, schema)


def build(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
    """Index of a table of documents."""
    spark = documents.sparkSession
    references = stored(_references(documents, doc_id, text), "line-references")
    shared = stored(_shared(references), "line-counts")
    shards = max(1, -(-shared.count() // SHARD_KEYS))
    empty = spark.createDataFrame([], "shard long, buckets long, bytes binary")
    filters = _changed_filters(empty, shared.select("k1", "k2", F.lit(True).alias("add")), shards)
    return LineIndex(references, shared, stored(filters, "line-filters"), shards)


def _updated(index: LineIndex, references: DataFrame, touched: DataFrame) -> LineIndex:
    """The index with other references, where only ``touched`` keys can have other counts."""
    touched = stored(touched.select("k1", "k2").distinct(), "line-touched")
    now = stored(_shared(references.join(touched, ["k1", "k2"], "left_semi")), "line-counts")
    before = index.shared.join(touched, ["k1", "k2"], "left_semi")
    keys = now.join(before, ["k1", "k2"], "left_anti").select("k1", "k2", F.lit(True).alias("add")).unionByName(
        before.join(now, ["k1", "k2"], "left_anti").select("k1", "k2", F.lit(False).alias("add")))
    shared = index.shared.join(touched, ["k1", "k2"], "left_anti").unionByName(now)
    return LineIndex(references, stored(shared, "line-counts"),
                     stored(_changed_filters(index.filters, keys, index.shards), "line-filters"), index.shards)


def insert(index: LineIndex, documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
    """The index with further documents."""
    new = stored(_references(documents, doc_id, text), "line-references")
    return _updated(index, stored(index.references.unionByName(new), "line-references"), new)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents of the given ids (one column; null: those without id)."""
    gone = ids.select(F.coalesce(F.col(ids.columns[0]).cast("long"), F.lit(NO_ID)).alias("id")).distinct()
    return _updated(index, stored(index.references.join(gone, "id", "left_anti")
                                  .select("k1", "k2", "id"), "line-references"),
                    index.references.join(gone, "id", "left_semi"))


# -- de-duplication ---------------------------------------------------------------

def _broadcast_filters(index: LineIndex):
    """Shards' filters for all tasks, or None where they are too large for that."""
    size = index.filters.agg(F.sum(F.length("bytes"))).first()[0] or 0
    if size > FILTER_BYTES:
        return None
    rows = index.filters.collect()
    return index.filters.sparkSession.sparkContext.broadcast(
        {r["shard"]: (r["buckets"], bytes(r["bytes"])) for r in rows})


class _Known:
    """Which keys the filters know; all of them without filters."""

    def __init__(self, filters, shards: int):
        self.shards = shards
        self.filters = None if filters is None else {
            s: CuckooFilter(b, raw) for s, (b, raw) in filters.value.items()}

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        if self.filters is None:
            return np.ones(len(digests), dtype=bool)
        shard = digests[:, 0] % self.shards
        found = np.zeros(len(digests), dtype=bool)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.unique(shard):
            if s in self.filters:
                own = order[bounds[s]:bounds[s + 1]]
                found[own] = self.filters[s].holds(np.ascontiguousarray(digests[own, 1]))
        return found


_HALF = pa.schema([("doc_id", pa.int64()), ("id", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()),
                   ("n_lines", pa.int64()), ("kept_sha256", pa.string())])
_WHOLE = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                    ("kept_sha256", pa.string()), ("kept", pa.string())])


def deduplicate(documents: DataFrame, index: LineIndex, doc_id: str = "doc_id", text: str = "text",
                texts: bool = True) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256 and, with ``texts``, the kept text.

    ``index`` must hold the documents; others in it count as documents too.
    """
    rows = _rows(documents, doc_id, text)
    filters, shards = _broadcast_filters(index), index.shards

    def known_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(filters, shards)
        for part, _, keys in _slices(batches):
            digests, owner = _distinct(keys)
            has = known(digests)
            digests, owner = digests[has], owner[has]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.column("id").to_numpy()[owner]), pa.array(part.column("hash").to_numpy()[owner]),
                 pa.array(np.ascontiguousarray(digests[:, 0])), pa.array(np.ascontiguousarray(digests[:, 1]))],
                names=["id", "hash", "k1", "k2"])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without a known line get their digest; others keep their text for the join."""
        known = _Known(filters, shards)
        for part, bodies, keys in _slices(batches):
            digests, owner = _distinct(keys)
            waits = np.bincount(owner[known(digests)], minlength=len(bodies)) > 0
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("id"), part.column("hash"),
                pa.array([t if w or texts else None for t, w in zip(bodies, waits, strict=True)], pa.binary()),
                pa.array(list(map(len, keys)), pa.int64()),
                pa.array([None if w else hashlib.sha256(t).hexdigest()
                          for t, w in zip(bodies, waits, strict=True)], pa.string())], schema=_HALF)

    def dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                out = []
                for r in batch.slice(at, SLICE_ROWS).to_pylist():
                    body, gone, digest = r["text"], 0, r["kept_sha256"]
                    if r["drops"]:
                        drops = {(d["k1"], d["k2"]) for d in r["drops"]}
                        keys = line_keys(body)
                        at_key = dict(zip(filter(None, keys), map(tuple, _digests([k for k in keys if k]).tolist()),
                                          strict=True))
                        keep = [x for x, k in zip(body.split(b"\n"), keys, strict=True)
                                if not k or at_key[k] not in drops]
                        gone, body = len(keys) - len(keep), b"\n".join(keep)
                    if digest is None:
                        digest = hashlib.sha256(body).hexdigest()
                    out.append((r["doc_id"], r["n_lines"], gone, digest, body.decode() if texts else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _WHOLE, strict=True)], schema=_WHOLE)

    lines = rows.select("id", "hash", "text").mapInArrow(known_lines, f"id long, hash long, {_KEYS}")
    drops = lines.join(index.shared.select("k1", "k2", "first_id"), ["k1", "k2"]).where("first_id < id") \
        .groupBy("id", "hash").agg(F.collect_set(F.struct("k1", "k2")).alias("drops"))
    half = rows.mapInArrow(finished, "doc_id long, id long, hash long, text binary, n_lines long, kept_sha256 string")
    out = half.join(drops, ["id", "hash"], "left").select(
        "doc_id", "text", "n_lines", "kept_sha256", "drops").mapInArrow(
        dropped, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept string")
    return out if texts else out.drop("kept")


def oracle() -> str:
    """DuckDB SQL for the rows of a whole table's de-duplication."""
    space = " || ".join(f"chr({b})" for b in SPACE)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, {space}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), m AS (
  SELECT *, length(key) >= {LEAST_CHARS}
            AND coalesce(doc_id, {NO_ID}) > min(coalesce(doc_id, {NO_ID})) OVER (PARTITION BY key) AS gone
  FROM k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
