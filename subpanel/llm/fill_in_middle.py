"""Fill-in-the-middle transformation by secondary-sort assembly (operator 12).

A text is cut at two hashed places into prefix, middle and suffix and written
in one of three forms: plain (as it is), psm (``<P>`` prefix ``<S>`` suffix
``<M>`` middle) or spm (``<S>`` suffix ``<P>`` prefix ``<M>`` middle).

No task ever builds an output as one string to digest it. Each text is emitted
as pieces of at most ``PIECE_CHARS`` units (code points), keyed by the row and
the piece's place in the output; rows are dealt out by key and sorted within
partitions (``repartition`` and ``sortWithinPartitions``, the DataFrame form
of repartition-and-sort-within-partitions), and a task streams the sorted
pieces into an incremental digest. The same stream tells from the output alone
(its form and markers) where each piece stood in the text; sorting once more
within the partition, without another exchange, streams the pieces in that
order into the digest of the restored text.

A row is known by a number of its own, so repeated rows and hot ids spread
evenly. What a task holds is one batch of pieces, however long a text is.

Defined results: null text is the empty text; empty texts are plain; a null id
hashes as the empty string after the seed; repeated rows give repeated equal
rows; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 8192
BATCH_BYTES = 4 << 20
SEED = "1:"
PLAIN_FROM = 90   # h3 % 100 from here on: plain
SPM_BELOW = 20    # h4 % 100 below: spm
MARKERS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
TEXT_ORDER = {"prefix": 0, "middle": 1, "suffix": 2}

_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
         ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("piece", pa.binary()), *_HEAD])
_PLACED = pa.schema([*_PIECES, ("output_sha256", pa.string())])
_DIGESTS = pa.schema([*_HEAD, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_OUTPUTS = pa.schema([*_HEAD, ("output", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def cut(doc_id: int | None, text: str, seed: str = SEED) -> tuple[str, int, int]:
    """Form of a text and the ends of its prefix and its middle, in code points."""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in MARKERS.values()):
        return "plain", 0, len(text)
    return "spm" if h4 % 100 < SPM_BELOW else "psm", a, b


class _Rows:
    """Rows gathered into record batches of about BATCH_BYTES."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.bytes += size + 64
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.schema)
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return out


def _segments(text: str, form: str, a: int, b: int) -> Iterator[bytes]:
    """The output's pieces in order: markers on their own, texts in chunks of units."""
    spans = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(text))}
    for name in ORDERS.get(form, (None,)):
        start, end = spans[name] if name else (0, len(text))
        if name:
            yield MARKERS[name].encode()
        for at in range(start, end, PIECE_CHARS):
            yield text[at:min(at + PIECE_CHARS, end)].encode()


def _cut_batches(batches: Iterator[pa.RecordBatch], seed: str) -> Iterator[pa.RecordBatch]:
    rows = _Rows(_PIECES)
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64).to_pydict()
            for number, doc_id, text in zip(part["row"], part["doc_id"], part["text"], strict=True):
                form, a, b = cut(doc_id, text, seed)
                head = (doc_id, len(text), form, *((None, None) if form == "plain" else (a, b - a)))
                place = 0
                for piece in _segments(text, form, a, b) if text else (b"",):
                    if rows.add((number, place, piece, *(head if place == 0 else (None,) * 5)), len(piece)):
                        yield rows.batch()
                    place += 1
    yield rows.batch()


def pieces(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """Pieces of all outputs (row, place, piece; a row's first piece has its facts), in
    order within partitions, all of a row in one."""
    rows = documents.select(F.monotonically_increasing_id().alias("row"),
                            F.col(doc_id).cast("long").alias("doc_id"),
                            F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(lambda batches: _cut_batches(batches, seed), _ddl(_PIECES)) \
        .repartition("row").sortWithinPartitions("row", "place")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, first of its pieces, piece, head) of each sorted row; head on the first alone."""
    last = None
    for batch in batches:
        names = batch.schema.names[3:]
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256).to_pydict()
            heads = zip(*(part[c] for c in names), strict=True)
            for number, piece, head in zip(part["row"], part["piece"], heads, strict=True):
                yield number, number != last, piece, head
                last = number


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each output, and every piece with its place in the text as the output tells it.

    A row's facts and digest come last but carry place -1, so they sort first.
    """
    rows = _Rows(_PLACED)
    named = {m.encode(): name for name, m in MARKERS.items()}
    nothing = (None,) * 6
    number = head = digest = segment = None
    count = 0
    for next_row, first, piece, facts in _documents(batches):
        if first:
            if head is not None and rows.add((number, -1, None, *head, digest.hexdigest()), 100):
                yield rows.batch()
            number, head, digest, segment, count = next_row, facts, hashlib.sha256(), 0, 0
        digest.update(piece)
        if head[2] != "plain" and piece in named:
            segment = TEXT_ORDER[named[piece]] << 48
            continue
        count += 1
        if rows.add((number, segment + count, piece, *nothing), len(piece)):
            yield rows.batch()
    if head is not None:
        rows.add((number, -1, None, *head, digest.hexdigest()), 100)
    yield rows.batch()


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each restored text from pieces in the text's order."""
    rows = _Rows(_DIGESTS)
    head = digest = None
    for _, first, piece, facts in _documents(batches):
        if first:
            if head is not None and rows.add((*head, digest.hexdigest()), 200):
                yield rows.batch()
            head, digest = facts, hashlib.sha256()
        else:
            digest.update(piece)
    if head is not None:
        rows.add((*head, digest.hexdigest()), 200)
    yield rows.batch()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _Rows(_OUTPUTS)
    head, parts = None, []

    def close() -> bool:
        text = b"".join(parts).decode()
        return rows.add((*head, text), len(text))

    for _, first, piece, facts in _documents(batches):
        if first:
            if head is not None and close():
                yield rows.batch()
            head, parts = facts, []
        parts.append(piece)
    if head is not None:
        close()
    yield rows.batch()


def fill_in_middle(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   seed: str = SEED) -> DataFrame:
    """One row per document with its output text (a task holds one output at a time)."""
    return pieces(documents, doc_id, text, seed).mapInArrow(_texts, _ddl(_OUTPUTS))


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """One row per document: facts of the cut and digests of output and restored text."""
    return pieces(documents, doc_id, text, seed) \
        .mapInArrow(_assemble, _ddl(_PLACED)).sortWithinPartitions("row", "place") \
        .mapInArrow(_restore, _ddl(_DIGESTS))


def oracle() -> str:
    """DuckDB SQL for the rows of :func:`digests`; the restored text must be the text itself."""
    number = "('0x' || substr(h, {}, 8))::BIGINT"
    marked = " OR ".join(f"contains(t, '{m}')" for m in MARKERS.values())
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), c AS (
  SELECT *, {number.format(1)} % (n + 1) AS c1, {number.format(9)} % (n + 1) AS c2,
         CASE WHEN n = 0 OR {marked} OR {number.format(17)} % 100 >= {PLAIN_FROM} THEN 'plain'
              WHEN {number.format(25)} % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM d
), s AS (
  SELECT *, substr(t, 1, least(c1, c2)) AS p, substr(t, least(c1, c2) + 1, abs(c1 - c2)) AS m,
         substr(t, greatest(c1, c2) + 1) AS s
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
