"""Sharding by vector bin packing (operator 3).

Documents of equal text form a group. Each group is a vector of its parts of
all bytes, tokens and rows, and goes to the shard where the dot product of
that vector with the shard's residual capacity is highest, larger groups
first. The law kept is ``bytes``: shards' sizes are near equal.

Packing is done in two tiers, so that neither a task nor the driver ever sees
all groups. *Heavy* pieces (more than 1 / (40 * HEAVY) of a dimension, with 40
shards; their number is bounded by that part, whatever the data) are packed
first, by one small task. All others are dealt by hash into blocks of about
``BLOCK_GROUPS`` groups; each block packs its groups into its even part of
what the heavy pieces left of each shard. A group larger than
1 / (40 * SPLIT) of a dimension is first split into even pieces by a number
that each row gets when it is written, so a hot group is spread over shards as
the law needs, be it one row repeated.

Slots number a shard's documents without gaps: a running count over blocks
plus a place within the block, so no task ranks a whole shard.

Defined results: null text has size 16, no tokens, crc32 0, and is grouped
with empty texts; repeated rows and null ids are documents of their own; an
empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8_bytes, written

SHARDS = 40
SPLIT = 25             # pieces of a group are at most 1 / SPLIT of a shard
HEAVY = 100            # a piece of 1 / HEAVY of a shard or more is packed in tier one
BLOCK_GROUPS = 20_000  # groups packed by one task
OVERHEAD = 16          # bytes a document takes besides its text
WEIGHTS = (4.0, 1.0, 1.0)  # of bytes, tokens, rows in the dot product
ROOM = 0.05            # capacity beyond the even part, so that residuals stay positive
DIMENSIONS = ["size", "tokens", "rows"]


def pack(groups: np.ndarray, capacity: np.ndarray, first: int = 0) -> np.ndarray:
    """Shard of each group: largest dot product with the residual capacity.

    ``groups`` is n x 3, ``capacity`` shards x 3. Groups go in order of their
    largest part, ties in the order given; ties between shards go round from
    shard ``first`` on.
    """
    total = np.maximum(capacity.sum(axis=0), 1e-9)
    scale = np.array(WEIGHTS) * (len(capacity) / total)
    vectors = groups * (len(capacity) / total)
    order = np.argsort(-vectors.max(axis=1), kind="stable")
    residual = np.roll(capacity * scale, -first, axis=0)  # weights enter by the residual
    taken = groups * scale
    out = np.empty(len(groups), dtype=np.int64)
    for i in order:
        shard = int(np.argmax(residual @ vectors[i]))
        residual[shard] -= taken[i]
        out[i] = shard
    return (out + first) % len(capacity)


def _described(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, size, crc32, tokens and group digest: the only pass over the texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(doc_id).alias("doc_id"), (utf8_bytes(text) + F.lit(OVERHEAD)).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.md5(body.cast("binary")).alias("digest"),
        F.xxhash64(F.col(doc_id).cast("string")).alias("hash"),
        F.xxhash64(F.monotonically_increasing_id()).alias("row"))


def shard(documents: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
          block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = written(_described(documents, doc_id, text))
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    whole = [max(int(x or 0), 1) for x in total]
    part = lambda scale: F.greatest(*[
        F.col(c) / F.lit(float(w)) for c, w in zip(DIMENSIONS, whole, strict=True)]) * (shards * scale)

    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
            F.count("*").alias("rows")]
    # groups above the split size: at most 3 * shards * SPLIT rows
    large = rows.groupBy("digest").agg(*sums).where(part(SPLIT) > 1) \
        .select("digest", F.ceil(part(SPLIT)).alias("pieces"))
    # rows of a large group are dealt by number: they may all have one id
    pieces = rows.join(F.broadcast(large), "digest", "left").withColumn("hash", F.when(
        F.col("pieces").isNotNull(), F.col("row")).otherwise(F.col("hash"))).withColumn("piece", F.coalesce(
            F.pmod(F.col("hash"), F.col("pieces")), F.lit(0)))
    groups = written(pieces.groupBy("digest", "piece").agg(*sums)
                     .withColumn("heavy", part(HEAVY) > 1))

    blocks = max(1, -(-groups.where("not heavy").count() // block_groups))
    # tier one: at most 3 * shards * HEAVY pieces
    heavy = groups.where("heavy").orderBy("digest", "piece").select(
        "digest", "piece", *DIMENSIONS).toPandas()
    capacity = np.tile(np.array(whole, dtype=float) * (1 + ROOM) / shards, (shards, 1))
    vectors = heavy[DIMENSIONS].to_numpy(dtype=float)
    heavy["shard"] = pack(vectors, capacity)
    np.subtract.at(capacity, heavy["shard"].to_numpy(), vectors)
    left = capacity / blocks

    def pack_block(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["digest", "piece"], ignore_index=True)
        vectors = block[DIMENSIONS].to_numpy(dtype=float)
        return pd.DataFrame({
            "digest": block["digest"], "piece": block["piece"], "block": key[0],
            "shard": pack(vectors, left, first=(int(key[0]) * 7) % shards)})

    by_block = F.pmod(F.xxhash64("digest", "piece"), F.lit(blocks)).alias("block")
    schema = "digest string, piece long, block long, shard long"
    light = groups.where("not heavy").select("digest", "piece", *DIMENSIONS, by_block) \
        .groupBy("block").applyInPandas(pack_block, schema)
    first_tier = documents.sparkSession.createDataFrame(
        [(r.digest, int(r.piece), int(i % blocks), int(r.shard))
         for i, r in enumerate(heavy.itertuples())], schema)
    placed = pieces.select("doc_id", "size", "text_crc32", "digest", "piece", "hash").join(
        light.unionByName(first_tier), ["digest", "piece"])
    return _slots(placed)


def _slots(placed: DataFrame) -> DataFrame:
    """Gapless numbers within a shard: documents of earlier parts plus the place in one's own."""
    placed = written(placed.withColumn("part", F.concat_ws(
        "-", "block", F.pmod(F.col("hash"), F.lit(16)))))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy(
        "digest", "hash", "doc_id")) - 1
    return placed.withColumn("place", place).join(ahead, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("ahead") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
