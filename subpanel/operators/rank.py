"""X1 distributed global rank and W7 average (tie-aware) rank.

``Window.orderBy`` without ``partitionBy`` moves every row into one task.
``global_rank`` instead lets Spark range-partition and sort (``orderBy``),
tags each row with ``monotonically_increasing_id`` (partition index in the
upper bits, position in the lower 33 bits), writes that to the reliable
checkpoint folder so the range sample is never redrawn, counts rows per
partition (one row per partition: bounded), turns the counts into offsets
and broadcasts them back. Rank = offset + position + 1.

The order must be total: callers append a unique id as the last key, so
ties have one answer in every layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_POS_BITS = 33


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank",
                totals: dict[str, str] | None = None) -> DataFrame:
    """Append a 1-based dense row number in the total order ``order``.

    ``totals`` names running sums to append as well, new column → summed
    column: the sum over all rows before this one. They come from the same
    sort: a running sum within each partition plus what earlier ones add up to.
    """
    totals = totals or {}
    tagged = df.orderBy(*order).withColumn("__x1_mid", F.monotonically_increasing_id())
    tagged = reliable_checkpoint(tagged)
    with_pid = tagged.withColumn("__x1_pid", F.shiftright(F.col("__x1_mid"), _POS_BITS)) \
                     .withColumn("__x1_pos", F.col("__x1_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
    counts = with_pid.groupBy("__x1_pid").agg(
        F.count("*").alias("__x1_cnt"), *[F.sum(w).alias(f"__x1_t_{out}") for out, w in totals.items()])
    # one row per partition: a bounded frame, so a window without partitionBy is fine
    earlier = Window.orderBy("__x1_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__x1_pid", F.sum("__x1_cnt").over(earlier).alias("__x1_off"),
        *[F.coalesce(F.sum(f"__x1_t_{out}").over(earlier), F.lit(0)).alias(f"__x1_o_{out}")
          for out in totals])
    ranked = with_pid.join(F.broadcast(offsets), "__x1_pid")
    inside = Window.partitionBy("__x1_pid").orderBy("__x1_pos").rowsBetween(Window.unboundedPreceding, -1)
    for out, w in totals.items():
        ranked = ranked.withColumn(out, F.col(f"__x1_o_{out}") + F.coalesce(F.sum(w).over(inside), F.lit(0)))
    return ranked.withColumn(rank_col, F.coalesce(F.col("__x1_off"), F.lit(0)) + F.col("__x1_pos") + 1) \
                 .drop("__x1_mid", "__x1_pid", "__x1_pos", "__x1_off", *[f"__x1_o_{out}" for out in totals])


def average_rank(df: DataFrame, value_col: str, group_cols=(), out_col: str | None = None) -> DataFrame:
    """Pandas ``rank(method='average')`` of ``value_col`` within groups.

    Aggregates to the distinct-value grain first (value, cnt), then takes a
    cumulative count over values. With ``group_cols`` the cumulative window is
    partitioned by group (each group's distinct values, not its rows, sit in
    one task); without groups the distinct values are ranked by
    :func:`global_rank`. Nulls keep a null rank.
    """
    out_col = out_col or f"{value_col}_rank"
    group_cols = list(group_cols)
    counts = df.where(F.col(value_col).isNotNull()) \
               .groupBy(*group_cols, value_col).agg(F.count("*").alias("__x1_cnt"))
    if group_cols:
        w = Window.partitionBy(*group_cols).orderBy(value_col) \
                  .rowsBetween(Window.unboundedPreceding, -1)
        ranks = counts.withColumn("__x1_before", F.coalesce(F.sum("__x1_cnt").over(w), F.lit(0)))
    else:
        # cumulative count before each distinct value
        ranks = global_rank(counts, [F.col(value_col).asc()], "__x1_r", {"__x1_before": "__x1_cnt"})
    ranks = ranks.select(*group_cols, value_col,
                         (F.col("__x1_before") + (F.col("__x1_cnt") + 1) / 2.0).alias(out_col))
    return df.join(ranks, [*group_cols, value_col], "left")

