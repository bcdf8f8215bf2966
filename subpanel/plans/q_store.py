"""Registered queries of the stored panel: total order (P1) and replaced periods."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import sinks, star
from .oracle import with_prelude
from .registry import register

P1_KEYS = ["customer_id", "date_key", "fact_id"]


def _folder(spark, name):
    return os.path.join(checkpoint_dir(spark), "stores", spark.sparkContext.applicationId,
                        f"{name}-{uuid.uuid4().hex}")


@register("p1_total_order", with_prelude("""
SELECT row_number() OVER (ORDER BY customer_id, date_key, fact_id) AS position,
       customer_id, date_key, fact_id, round(mrr, 2) AS mrr
FROM master"""))
def p1_total_order(spark, sf_dir):
    """The panel written in order of customer and month, each row with its place in the files."""
    master = star.master(spark, sf_dir)
    path = sinks.write_sorted(master, _folder(spark, "sorted"), P1_KEYS)
    return sinks.sorted_positions(spark, path, P1_KEYS).select(
        "position", *P1_KEYS, F.round("mrr", 2).alias("mrr"))


@register("s4_replace_period", with_prelude("""
SELECT period_key, count(*) AS rows, cast(sum(CASE WHEN period_key = last THEN 2 * seats ELSE seats END) as bigint)
         AS seats
FROM fact, (SELECT max(period_key) AS last FROM fact)
GROUP BY period_key"""))
def s4_replace_period(spark, sf_dir):
    """A fact store by period whose last period is then replaced (twice the seats); what it holds."""
    fact = star.fact(spark, sf_dir, dedupe=True, with_plan=False).select(
        "fact_id", "customer_id", "date_key", "period_key", "seats", "mrr")
    path = sinks.write_table_store({"fact": fact}, _folder(spark, "periods"), {"fact": "period_key"})["fact"]
    store = spark.read.parquet(path)
    last = store.agg(F.max("period_key")).first()[0]
    if last is not None:
        # read from the source, not from the files that are replaced
        changed = fact.where(F.col("period_key") == last).withColumn("seats", (F.col("seats") * 2).cast("int"))
        sinks.replace_period(changed, path, "period_key", last)
        store = spark.read.parquet(path)
    return store.groupBy("period_key").agg(F.count("*").alias("rows"), F.sum("seats").cast("long").alias("seats"))
