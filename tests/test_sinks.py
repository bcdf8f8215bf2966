"""Sinks round-trip: CSV mirror, partitioned store, JSON sections."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from subpanel.plans.report import SECTIONS, write_report
from subpanel.plans.registry import load_all
from subpanel.sources import sinks

from .conftest import SF_SMALL


def test_csv_and_store_round_trip(spark):
    df = spark.range(0, 50).select(F.col("id").cast("int").alias("k"),
                                   (F.col("id") % 3).cast("int").alias("period_key"),
                                   F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("x")).alias("s"))
    base = tempfile.mkdtemp(prefix="subpanel-sink-", dir="/tmp")
    csv = sinks.write_csv_tables({"t": df}, base + "/csv")
    back = sinks.read_csv_with_schema(spark, csv["t"], df.schema)
    assert back.count() == 50
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert back.where(F.col("s").isNull()).count() == 8
    store = sinks.write_table_store({"t": df}, base + "/store", {"t": "period_key"})
    store2 = sinks.write_table_store({"t": df}, base + "/store", {"t": "period_key"})  # idempotent
    assert store == store2 and spark.read.parquet(store["t"]).count() == 50


def test_report_sections_are_registered_and_write(spark):
    queries, _ = load_all()
    assert all(q in queries for q in SECTIONS.values())
    out = tempfile.mkdtemp(prefix="subpanel-report-", dir="/tmp")
    paths = write_report(spark, SF_SMALL, out, ["repairs", "fig01_mrr_trend"])
    assert spark.read.json(paths["repairs"]).count() == 8
    assert spark.read.json(paths["fig01_mrr_trend"]).count() > 0


def _panel(spark, n, hot):
    """Rows (customer, month, row number); one customer holds ``hot`` of them."""
    customer = F.when(F.col("id") < hot, F.lit(7)).otherwise(F.col("id") % 50)
    return spark.range(n).select(customer.cast("int").alias("customer_id"),
                                 (F.col("id") % 24).cast("int").alias("date_key"), F.col("id").alias("fact_id"),
                                 (F.col("id") % 3).cast("int").alias("period_key"))


def _files(path):
    return {os.path.relpath(os.path.join(at, f), path): os.stat(os.path.join(at, f)).st_mtime_ns
            for at, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


def test_sorted_store_has_disjoint_ranges_and_splits_a_hot_customer(spark):
    keys = ["customer_id", "date_key", "fact_id"]
    path = tempfile.mkdtemp(prefix="subpanel-sorted-", dir="/tmp") + "/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a few small files
    try:
        sinks.write_sorted(_panel(spark, 30_000, 10_000).repartition(6), path, keys)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    key = F.struct(*keys)
    ranges = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count_if(F.col("customer_id") == 7).alias("hot")) \
        .orderBy("lo").collect()
    assert all(tuple(a["hi"]) < tuple(b["lo"]) for a, b in zip(ranges, ranges[1:]))
    assert sum(r["hot"] > 0 for r in ranges) > 1
    rows = sinks.sorted_positions(spark, path, keys).orderBy("position").select("position", *keys).collect()
    assert [r[0] for r in rows] == list(range(1, 30_001))
    assert all(tuple(a)[1:] < tuple(b)[1:] for a, b in zip(rows, rows[1:]))


def test_replacing_one_period_leaves_the_other_files(spark):
    path = tempfile.mkdtemp(prefix="subpanel-period-", dir="/tmp")
    path = sinks.write_table_store({"t": _panel(spark, 300, 0)}, path, {"t": "period_key"})["t"]
    before = _files(path)
    new = spark.range(5).select(F.lit(1).alias("customer_id"), F.lit(2).alias("date_key"), F.col("id").alias("fact_id"),
                                F.lit(1).alias("period_key"))
    sinks.replace_period(new, path, "period_key", 1)
    after = _files(path)
    assert {f: t for f, t in before.items() if "period_key=1" not in f} == \
        {f: t for f, t in after.items() if "period_key=1" not in f}
    counts = dict(spark.read.parquet(path).groupBy("period_key").count().collect())
    assert counts == {0: 100, 1: 5, 2: 100}
    sinks.replace_period(new.limit(0), path, "period_key", 1)
    assert _files(path) == after


def test_a_failed_replacement_leaves_the_old_table(spark):
    path = tempfile.mkdtemp(prefix="subpanel-period-", dir="/tmp")
    path = sinks.write_table_store({"t": _panel(spark, 300, 0)}, path, {"t": "period_key"})["t"]
    before = _files(path)
    dies = F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long")
    new = spark.range(200).repartition(4).select(F.lit(1).alias("customer_id"), F.lit(2).alias("date_key"),
                                                 dies.alias("fact_id"), F.lit(1).alias("period_key"))
    other = _panel(spark, 30, 0)       # rows of periods 0 to 2
    for df in (new, other, other.withColumn("period_key", F.lit(None).cast("int"))):
        with pytest.raises(Exception):
            sinks.replace_period(df, path, "period_key", 1)
        assert _files(path) == before and spark.read.parquet(path).count() == 300


def test_breakdowns_come_sorted(spark):
    queries, _ = load_all()
    regions = [r["total_mrr"] for r in queries["a2_region_raw"](spark, SF_SMALL).collect()]
    assert regions == sorted(regions, reverse=True)
    for name, size in (("a13_revenue_by_dim", "total_mrr"), ("a7_a8_churn_wilson", "customers")):
        rows = [(r["dimension"], -r[size]) for r in queries[name](spark, SF_SMALL).collect()]
        assert rows == sorted(rows)
