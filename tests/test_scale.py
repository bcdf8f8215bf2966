"""Shape of the shared steps: what is shuffled, stored and dealt out."""

import os

import numpy as np
from pyspark.sql import functions as F

from subpanel.operators import density, importance, quality
from subpanel.session import checkpoint_dir
from subpanel.sources import star

from .conftest import SF_SMALL


def test_measures_are_computed_after_the_last_join(spark):
    plan = star.master(spark, SF_SMALL, hire=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan.split("Join", 1)[0] and "md5" not in plan.split("Join", 1)[1]


def test_keep_first_sorts_no_rows_ahead_of_its_exchange(spark):
    rows = [(1, 5, "a"), (1, 4, "b"), (2, 9, "c"), (None, 3, "d"), (None, 2, "e"), (3, None, "f")]
    kept = star.keep_first(spark.createDataFrame(rows, "k int, v int, s string"), "k", ["v"])
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(1, 4, "b"), (2, 9, "c"), (None, 2, "e"), (3, None, "f")], key=repr)
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "Sort" not in plan.split("Exchange", 1)[1] and "Aggregate" not in plan.split("Exchange", 1)[1]


def test_the_panel_is_stored_once_by_period_and_labels_beside_it(spark, tmp_path):
    folder = tmp_path / "own"
    folder.symlink_to(SF_SMALL)
    panel = quality.clean(spark, str(folder))
    import hashlib
    digest = hashlib.sha1(os.path.abspath(str(folder)).encode()).hexdigest()[:12]
    at = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables", spark.sparkContext.applicationId, digest)
    assert sorted(os.listdir(at)) == ["dedup_panel", "panel_labels"]
    assert any(p.startswith("period_key=") for p in os.listdir(os.path.join(at, "dedup_panel")))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    last = panel.groupBy("customer_id").agg(F.max("period_key").alias("p"), F.max("is_churned").alias("c"))
    final = panel.agg(F.max("period_key")).first()[0]
    assert last.where((F.col("p") < final).cast("int") != F.col("c")).count() == 0
    assert panel.count() == quality.clean(spark, str(folder), label=False).count()


def test_pairs_of_leaves_are_dealt_to_tasks_however_small_their_list(spark):
    leaves = spark.range(64).select(
        F.col("id").alias("leaf"), F.array(F.col("id").cast("double")).alias("xs"), F.array(F.lit(1)).alias("ws"))
    pairs = spark.range(64).select(F.col("id").alias("na"), F.explode(F.sequence("id", F.lit(63))).alias("nb")).coalesce(1)
    dealt = density._leaf_pairs(pairs, leaves)
    rows = dealt.select("p", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.na, r.nb) for row in rows for r in row.p) == [(a, b) for a in range(64) for b in range(a, 64)]
    assert max(len(row.p) for row in rows) <= density.DEALT and len({row.task for row in rows}) > 1


def test_permuted_ranks_as_arrays_equal_the_column_expression(spark):
    for m in (1, 2, 7, 50, 401):
        keys = importance.round_keys("nps_score", m)
        column = spark.range(m).select(importance.shuffled_rank(F.col("id"), F.array(*[
            F.lit(k).cast("long") for k in keys]), m).alias("to"), "id").orderBy("id").collect()
        found = importance.shuffled_ranks(np.arange(m), keys, m).tolist()
        assert found == [r.to for r in column] and sorted(found) == list(range(m))
