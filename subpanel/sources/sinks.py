"""Sinks (P1, S3, S4, S5) and the CSV scan they are read back with.

Every sink replaces (never appends) and writes a directory of part files,
so a re-run is idempotent and the write is parallel. Dimension tables go
before the fact, mirroring the foreign-key load order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_ORDER = ["dim_region", "dim_rep", "dim_plan", "dim_customer", "fact_subscription_monthly"]


def write_csv_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """S3: one CSV directory per table, header, stable column order."""
    out = {}
    for name in [n for n in LOAD_ORDER if n in tables] + [n for n in tables if n not in LOAD_ORDER]:
        df = tables[name]
        path = os.path.join(folder, name)
        df.select(*df.columns).write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out


def write_table_store(tables: dict[str, DataFrame], folder: str,
                      partition_by: dict[str, str] | None = None) -> dict[str, str]:
    """Idempotent parquet store in load order; the fact is partitioned by
    its period key, so that :func:`replace_period` can replace one period."""
    partition_by = partition_by or {}
    out = {}
    for name in [n for n in LOAD_ORDER if n in tables] + [n for n in tables if n not in LOAD_ORDER]:
        w = tables[name].write.mode("overwrite")
        if name in partition_by:
            w = w.partitionBy(partition_by[name])
        path = os.path.join(folder, name)
        w.parquet(path)
        out[name] = path
    return out


def replace_period(df: DataFrame, path: str, column: str, value) -> None:
    """Replace the rows of one partition of a stored table, and no other file.

    Dynamic partition overwrite: tasks write to a staging folder, and only the
    commit of the whole job moves the finished partition into its place, so a
    write that fails or is killed on the way leaves the old rows. ``df`` must
    hold rows of that partition alone: any other value (null too) fails the
    write. Without rows nothing is replaced. Rows are rebalanced, so that a
    large period is written by many tasks.
    """
    there = F.when(F.col(column) == F.lit(value), F.col(column)).otherwise(F.raise_error(F.concat(
        F.lit(f"replace_period: a row outside {column}={value}: "),
        F.coalesce(F.col(column).cast("string"), F.lit("null"))))).cast(df.schema[column].dataType)
    df.withColumn(column, there).hint("rebalance").write.mode("overwrite") \
      .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: list[str]) -> str:
    """The table in one order over all files: each file is sorted and holds a range of its own.

    The range exchange cuts at any of the keys; end them with a unique one, so
    that a key with many rows is spread over files. Readers that filter by the
    first keys skip files and row groups by their statistics.
    """
    df.orderBy(*keys).write.mode("overwrite").parquet(path)
    return path


def sorted_positions(spark: SparkSession, path: str, keys: list[str], position: str = "position") -> DataFrame:
    """Rows of a :func:`write_sorted` table with their place in the order, from 1.

    A row's place is its index in its file plus the rows of the files before;
    files are ordered by their least keys (one row a file, so that the window
    takes as many rows as there are files).
    """
    rows = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_path")) \
        .withColumn("_index", F.col("_metadata.row_index"))
    files = rows.groupBy("_file").agg(F.min(F.struct(*keys)).alias("_least"), F.count("*").alias("_rows"))
    before = files.select("_file", (F.sum("_rows").over(Window.orderBy("_least")) - F.col("_rows")).alias("_before"))
    return rows.join(F.broadcast(before), "_file").withColumn(
        position, F.col("_before") + F.col("_index") + 1).drop("_file", "_index", "_before")


def read_csv_with_schema(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with a declared schema (no inference)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_results(sections: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One JSON directory per named result section."""
    out = {}
    for name, df in sections.items():
        path = os.path.join(folder, name)
        df.write.mode("overwrite").json(path)
        out[name] = path
    return out
