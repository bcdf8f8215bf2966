"""Reading the driver's parquet tables (S1/S2) and the star-schema sinks.

Every read names the columns it needs so the scan's ``ReadSchema`` is pruned;
filters written later are pushed into the parquet scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Read one table; fail early with a hint when the input is absent."""
    path = table_path(sf_dir, name)
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(
            f"{path} does not exist; point sf_dir at a folder holding "
            f"{', '.join(TPCH_TABLES)} as <name>.parquet")
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return df

