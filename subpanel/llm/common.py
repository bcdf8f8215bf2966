"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """The named columns of one input table, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    Later steps neither redo the work nor depend on an executor's disk.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer referenced.

    Its cleaner acts when the driver's JVM collects garbage, which on a driver
    with memory to spare may be long after a step's files are of no use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_bucket(id_column: str, buckets: int):
    """crc32 of the id as text, modulo ``buckets``; null ids count as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % buckets


def utf8_bytes(text_column: str):
    """UTF-8 bytes of a text, 0 for null."""
    return F.coalesce(F.octet_length(F.col(text_column)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and reread.

    For larger intermediates than :func:`written`: compressed, and later reads
    take only the columns they need. Each call has a folder of its own.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder that :func:`stored` wrote ``df`` to; nothing may read it any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/llm-" in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sample_texts(documents: DataFrame, doc_id: str, text: str, rows: int, chars: int) -> list[str]:
    """About ``rows`` distinct texts, cut to ``chars``, chosen by row hash; at most twice as many.

    For models and caches that are fitted on a bounded sample. The hash
    threshold follows the row count, so a task sends its share alone.
    """
    total = max(documents.count(), 1)
    key = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.col(text)), F.lit(1 << 40))
    some = documents.where(F.col(text).isNotNull() & (key < int((1 << 40) * min(1.0, rows / total)))) \
        .select(F.substring(F.col(text), 1, chars).alias("t")).limit(2 * rows)
    return sorted({row[0] for row in some.collect()})
