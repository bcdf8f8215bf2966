"""The corpus pipeline: from raw documents to shards, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared checkpoint folder and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.

* language: documents go whose language isn't one of ``LANGUAGES`` (None: any
  learnt one), or can't be told: no letter, or a score below ``LEAST_SCORE``.
  Languages are learnt from the labelled rows; without any, all documents stay;
* near_duplicates: of each group that five-word shingles link at a Jaccard
  similarity of 0.8, the document of least doc_id stays;
* decontamination: documents that hold a benchmark item go;
* mixing: each document is taken as often as its source's target calls for
  (0, 1 or 2 times; a document taken twice is two rows);
* sharding: every row gets its shard and slot.

Rows may repeat and ids may be null or shared: stages that decide by a join
know a row by its doc_id and text, and equal rows share their fate (of equal
rows with words, near_duplicates keeps one). Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subpanel.llm import decontamination, jaccard, language, mixing, sharding
from subpanel.llm.common import id_bucket, read_table, stored

# No SQL states suffix automata, edit verification or the packing: see tests/llm/test_pipeline.py.
ORACLE_SQL = None

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
LANGUAGES: tuple[str, ...] | None = None
LEAST_SCORE = 0.52    # 0.5: the second language names the text in as few phrases as the first


def _row_id() -> Column:
    """What a row is known by: its doc_id and its text's hash."""
    return F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"))


def _joined(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of docs that ``decided`` (doc_id, text_hash, ...) names, with its other columns.

    Plain key columns, so that a later step by the same keys needs no further
    exchange of the texts; a null id is keyed as the empty text.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    other = decided.select(F.col("text_hash").alias("_hash"), key.alias("_id"),
                           *[c for c in decided.columns if c not in ("doc_id", "text_hash")])
    return docs.withColumn("_hash", F.xxhash64("text")).withColumn("_id", key).join(other, ["_hash", "_id"])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    training = docs.where(id_bucket("doc_id", 3) != 1)
    if training.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).isEmpty():
        return docs
    names = docs.columns
    found = language.identify_languages(docs, training, keep=names).toDF(
        *[f"c{i}" for i in range(len(names))], "lang_pred", "score")
    stays = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    if LANGUAGES is not None:
        stays &= F.col("lang_pred").isin(*LANGUAGES)
    return found.where(stays).select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard.jaccard_components(docs.select(_row_id().alias("id"), "text"), doc_id="id",
                                        k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    stays = groups.where((F.col("n_shingles") > 0) & (F.col("doc_id") == F.col("component_id"))) \
        .select("doc_id.doc_id", "doc_id.text_hash").distinct()
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return _joined(docs, stays).dropDuplicates(["_hash", "_id"]).select(*docs.columns).unionByName(
        docs.where(wordless))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(
        docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]), least_words=1)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix(docs, carry={"text_hash": F.xxhash64("text")})
    copies = taken.groupBy("doc_id", "text_hash").agg(F.max("copies").alias("_copies"))
    return _joined(docs, copies).withColumn("_copy", F.explode(F.array_repeat(
        F.lit(0), F.col("_copies").cast("int")))).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
