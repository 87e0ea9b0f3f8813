"""The corpus pipeline: documents through the filtering operators into packed sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; its result is written as Parquet and read again. All but the
last return the columns of documents. Rows with a null id are their own
groups and stay; repeated rows of an id and its copies are one group, of which
the row with the smallest id stays, once for each different text of that id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pawprint.llm import decontam, jaccard_join, packing, secret_scan, weak_quality
from pawprint.llm.common import load, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Bytes of an Arrow batch. An executor holds a few for each of its Python workers, beside
#: what these keep from the stages before.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches by bytes, as texts may be long; which rows share one changes no result."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer keeps."""
    small_batches(spark)
    return weak_quality.keep_good(docs.select(*COLUMNS))


def jaccard_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest id."""
    small_batches(spark)
    groups = jaccard_join.link_components(docs)
    stay = groups.filter((F.col("doc_id") == F.col("component_id"))).select("doc_id").distinct()
    kept = docs.join(stay, "doc_id", "left_semi")
    return (kept.select(*COLUMNS).dropDuplicates(["doc_id", "text"])
            .unionByName(docs.filter("doc_id IS NULL").select(*COLUMNS)))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    small_batches(spark)
    found = decontam.decontaminate(docs, load(spark, sf_dir, "benchmark"))
    hit = found.filter("contaminated").select(F.col("doc_id").alias("id")).distinct()
    return (docs.join(hit, F.col("doc_id").eqNullSafe(F.col("id")), "left_anti")
            .select(*COLUMNS))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; n_chars follows the text."""
    small_batches(spark)
    masked = secret_scan.mask_secrets(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences of 4096 ids."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_groups),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Models, tokens and packing are not expressible; tests/llm hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = load(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
