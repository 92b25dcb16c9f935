"""The corpus pipeline: from raw documents to a mixed training set.

Every stage works on all documents its predecessor kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.decontaminate import find_benchmark, n_hit
from meterlake.llm.mixing import mix_sources
from meterlake.llm.ngram_join import COPY_SALTS, near_duplicates, sets_of
from meterlake.llm.quality import score_quality
from meterlake.llm.secrets import redacted, secret_spans
from meterlake.sources.staging import drop, released, stage, stage_path

REJECT_BELOW = 0.5
ORACLE_SQL = None  # trained classifiers and hashed shuffles have no SQL form


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels).where(F.col("quality_score") >= REJECT_BELOW).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays: the one with the smallest doc_id (null comes first).

    Components are told apart by their sets, not by ids, which may be null or repeat on different texts.  Rows that repeat a doc_id with the same text are copies of each other: one of them stays.  Documents without words are no
    copies of anything and stay.
    """
    found = near_duplicates(docs).where("ref IS NOT NULL")
    per_row = found.groupBy("component", "doc_id", "ref").agg(F.count(F.lit(1)).alias("n"))
    first = per_row.groupBy("component").agg(F.min(F.struct("doc_id", "ref", "n")).alias("first"))
    first = stage(first.select(*(F.col(f"first.{c}").alias(f"_first_{c}") for c in ("doc_id", "ref", "n"))), "kept")
    # Many copies of one row are spread by the partition they come from.
    marked = docs.withColumn("_ref", sets_of("text")["ref"]).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(COPY_SALTS)))
    first = first.withColumn("_first_salt", F.explode(F.sequence(F.lit(0), F.lit(COPY_SALTS - 1))))
    kept = marked.join(first.hint("shuffle_hash"), F.expr("doc_id <=> _first_doc_id AND _ref = _first_ref AND _salt = _first_salt"))
    once = kept.where("_first_n = 1").select(*docs.columns)
    repeated = kept.where("_first_n > 1").groupBy("_first_doc_id", "_first_ref").agg(F.min(F.struct(*docs.columns)).alias("row"))
    wordless = marked.where("_ref IS NULL").select(*docs.columns)
    return once.unionByName(repeated.select("row.*")).unionByName(wordless)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, whether the item has an id or not."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_benchmark(docs, benchmark, without_id=True).where(n_hit() == 0).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark, and n_chars follows; the documents stay."""
    found = docs.withColumn("_spans", secret_spans("text"))
    hit = F.size("_spans") > 0
    found = found.withColumn("text", redacted("text", "_spans"))
    return found.withColumn("n_chars", F.when(hit, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the words the mix takes of each (taken, repeats counted) and its first slot in the mix."""
    return mix_sources(docs, keep=("lang",)).docs.select(
        "doc_id", "source", F.col("extra.lang").alias("lang"), "size", "source_size", "target", "taken", "first_slot"
    )


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("mixing sources", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again by the next.

    What a stage stages on its way, and its input, is dropped when its output is written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    token = uuid.uuid4().hex
    for number, (_, apply) in enumerate(STAGES):
        path = stage_path(spark, f"pipeline-{token}-{number}")
        with released(spark):
            apply(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
