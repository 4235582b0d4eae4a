"""A corpus pipeline of five stages over `documents`. Each one works on all that the one before it kept.

Quality rules drop documents, line dedup takes out repeated lines, the Jaccard join drops near
duplicates, secret scans mask secrets, and best-fit packing makes training sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from framestore.llm.jaccard import jaccard_components
from framestore.llm.lines import dedup_lines
from framestore.llm.packing import pack
from framestore.llm.quality import keep_good
from framestore.llm.secrets import redact
from framestore.session import delete_path, shared_folder, stage, staged_paths


#: Working tables of the last stage, by application.
_LEFT: dict[str, list[str]] = {}


def _cleaned(stage_of: Callable) -> Callable:
    """A stage that first deletes the working tables of the one before it, whose result is written when the next one begins."""

    @wraps(stage_of)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        for path in _LEFT.pop(application, []):
            delete_path(spark, path)
        with staged_paths() as paths:
            out = stage_of(spark, docs, sf_dir)
        _LEFT[application] = paths
        return out

    return run_stage


def _measured(docs: DataFrame) -> DataFrame:
    """`n_chars` says how long the text is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_cleaned
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return keep_good(docs)


@_cleaned
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of equal or nearly equal lines one occurrence stays. Documents left without words go.

    Such a document had no line of its own: all of it is found in other documents.
    """
    # Under names of their own, so that no column of the documents meets those that the operator adds.
    named = docs.select(*[F.col(c).alias(f"c_{c}") for c in docs.columns])
    kept = dedup_lines(named, "c_doc_id", "c_text").select(*[F.col(f"c_{c}").alias(c) for c in docs.columns])
    return _measured(kept.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))


@_cleaned
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    numbered, _ = stage(docs.select(*[F.col(c).alias(f"c_{c}") for c in docs.columns], F.monotonically_increasing_id().alias("number")), "near")
    # Ids may be missing or repeated, the number of a row is not: order the rows by id to choose among them.
    groups = jaccard_components(numbered, "number", "c_text").select("number", F.col("component_id").alias("group"))
    order = F.struct(F.col("c_doc_id").isNull().alias("none"), "c_doc_id", "number")
    members = numbered.select("number", "c_doc_id").join(groups, "number")
    first = members.groupBy("group").agg(F.min(order).alias("first")).select(F.col("first.number").alias("number"))
    return numbered.join(first, "number", "left_semi").select(*[F.col(f"c_{c}").alias(c) for c in docs.columns])


@_cleaned
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes."""
    return _measured(redact(docs)).select(*docs.columns)


@_cleaned
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: where each piece of each document goes, with its ids as a checksum."""
    return pack(docs, with_ids=False)


STAGES = [
    ("quality", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: SimHash, tokenizers and packing are not to be had in SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`. Each result is written to the shared folder and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES:
        path = f"{shared_folder(spark)}/framestore/pipeline-{name}-{uuid.uuid4().hex}"
        stage_of(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    for path in _LEFT.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)
    return docs
