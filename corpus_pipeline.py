"""From raw documents to packed sequences: rules, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` stores every
stage as Parquet in the shared work folder and reads it again for the next one.
Packing also stores the sequences with their ids there, as ``pipeline-sequences``.

Defined results: a NULL text has no word, so the rules drop it like an empty one; of
repeated rows one stays; ties go by the largest doc_id among equal texts, by the
smallest among near copies, NULL being the smallest; texts of any length are one
document until packing cuts them; an empty table gives no piece; further columns,
whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import op1_exact_dedup, op2_mixing, op3_packing, op7_quality_rules, op9_near_dedup
from siltbed.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_quality_rules.apply_policy(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_near_dedup.drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = written(op3_packing.pack(docs), "pipeline-pieces")
    written(op3_packing.sequences(packed), "pipeline-sequences")
    return op3_packing.piece_columns(packed)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Packing needs a tokenizer, which SQL does not have; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
