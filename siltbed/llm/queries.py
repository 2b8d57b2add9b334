"""The operators as named queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm import (
    op1_exact_dedup,
    op2_mixing,
    op3_packing,
    op4_pii,
    op5_sharding,
    op6_toxicity,
    op7_quality_rules,
    op8_lm_scoring,
    op9_near_dedup,
    op10_quality_classifier,
    op11_bpe,
    op12_merkle,
    op13_prefix_trie,
)
from siltbed.llm.common import table, written
from siltbed.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


@query("op1_exact_dedup", op1_exact_dedup.SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_exact_dedup.digest_columns(op1_exact_dedup.exact_groups(table(spark, sf_dir, "documents")))


@query("op2_mixing", op2_mixing.SQL)
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_mixing.mix_columns(op2_mixing.mix(table(spark, sf_dir, "documents")))


@query("op3_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_packing.piece_columns(op3_packing.pack(table(spark, sf_dir, "documents")))


@query("op4_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_pii.search(table(spark, sf_dir, "documents"))


@query("op5_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents go to their shards whole; places are read back from there."""
    placed = op5_sharding.place(table(spark, sf_dir, "documents"))
    path = work_dir(spark, "op5-shards")
    op5_sharding.write_shards(placed, path)
    return spark.read.schema(placed.schema).parquet(path).select("doc_id", "slot", "shard", "shard_name")


@query("op6_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_quality_rules", op7_quality_rules.SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is stored without texts; the policy is applied to what was stored."""
    measured = op7_quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return op7_quality_rules.rule_columns(written(measured, "op7-ledger"))


@query("op8_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_lm_scoring.scores(table(spark, sf_dir, "documents"))


@query("op9_near_dedup")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_near_dedup.group_columns(op9_near_dedup.near_groups(table(spark, sf_dir, "documents")))


@query("op10_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_bpe.digest_columns(op11_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op12_merkle", op12_merkle.SQL)
def merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op12_merkle.manifest_columns(op12_merkle.manifest(docs, op12_merkle.without_line_breaks(docs)))


@query("op13_prefix_trie", op13_prefix_trie.SQL)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_prefix_trie.node_columns(op13_prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")))
