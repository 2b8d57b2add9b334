"""Exact dedup by a heavy-hitter split.

Digests of the whole texts are found once and stored. Misra-Gries counters
(``freqItems``) name the digests that may be frequent, at most ``1 / support``
of them. Their exact counts and winners are aggregated and broadcast, so rows of
frequent texts are decided where they lie. All other digests are shuffled; no
group among them holds more than about ``support`` of all rows.

Defined results: NULL text counts as empty; equal texts form a group; the row
with the largest doc_id stays, NULL being the smallest; of rows repeated with
that doc_id exactly one stays; texts of any length are hashed whole, in the task
that reads them; an empty table gives an empty result. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import keep_rows, text_digest, written

#: Share of all rows from which a digest counts as frequent; the broadcast has at most 1 / SUPPORT rows.
SUPPORT = 0.001


def frequent_winners(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digest, row count and winning row of every digest that holds ``support`` of all rows; 1 / support rows at most."""
    candidates = digests.select(F.hex("digest").alias("d")).freqItems(["d"], support)
    named = candidates.select(F.explode("d_freqItems").alias("d")).select(F.unhex("d").alias("digest"))
    counted = (
        digests.join(F.broadcast(named), "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("winner"))
    )
    return counted.filter(F.col("group_size") >= support * digests.count()).select("digest", "group_size", "winner")


def exact_groups(docs: DataFrame, support: float = SUPPORT, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, group_size, winner's doc_id as keep_id, kept."""
    digests = written(
        docs.select(
            F.col(key).alias("doc_id"),
            text_digest(column).alias("digest"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "op1-digests",
    )
    heavy = written(frequent_winners(digests, support), "op1-frequent")
    marked = digests.join(F.broadcast(heavy), "digest", "left")
    same = Window.partitionBy("digest")
    rest = (
        marked.filter(F.col("winner").isNull())
        .withColumn("group_size", F.count(F.lit(1)).over(same))
        .withColumn("winner", F.max(F.struct("doc_id", "row_no")).over(same))
    )
    return marked.filter(F.col("winner").isNotNull()).unionByName(rest).select(
        "doc_id",
        "digest",
        "group_size",
        F.col("winner.doc_id").alias("keep_id"),
        (F.col("winner.row_no") == F.col("row_no")).alias("kept"),
    )


def drop_copies(docs: DataFrame, support: float = SUPPORT, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The documents with all their columns, one row per different text."""
    groups = exact_groups(docs, support, key, column)
    decided = written(
        groups.groupBy("doc_id", "digest").agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("twins")),
        "op1-decided",
    )
    return keep_rows(docs, decided.filter("stays"), key, column)


def digest_columns(groups: DataFrame) -> DataFrame:
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
