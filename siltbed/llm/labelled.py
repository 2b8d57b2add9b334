"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import crc_fold, whole_text

#: Longer texts are left out of the sample (never out of the scoring).
LONGEST = 100_000


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int
) -> list[tuple[bytes, int]]:
    """At most ``per_class`` whole texts of either label, from rows outside the held-out fold.

    Chosen by a hash of the id, so the same tables give the same sample. A
    document with contradicting label rows counts as 1; texts are at most
    ``LONGEST`` characters, so the driver gets a bounded amount.
    """
    rows = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
        .filter(crc_fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    chosen = reduce(DataFrame.unionByName, [rows.filter(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)])
    texts = docs.select("doc_id", whole_text().cast("binary").alias("text")).filter(F.length("text") <= LONGEST)
    found = texts.join(F.broadcast(chosen), "doc_id").orderBy(*order, "text").limit(2 * per_class)
    return [(bytes(r["text"]), r["y"]) for r in found.select("text", "y").collect()]
