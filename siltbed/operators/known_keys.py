"""Uniqueness of a growing table, tested for the new rows only.

Digests of all stored keys lie in a bucketed table. New keys are shuffled to its
buckets and joined there; the stored side is read as it lies, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Enough that a bucket of a large table is one task's work; a table keeps the number it began with.
BUCKETS = 64


def key_digest(columns: list[str]) -> Column:
    """128 bits of a key; NULL in a combination is a value like others."""
    parts = []
    for name in columns:
        text = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _keyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    # NULL in a single column is no value.
    valued = rows.filter(F.col(f"`{columns[0]}`").isNotNull()) if len(columns) == 1 else rows
    return valued.groupBy(key_digest(columns).alias("digest")).agg(F.count(F.lit(1)).alias("rows"))


def known_keys(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def remember_keys(rows: DataFrame, columns: list[str], name: str, path: str, buckets: int = BUCKETS) -> None:
    """Add the different keys of new rows to the bucketed table ``name``, which lies under ``path``."""
    keys = _keyed(rows, columns).select("digest")
    # One file per bucket and load: the rows of a bucket are brought together before they are written.
    dealt = keys.repartition(buckets, "digest")
    dealt.write.mode("append").bucketBy(buckets, "digest").sortBy("digest").option("path", path).saveAsTable(name)


def repeated_keys(rows: DataFrame, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """Digest, rows and ``is_known`` of the new rows' keys that occur twice among them or were stored before."""
    new = _keyed(rows, columns)
    if known is None:
        return new.filter("rows > 1").withColumn("is_known", F.lit(False))
    stored = known.select(F.col("digest").alias("stored"))
    # A key was stored once per load that brought it; one match is enough.
    met = new.join(stored, new["digest"] == stored["stored"], "left_semi").withColumn("is_known", F.lit(True))
    alone = new.filter("rows > 1").join(stored, new["digest"] == stored["stored"], "left_anti")
    return met.unionByName(alone.withColumn("is_known", F.lit(False)))


def uniqueness_of_load(rows: DataFrame, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """One row: rows of the load with a key, and how many of its keys break uniqueness."""
    failing = repeated_keys(rows, columns, known).agg(F.count(F.lit(1)).alias("failures"))
    evaluated = _keyed(rows, columns).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("evaluated"))
    counts = evaluated.withColumn("failures", F.lit(0).cast("long")).unionByName(
        failing.select(F.lit(0).cast("long").alias("evaluated"), "failures")
    )
    return counts.agg(F.sum("evaluated").alias("evaluated"), F.sum("failures").alias("failures"))
