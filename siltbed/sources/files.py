"""File-level raw layer: one source file is one row, with hash and provenance."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.digests import sha256_label
from siltbed.functions.json_fields import is_json, starts_like_object

PROVENANCE = [
    "ingestion_id",
    "ingestion_timestamp",
    "source_system",
    "source_version",
    "source_file_path",
    "source_file_hash",
]

# Names and types of the raw layer's columns.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("ingestion_id", T.StringType(), False),
        T.StructField("ingestion_timestamp", T.TimestampType(), False),
        T.StructField("source_system", T.StringType(), False),
        T.StructField("source_version", T.StringType(), True),
        T.StructField("source_file_path", T.StringType(), False),
        T.StructField("source_file_hash", T.StringType(), False),
        T.StructField("source_file_size_bytes", T.LongType(), False),
        T.StructField("source_file_format", T.StringType(), False),
        T.StructField("raw_payload", T.StringType(), False),
    ]
)


@dataclass(frozen=True)
class Run:
    """One ingestion run. Give both values to make a run repeatable."""

    ingestion_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    timestamp: str = field(
        default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    )

    def columns(self) -> list[Column]:
        return [
            F.lit(self.ingestion_id).alias("ingestion_id"),
            F.to_timestamp(F.lit(self.timestamp)).alias("ingestion_timestamp"),
        ]


@dataclass(frozen=True)
class Source:
    """How the files of one source system are labelled and checked.

    ``system_field`` / ``version_field`` name JSON envelope fields that carry
    the labels; where they are absent or empty ``system`` / ``version`` apply.
    """

    file_format: str
    system: str
    version: str | None = "v1"
    system_field: str | None = None
    version_field: str | None = None
    object_required: bool = False


def read_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """All files under a path as (path, length, content), read on the executors.

    Spark's file scans skip files of zero bytes; these are found by comparing
    the listing with the scan. A path or glob without any file raises.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    scan = reader.load(path)
    listed = scan.inputFiles()
    if not listed:
        raise FileNotFoundError(f"no file at {path}" + (f" matches {glob}" if glob else ""))
    names = spark.createDataFrame([(name,) for name in listed], "name string")
    read = scan.select(one_slash(F.col("_metadata.file_path")).alias("name"))
    empty = names.select(one_slash(F.col("name")).alias("name")).join(read, "name", "left_anti")
    return scan.select("path", "length", "content").unionByName(
        empty.select(
            decoded_path(F.col("name")).alias("path"), F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content")
        )
    )


def decoded_path(name: Column) -> Column:
    """Path of a file from its URI; a plus sign is no blank in a path."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def one_slash(name: Column) -> Column:
    """``file:///x`` and ``file:/x`` are one file."""
    return F.regexp_replace(name, "^([A-Za-z0-9+.-]+:)/+", "$1/")


def reject_reason(content: Column, source: Source) -> Column:
    """NULL for a file that can be stored, otherwise why it cannot."""
    text = content.cast("string")
    reason = F.when(~F.is_valid_utf8(text), "not_utf8")
    if source.file_format == "json":
        reason = reason.when(~is_json(text), "malformed_json")
        if source.object_required:
            # What gets here is JSON.
            reason = reason.when(~starts_like_object(text), "not_an_object")
    return reason


def _envelope_label(envelope: Column, name: str | None, fallback: str | None, empty_is_absent: bool) -> Column:
    if name is None:
        return F.lit(fallback).cast("string")
    value = envelope[name]
    if empty_is_absent:
        value = F.nullif(value, F.lit(""))
    return value if fallback is None else F.coalesce(value, F.lit(fallback))


def label_payloads(rows: DataFrame, source: Source, run: Run) -> DataFrame:
    """Raw rows from columns (path, length, content)."""
    text = F.col("content").cast("string")
    wanted = [name for name in (source.system_field, source.version_field) if name]
    if wanted:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in dict.fromkeys(wanted)])
        rows = rows.withColumn("_envelope", F.from_json(text, schema))
    envelope = F.col("_envelope")
    return rows.select(
        *run.columns(),
        _envelope_label(envelope, source.system_field, source.system, True).alias("source_system"),
        _envelope_label(envelope, source.version_field, source.version, False).alias("source_version"),
        F.col("path").alias("source_file_path"),
        sha256_label(F.col("content")).alias("source_file_hash"),
        F.col("length").cast("bigint").alias("source_file_size_bytes"),
        F.lit(source.file_format).alias("source_file_format"),
        text.alias("raw_payload"),
    )


def ingest(files: DataFrame, source: Source, run: Run) -> DataFrame:
    """Strict ingest: the first file that cannot be stored fails the job."""
    reason = reject_reason(F.col("content"), source)
    checked = F.when(reason.isNull(), F.col("content")).otherwise(
        F.raise_error(F.concat(reason, F.lit(": "), F.col("path"))).cast("binary")
    )
    return label_payloads(files.withColumn("content", checked), source, run)


def split_rejects(files: DataFrame, source: Source, run: Run) -> tuple[DataFrame, DataFrame]:
    """Lenient ingest: (raw rows, rejected files with their reason)."""
    judged = files.withColumn("reject_reason", reject_reason(F.col("content"), source))
    accepted = label_payloads(judged.filter(F.col("reject_reason").isNull()), source, run)
    rejected = judged.filter(F.col("reject_reason").isNotNull()).select("path", "length", "reject_reason")
    return accepted, rejected


def skip_known(raw: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop files already stored, so that ingesting a folder again adds nothing.

    For folders that grow for long, ``streaming.raw_ingest`` is cheaper: its
    checkpoint knows the finished files without reading them again.
    """
    identity = ["source_file_path", "source_file_hash"]
    # Known files are those that come in again, so their distinct identities are
    # the smaller side of the join, whatever the table holds.
    known = existing.select(*identity).join(raw.select(*identity), identity, "left_semi").distinct()
    return raw.join(known, identity, "left_anti")


def first_of_each_content(rows: DataFrame, content: str, order: str) -> DataFrame:
    """One row per distinct content: its hash, first id and number of copies.

    Copies meet in the map-side aggregate, so a content that fills a third of
    the input sends one row per task through the shuffle.
    """
    return rows.groupBy(sha256_label(F.col(content)).alias("source_file_hash")).agg(
        F.min(order).alias(order), F.count(F.lit(1)).alias("copies")
    )


def with_ingestion_date(raw: DataFrame) -> DataFrame:
    """Adds the day partition column of the raw layer."""
    return raw.withColumn("ingestion_date", F.to_date("ingestion_timestamp"))


def ingested_between(raw: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of an inclusive day range, filtered on the partition column as well."""
    return raw.filter(
        F.col("ingestion_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )
