"""Incremental raw ingest: every new file becomes a raw row exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltbed.operators.checks import enforce_not_null
from siltbed.sources.files import (
    RAW_SCHEMA,
    Run,
    Source,
    ingest,
    split_rejects,
    with_ingestion_date,
)
from siltbed.sources.tables import VersionedTable

STREAM_LABEL, BATCH_LABEL = "stream-id", "batch-id"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint; another checkpoint has another id, even at the same path."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def batch_labels(spark: SparkSession, checkpoint: str, batch_id: int) -> dict[str, str]:
    """What tells a batch from all others of any stream: batch numbers alone start at 0 with every checkpoint."""
    return {STREAM_LABEL: stream_id(spark, checkpoint), BATCH_LABEL: str(batch_id)}


def already_applied(table: VersionedTable, labels: dict[str, str]) -> bool:
    """Whether a version of the table carries the batch, as after a restart between
    its commit and the stream's checkpoint."""
    if not table.exists():
        return False
    same = F.lit(True)
    for name, value in labels.items():
        same = same & (F.col("summary")[name] == value)
    return not table.log().filter(same).isEmpty()


def file_stream(spark: SparkSession, folder: str, glob: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", "length", "content")
    )


def ingest_stream(
    files: DataFrame,
    table: VersionedTable,
    source: Source,
    checkpoint: str,
    run: Callable[[], Run] = Run,
    rejects: VersionedTable | None = None,
) -> StreamingQuery:
    """Append all files that the checkpoint does not know yet, then stop.

    Rows are stored as the batch ingest stores them: by day, without NULL in a
    required column. Without ``rejects`` a file that cannot be stored fails the
    batch; with it, such files go there with their reason and the stream goes on.
    """
    required = [f.name for f in RAW_SCHEMA.fields if not f.nullable]

    def append(batch: DataFrame, batch_id: int) -> None:
        labels = batch_labels(batch.sparkSession, checkpoint, batch_id)
        now = run()
        if rejects is None:
            accepted = ingest(batch, source, now)
        else:
            accepted, rejected = split_rejects(batch, source, now)
            if not already_applied(rejects, labels):
                rejects.append(rejected.select(F.lit(now.ingestion_id).alias("ingestion_id"), "*"), **labels)
        if not already_applied(table, labels):
            rows = with_ingestion_date(enforce_not_null(accepted, required))
            table.append(rows, partition_by=["ingestion_date"], **labels)

    return (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
