from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.operators.expand import expand_lines
from siltbed.registry.core import given, instant, query
from siltbed.registry.history import CHECKS, FIRST, KEYS, SECOND, VERSIONS, load, shown
from siltbed.registry.landing import land_lines
from siltbed.operators.history import latest_load
from siltbed.plans.prices import read_history
from siltbed.session import work_dir
from siltbed.sources.files import Run, Source
from siltbed.sources.tables import VersionedTable
from siltbed.streaming.history import history_stream
from siltbed.streaming.once import deliver_once, store_stream
from siltbed.streaming.raw_ingest import file_stream, ingest_stream

MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@query("stream_raw_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_raw_ingest(spark, sf_dir):
    """Event files of two folders, each ingested by a stream that starts twice; every file comes in once."""
    events = given(spark, sf_dir, "events")
    table = VersionedTable(spark, work_dir(spark, "raw-event-files"))
    odd = F.coalesce(F.col("event_id") % 2 == 1, F.lit(False))
    for number, half in enumerate((events.filter(odd), events.filter(~odd))):
        folder = land_lines(half, F.to_json(F.struct(*events.columns), MICROS), f"event-files-{number}")
        checkpoint = work_dir(spark, f"raw-event-checkpoint-{number}")
        for _ in range(2):
            ingest_stream(
                file_stream(spark, folder, "*.txt"),
                table,
                Source("jsonl", "web"),
                checkpoint,
                lambda: Run("run-0001", "2026-01-05T08:00:00Z"),
            ).awaitTermination()
    lines = expand_lines(table.read(), ["source_file_path"]).filter("line <> ''")
    return lines.select(F.from_json("line", events.schema, MICROS).alias("e")).select("e.*")


@query("stream_scd2", VERSIONS + "SELECT * FROM history")
def stream_scd2(spark, sf_dir):
    """History advanced by a stream of loads: one batch with the first, one with the second."""
    folder = work_dir(spark, "order-loads")
    checkpoint = work_dir(spark, "order-history-checkpoint")
    table = VersionedTable(spark, work_dir(spark, "order-history-stream"))
    for at in (FIRST, SECOND):
        batch = load(spark, sf_dir, at)
        batch.write.mode("append").parquet(folder)
        history_stream(
            spark.readStream.schema(batch.schema).parquet(folder),
            table,
            lambda df: latest_load(df, KEYS, "ingestion_timestamp", CHECKS),
            KEYS,
            CHECKS,
            lambda batch_id: instant((FIRST, SECOND)[batch_id]),
            checkpoint,
        ).awaitTermination()
    return shown(read_history(table))


@query("stream_once", "SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events")
def stream_once(spark, sf_dir):
    """Events that two overlapping folders deliver, a third of them twice; every event enters once."""
    events = given(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    third = F.coalesce(F.pmod("event_id", F.lit(3)), F.lit(2))
    folders = [work_dir(spark, f"deliveries-{number}") for number in (0, 1)]
    stored, checkpoint = work_dir(spark, "delivered"), work_dir(spark, "delivered-checkpoint")
    for number, folder in enumerate(folders):
        events.filter(third != number).write.parquet(folder)
    for _ in range(2):
        deliveries = [spark.readStream.schema(events.schema).parquet(folder) for folder in folders]
        once = deliver_once(deliveries, events.columns, "1 day")
        store_stream(once, stored, checkpoint).awaitTermination()
    return spark.read.schema(events.schema).parquet(stored)
