"""Change history from a stream of loads, one run per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from siltbed.plans.prices import record_history
from siltbed.sources.tables import VersionedTable
from siltbed.streaming.raw_ingest import already_applied, batch_labels


def history_stream(
    loads: DataFrame,
    table: VersionedTable,
    newest: Callable[[DataFrame], DataFrame],
    keys: list[str],
    checks: list[str],
    run_at: Callable[[int], Column],
    checkpoint: str,
    slice_by: Column | None = None,
    loaded_at: str | None = None,
) -> StreamingQuery:
    """Advance a stored history by every batch of a stream, then stop.

    ``newest`` leaves one record per key of a batch, ``run_at`` gives the time
    of a batch by its id. A batch that runs again after a crash is skipped.
    ``slice_by`` and ``loaded_at`` are those of ``record_history``.
    """

    def advance(batch: DataFrame, batch_id: int) -> None:
        labels = batch_labels(batch.sparkSession, checkpoint, batch_id)
        if not already_applied(table, labels):
            record_history(
                table,
                newest(batch),
                run_at(batch_id),
                keys,
                checks,
                slice_by,
                slices_from=batch,
                loaded_at=loaded_at,
                **labels,
            )

    return (
        loads.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
