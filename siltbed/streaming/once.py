"""Records that several streams deliver, each stored once, with a state that does not grow for ever.

The state holds a digest per record for ``delay`` after the record came in.
A repeat that arrives within that time is dropped, whichever stream brings it;
one that arrives later is a new record. Time is that of arrival, so no record can
come too late and none is lost, whatever times it carries itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltbed.operators.merge import union_all

KEY, ARRIVAL = "_delivery_key", "_delivered_at"


def _text(name: str) -> Column:
    """A value with its length, so that neighbours cannot run into each other; NULL unlike any text."""
    text = F.to_json(F.struct(F.col(f"`{name}`").alias("v")))
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)


def delivery_key(columns: list[str], keys: list[str]) -> Column:
    """Digest of a record's keys; a record that lacks one of them is told apart by all its columns."""
    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(f"`{key}`").isNull()
    by_key = F.concat(F.lit("k"), *[_text(c) for c in keys])
    by_row = F.concat(F.lit("r"), *[_text(c) for c in columns])
    return F.unhex(F.substring(F.sha2(F.when(lacking, by_row).otherwise(by_key), 256), 1, 32))


def deliver_once(streams: list[DataFrame], keys: list[str], delay: str) -> DataFrame:
    """Streams with equal columns as one stream in which a record occurs once within ``delay``.

    They must be read by one query, since a state belongs to a query. Which of
    several records with equal keys stays is not defined.
    """
    united = union_all(streams)
    columns = united.columns
    marked = united.withColumns({KEY: delivery_key(columns, keys), ARRIVAL: F.current_timestamp()})
    return marked.withWatermark(ARRIVAL, delay).dropDuplicatesWithinWatermark([KEY]).drop(KEY, ARRIVAL)


def store_stream(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Add all that has arrived to a Parquet folder, then stop.

    The folder's own log names the files of finished batches; a batch that runs
    again after a crash adds nothing twice.
    """
    return (
        rows.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
