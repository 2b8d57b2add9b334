"""Cutting large payloads into parts that several tasks can expand.

A payload is cut into chunks of bytes. What a chunk does to the reader's state is
found for every state it may begin in, without knowing which; these tables are
composed along the payload, so every chunk learns its state. Then each chunk gives
the records that begin in it, the last one completed by the heads of the chunks
that follow. Parts are payloads of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions import json_text
from siltbed.functions.csv_text import STATES, csv_head, csv_records, csv_state_after
from siltbed.session import work_dir

#: Payloads above this are cut, into chunks of this size.
PART_BYTES = 8 << 20


def _chunks(payload: Column, size: int) -> Column:
    """Chunks of a text of about ``size`` bytes, cut between letters."""
    raw = payload.cast("binary")

    def border(n: Column) -> Column:
        at = n * size
        # Bytes 80 to BF go on with a letter of several bytes.
        rest = F.regexp_extract(F.hex(F.substring(raw, at + 1, F.lit(3))), r"\A(?:[89AB][0-9A-F])*", 0)
        return at + (F.length(rest) / 2).cast("int")

    count = F.ceil(F.octet_length(payload) / size).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
        lambda n: F.substring(raw, border(n) + 1, border(n + 1) - border(n)).cast("string"),
    )


def chunked(raw: DataFrame, carry: list[str], payload: str, size: int) -> DataFrame:
    """One row per chunk: carried columns, ``_payload`` (a number per payload), ``_chunk``, ``_text``.

    Chunks are stored in the shared work folder once, dealt over many files: the
    numbers stay what they are, and no later step reads the payloads again.
    """
    numbered = raw.select(*carry, F.monotonically_increasing_id().alias("_payload"), F.col(payload).alias("_whole"))
    each = numbered.select(*carry, "_payload", F.posexplode(_chunks(F.col("_whole"), size)).alias("_chunk", "_text"))
    folder = work_dir(raw.sparkSession, "payload-chunks")
    each.repartition("_payload", "_chunk").write.parquet(folder)
    return raw.sparkSession.read.schema(each.schema).parquet(folder)


def csv_parts(raw: DataFrame, carry: list[str], payload: str = "raw_payload", size: int = PART_BYTES) -> DataFrame:
    """Payloads as parts of whole records: carried columns, the part as ``payload``, ``first_record`` (records before it).

    The tables of all chunks of a payload meet in one row; a payload has at most
    2 GB, so these are few hundred short entries.
    """
    chunks = chunked(raw, carry, payload, size)
    table = F.struct(*[csv_state_after(F.col("_text"), s).alias(s) for s in STATES])
    tables = chunks.select("_payload", "_chunk", table.alias("_table"))
    states = (
        tables.groupBy("_payload")
        .agg(F.array_sort(F.collect_list(F.struct("_chunk", "_table"))).alias("_tables"))
        .select("_payload", F.posexplode(_states_before(F.col("_tables"))).alias("_chunk", "_state"))
    )
    known = chunks.join(states, ["_payload", "_chunk"])
    head = csv_head(F.col("_text"), F.col("_state"))
    cut = known.withColumn("_head_length", head).select(
        *carry,
        "_payload",
        "_chunk",
        F.substring("_text", F.lit(1), F.col("_head_length")).alias("_head"),
        F.substring(F.col("_text"), F.col("_head_length") + 1, F.length("_text")).alias("_body"),
        # A record begins here, unless the chunk only goes on with an open one; a break at its end opens none.
        (F.col("_head_length") < F.length("_text")).alias("_begins"),
    )
    # The last record of a chunk counts where it begins. Only these numbers go along a payload in one task, no text does.
    along = Window.partitionBy("_payload").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        cut.filter("_begins")
        .select("_payload", "_chunk", F.size(csv_records(F.col("_body"))).cast("long").alias("_records"))
        .select("_payload", "_chunk", F.coalesce(F.sum("_records").over(along), F.lit(0)).alias("first_record"))
    )
    parts = _completed(cut, carry, payload).join(before, ["_payload", "_chunk"])
    return parts.select(*carry, payload, "first_record")


def _completed(cut: DataFrame, carry: list[str], payload: str) -> DataFrame:
    """What begins in each chunk, with the heads of the chunks up to the next one in which something begins."""
    along = Window.partitionBy("_payload").orderBy("_chunk")
    owner = F.max(F.when(F.col("_begins"), F.col("_chunk"))).over(along.rowsBetween(Window.unboundedPreceding, -1))
    heads = (
        cut.select("_payload", "_chunk", "_begins", "_head")
        .withColumn("_owner", owner)
        .filter(F.length("_head") > 0)
        .groupBy("_payload", F.col("_owner").alias("_chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("_chunk", "_head"))).alias("_heads"))
        .select("_payload", "_chunk", F.array_join("_heads._head", "").alias("_completion"))
    )
    whole = cut.filter("_begins").join(heads, ["_payload", "_chunk"], "left")
    return whole.select(
        *carry, "_payload", "_chunk", F.concat("_body", F.coalesce("_completion", F.lit(""))).alias(payload)
    )


def _states_before(tables: Column) -> Column:
    """The state before each chunk: all tables before it, one applied after the other."""

    def after(done: Column, entry: Column) -> Column:
        last = F.element_at(done, -1)
        step = F.coalesce(*[F.when(last == s, entry["_table"][s]) for s in STATES])
        return F.concat(done, F.array(step))

    states = F.aggregate(tables, F.array(F.lit("record")), after)
    return F.slice(states, F.lit(1), F.size(tables))


def json_array_parts(
    raw: DataFrame, records: str, carry: list[str], payload: str = "raw_payload", size: int = PART_BYTES
) -> DataFrame:
    """Payloads as parts with some elements of a top-level array each: carried columns, ``{"records": [...]}`` as ``payload``.

    What stands before the array must be keys with scalars or containers nested at
    most twice; any other payload stays one part.
    """
    start = json_text.array_start(F.col(payload), records)
    marked = raw.select(*carry, F.col(payload), start.alias("_start"))
    alone = marked.filter(F.coalesce(F.col("_start") == 0, F.lit(True))).select(*carry, payload)
    rest = F.substring(F.col(payload), F.col("_start") + 1, F.length(payload))
    split = marked.filter("_start > 0").select(*carry, rest.alias(payload))
    chunks = chunked(split, carry, payload, size)
    table = F.struct(*[json_text.scan(F.col("_text"), s).alias(s) for s in json_text.STATES])
    known = chunks.join(
        chunks.select("_payload", "_chunk", table.alias("_table"))
        .groupBy("_payload")
        .agg(F.array_sort(F.collect_list(F.struct("_chunk", "_table"))).alias("_tables"))
        .select("_payload", F.posexplode(_scans_before(F.col("_tables"))).alias("_chunk", "_before")),
        ["_payload", "_chunk"],
    )
    found = known.select(
        "_payload", "_chunk", json_text.borders(F.col("_text"), F.col("_before.state"), F.col("_before.deeper")).alias("_b")
    )
    # Only these numbers go along a payload in one task, no text does.
    along = Window.partitionBy("_payload").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = found.withColumn("_ended", F.count("_b.end").over(along)).filter("_ended = 0")
    # The first chunk begins with an element; others have their first one after a comma.
    here = chunks.join(inside, ["_payload", "_chunk"]).withColumns(
        {
            "_stop": F.coalesce("_b.end", F.length("_text")),
            "_comma": F.when(F.col("_chunk") == 0, F.lit(-1)).otherwise(F.col("_b.comma")),
        }
    )
    cut = here.select(
        *carry,
        "_payload",
        "_chunk",
        F.when(F.col("_chunk") == 0, F.lit("")).otherwise(
            F.substring("_text", F.lit(1), F.coalesce("_comma", "_stop"))
        ).alias("_head"),
        F.substring(F.col("_text"), F.col("_comma") + 2, F.col("_stop") - F.col("_comma") - 1).alias("_body"),
        F.col("_comma").isNotNull().alias("_begins"),
    )
    parts = _completed(cut, carry, payload)
    wrapped = F.concat(F.lit('{"' + records + '":['), F.col(payload), F.lit("]}"))
    return parts.select(*carry, wrapped.alias(payload)).unionByName(alone)


def _scans_before(tables: Column) -> Column:
    """String state and depth before each chunk, from the scans of all chunks before it."""

    def after(done: Column, entry: Column) -> Column:
        last = F.element_at(done, -1)
        step = F.coalesce(*[F.when(last["state"] == s, entry["_table"][s]) for s in json_text.STATES])
        return F.concat(done, F.array(F.struct(step["state"].alias("state"), (last["deeper"] + step["deeper"]).alias("deeper"))))

    begin = F.array(F.struct(F.lit("outside").alias("state"), F.lit(0).cast("long").alias("deeper")))
    return F.slice(F.aggregate(tables, begin, after), F.lit(1), F.size(tables))
