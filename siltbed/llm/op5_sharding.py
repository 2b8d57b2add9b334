"""Placing rows in shards through a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime
size (a start and a step, both from a hash of its name). Shards take turns; each
claims the first slot of its order that is still free, a shard of weight ``k``
claims ``k`` slots a turn. The full table has ``slots`` rows, a parameter, and is
broadcast: placing a row is one hash and one lookup. When a shard goes, only few
rows of the others move.

Defined results: a NULL key has a place like any other; repeated keys share a
shard; an empty table stays empty; columns of the input pass through, and a
result column whose name is taken gets underscores.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import free_name, quoted

#: A prime, over 500 slots for each of the default shards, so that shares differ by less than 1 %.
SLOTS = 65_537
SHARDS = [f"shard-{n:03d}" for n in range(128)]


def _number(name: str, purpose: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{purpose}:{name}".encode()).digest()[:8], "big")


def filled_table(shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """For each slot, the index of the shard that claimed it."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need different names, one at least")
    if slots < len(shards) or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, no less than the number of shards")
    start = [_number(name, "start") % slots for name in shards]
    step = [_number(name, "step") % (slots - 1) + 1 for name in shards]
    turns = [max(1, (weights or {}).get(name, 1)) for name in shards]
    owner = [-1] * slots
    tried = [0] * len(shards)
    free = slots
    while free:
        for shard in range(len(shards)):
            for _ in range(min(turns[shard], free)):
                slot = (start[shard] + tried[shard] * step[shard]) % slots
                while owner[slot] >= 0:
                    tried[shard] += 1
                    slot = (start[shard] + tried[shard] * step[shard]) % slots
                owner[slot] = shard
                tried[shard] += 1
                free -= 1
    return owner


def lookup(spark: SparkSession, shards: list[str], slots: int, weights: dict[str, int] | None = None) -> DataFrame:
    rows = [(slot, shard, shards[shard]) for slot, shard in enumerate(filled_table(shards, slots, weights))]
    return spark.createDataFrame(rows, "slot int, shard int, shard_name string")


def place(
    df: DataFrame,
    key: str = "doc_id",
    shards: list[str] = SHARDS,
    slots: int = SLOTS,
    weights: dict[str, int] | None = None,
) -> DataFrame:
    """The rows with slot, shard (index) and shard_name."""
    slot, shard, name = (free_name(df.columns, c) for c in ("slot", "shard", "shard_name"))
    table = lookup(df.sparkSession, shards, slots, weights).toDF(slot, shard, name)
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))
    slotted = df.withColumn(slot, F.pmod(F.xxhash64(text), F.lit(slots)).cast("int"))
    return slotted.join(F.broadcast(table), slot).select(*quoted(df.columns), slot, shard, name)


def write_shards(placed: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; a large shard is written by several tasks."""
    placed.hint("rebalance", shard).write.partitionBy(shard).parquet(path)
