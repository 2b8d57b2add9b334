"""Keeping hot groups out of single tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.operators.merge import join_on

HOT_ROWS = 5_000_000
SUBRANGES = 64


def attach_group_values(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    count: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join per-group values (one row per key, with the group's row count) to rows.

    A plain join would send all rows of a group to one task. Here the groups
    with more than ``hot_rows`` rows get several salts, and their one value row
    is repeated per salt. The list of hot groups is broadcast; there cannot be
    more of them than rows / ``hot_rows``, a few megabytes at 1e12 rows.
    """
    salts = groups.filter(F.col(count) > hot_rows).select(
        *keys, F.ceil(F.col(count) / hot_rows).cast("int").alias("_salts")
    )
    # The partition id spreads exact copies of a row too, and is the same when
    # a lost task runs again.
    salt = F.pmod(
        F.xxhash64(F.spark_partition_id(), *rows.columns), F.coalesce("_salts", F.lit(1))
    ).cast("int")
    salted_rows = join_on(rows, F.broadcast(salts), keys, "left").withColumn("_salt", salt).drop("_salts")
    salted_groups = (
        join_on(groups, F.broadcast(salts), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return join_on(salted_rows, salted_groups, [*keys, "_salt"]).drop("_salt")


def repeat_rows(df: DataFrame, times: str, number: str, block: int = 10_000) -> DataFrame:
    """Each row as often as its ``times`` column says, numbered from 1.

    Two steps of bounded size, so that no array grows with the count.
    """
    # sequence() would count downwards from 0 to -1.
    blocks = df.filter(F.col(times) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({times} - 1) DIV {block}")))
    )
    first = F.col("_block") * block + 1
    return blocks.withColumn(
        number, F.explode(F.sequence(first, F.least(first + block - 1, F.col(times))))
    ).drop("_block", times)


def bounded_blocks(df: DataFrame, keys: list[str], block: Column, max_rows: int) -> DataFrame:
    """Rows with ``block_no`` and ``part_no``, such that a group of keys, block and part stays small.

    Rows are numbered inside their block and the number is divided by
    ``max_rows``, so parts are full but for the last. Exact copies are counted
    first, map-side; a block is numbered in 64 ranges by hash, whose sums are
    added up beforehand, and copies are spread at the end. So neither a block
    nor a row that is repeated a billion times meets in one task.
    """
    group = [*keys, "block_no"]
    blocked = df.withColumn("block_no", block)
    copies = (
        blocked.groupBy(*blocked.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_sub", F.pmod(F.xxhash64(*df.columns), F.lit(SUBRANGES)))
    )
    above = Window.partitionBy(*group).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        copies.groupBy(*group, "_sub")
        .agg(F.sum("_copies").alias("_n"))
        .select(*group, "_sub", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*group, "_sub").orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)
    numbered = join_on(copies, starts, [*group, "_sub"]).withColumn(
        "_first", F.col("_start") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    )
    part = F.floor((F.col("_first") + F.col("_copy") - 1) / max_rows).cast("int")
    return (
        repeat_rows(numbered, "_copies", "_copy")
        .withColumn("part_no", part)
        .select(*df.columns, "block_no", "part_no")
    )
