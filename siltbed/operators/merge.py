"""Bringing several sources together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name, joined pairwise: every union analyses all it holds once more."""
    if not frames:
        raise ValueError("nothing to unite")
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_all(frames[:half]).unionByName(union_all(frames[half:]))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the keys appear once."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def union_labelled(sources: dict[str, DataFrame], label: str = "source_system") -> DataFrame:
    """UNION ALL of frames with equal columns, each marked with its source."""
    return union_all([df.withColumn(label, F.lit(name)) for name, df in sources.items()])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark keeps only the best row per key and task before the shuffle
    (WindowGroupLimit), so a hot key moves one row per task. The order should
    be total; rows that tie are otherwise picked at will.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], at: str, ties: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(at).desc_nulls_last(), *[F.col(c).asc() for c in ties]])


def merge_entities(
    sources: dict[str, DataFrame], key: str, label: str = "preferred_source"
) -> DataFrame:
    """One record per key; an earlier source in the dict beats a later one.

    Within one source the smallest record wins, column by column, so the
    result does not depend on row order. Repeated records tie on everything,
    which is why no DISTINCT (and no shuffle for it) is needed before.
    """
    merged = union_labelled(sources, label)
    priority = F.lit(len(sources))
    for rank, name in reversed(list(enumerate(sources))):
        priority = F.when(F.col(label) == name, rank).otherwise(priority)
    others = [c for c in next(iter(sources.values())).columns if c != key]
    return first_per_key(merged, [key], [priority, *[F.col(c).asc_nulls_last() for c in others]])


def compare_sources(
    df: DataFrame, keys: list[str], label: str, value: str, left: str, right: str
) -> DataFrame:
    """Keys that both sources report, with their values and differences.

    The percentage refers to the right source. One conditional aggregate, no
    self-join.
    """
    per_key = df.groupBy(*keys).agg(
        F.max(F.when(F.col(label) == left, F.col(value))).alias("left_value"),
        F.max(F.when(F.col(label) == right, F.col(value))).alias("right_value"),
    )
    difference = F.abs(F.col("left_value") - F.col("right_value"))
    return per_key.filter("left_value IS NOT NULL AND right_value IS NOT NULL").select(
        *keys,
        "left_value",
        "right_value",
        difference.alias("abs_difference"),
        F.when(F.col("right_value") != 0, 100 * difference / F.abs("right_value")).alias("pct_difference"),
    )
