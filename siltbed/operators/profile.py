"""Counts, completeness and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.merge import union_all


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows; Parquet answers from its footers."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def completeness(df: DataFrame, columns: list[str], distinct: str | None = None) -> DataFrame:
    """Rows, NULLs per column and optionally the distinct values of one column."""
    measures = [F.count(F.lit(1)).alias("row_count")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    if distinct:
        measures.append(F.count_distinct(distinct).alias(f"{distinct}_distinct"))
    return df.agg(*measures)


def numeric_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.count_distinct(column).alias("distinct_values"),
    )


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per group, most frequent first; NULL is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)


def group_averages(df: DataFrame, keys: list[str], values: list[str], scale: int = 2) -> DataFrame:
    """Rows and rounded averages per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.avg(v), scale).alias(f"avg_{v}") for v in values]
    )


def column_profile(name: str, df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: type, rows, NULLs, distinct values, min and max as text.

    Min, max and NULLs come from one aggregate. Exact distinct counts group
    (column, value) pairs, so repeated values meet before the shuffle;
    ``approximate`` puts a sketch into the first aggregate instead and saves
    the shuffle.
    """
    columns = df.columns
    measures = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        measures += [
            F.count(F.col(c)).alias(f"_c{i}"),
            F.min(c).cast("string").alias(f"_min{i}"),
            F.max(c).cast("string").alias(f"_max{i}"),
        ]
        if approximate:
            measures.append(F.approx_count_distinct(c).alias(f"_d{i}"))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col("_n").alias("row_count"),
            (F.col("_n") - F.col(f"_c{i}")).alias("null_count"),
            (F.col(f"_d{i}") if approximate else F.lit(0)).cast("bigint").alias("distinct_count"),
            F.col(f"_min{i}").alias("min_value"),
            F.col(f"_max{i}").alias("max_value"),
        )
        for i, c in enumerate(columns)
    ]
    profile = df.agg(*measures).select(F.inline(F.array(*rows)))
    if not approximate:
        pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
        distinct = (
            df.select(F.inline(F.array(*pairs)))
            .filter(F.col("value").isNotNull())
            .distinct()
            .groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("_d"))
        )
        profile = (
            profile.join(distinct, "column_name", "left")
            .withColumn("distinct_count", F.coalesce("_d", F.lit(0)).cast("bigint"))
            .drop("_d")
        )
    return profile.select(F.lit(name).alias("table_name"), "*")


def preview(df: DataFrame, label: str, payload: str, chars: int = 120) -> DataFrame:
    """Size and first characters of every payload, for a look at a table."""
    return df.select(
        F.lit(label).alias("table_name"),
        F.char_length(payload).cast("bigint").alias("payload_chars"),
        F.substring(payload, 1, chars).alias("payload_start"),
    )


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows in order; every task keeps only its own n."""
    return df.orderBy(*order).limit(n)
