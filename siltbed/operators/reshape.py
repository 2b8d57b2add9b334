"""Flattening, nesting and other changes of shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators.skew import HOT_ROWS, attach_group_values, bounded_blocks, repeat_rows


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Every leaf of every (nested) struct as a column named by its path."""

    def leaves(schema: T.StructType, path: list[str]) -> list[Column]:
        columns = []
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                columns += leaves(field.dataType, here)
            else:
                source = ".".join(f"`{part}`" for part in here)
                columns.append(F.col(source).alias(separator.join(here)))
        return columns

    return df.select(*leaves(df.schema, []))


def project_paths(df: DataFrame, paths: dict[str, str], casts: dict[str, str] | None = None) -> DataFrame:
    """Named flat columns from nested paths, some of them cast."""
    casts = casts or {}
    return df.select(
        *[
            (F.col(path).cast(casts[name]) if name in casts else F.col(path)).alias(name)
            for name, path in paths.items()
        ]
    )


def nest(df: DataFrame, layout: dict[str, Column | dict[str, Column]]) -> DataFrame:
    """Flat columns to nested structs: a dict value becomes a struct."""
    return df.select(
        *[
            (F.struct(*[c.alias(n) for n, c in value.items()]) if isinstance(value, dict) else value).alias(name)
            for name, value in layout.items()
        ]
    )


def wrap_records(
    df: DataFrame,
    keys: list[str],
    block: Column,
    order: list[str],
    envelope: dict[str, Column],
    max_records: int = 1_000,
) -> DataFrame:
    """JSON envelopes ``{labels…, record_count, records: […]}``, records in order.

    An envelope is one value, so it must stay small: ``block`` divides every
    key's records into envelopes of up to ``max_records``, for instance
    ``id DIV 1000`` for a unique integer id. Larger blocks are split further.
    """
    rest = [c for c in df.columns if c not in keys]
    record = F.struct(*order, *[c for c in rest if c not in order])
    grouped = (
        bounded_blocks(df, keys, block, max_records)
        .groupBy(*keys, "block_no", "part_no")
        .agg(F.array_sort(F.collect_list(record)).alias("_records"))
    )
    labels = [column.alias(name) for name, column in envelope.items()]
    return grouped.select(
        *keys,
        "block_no",
        "part_no",
        F.size("_records").cast("bigint").alias("record_count"),
        F.to_json(
            F.struct(*labels, F.size("_records").alias("record_count"), F.col("_records").alias("records"))
        ).alias("raw_payload"),
    )


def weights_to_100(
    df: DataFrame,
    keys: list[str],
    value: str,
    order: list[str],
    scale: int = 4,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Percentage of its group's total for every row, adding up to exactly 100.

    Shares are rounded; the last row in order takes what is left. Group totals
    are aggregated map-side and joined back with hot groups salted, instead of
    a window that would hold a whole group in one task.
    """
    share = f"decimal({scale + 6},{scale})"
    rows = df.select(*keys, *order, value)
    position = F.struct(*order, value)
    totals = rows.groupBy(*keys).agg(
        F.sum(F.col(value).cast("decimal(28,6)")).alias("_total"),
        F.max(position).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )
    weighted = (
        attach_group_values(rows, totals, keys, "_n", hot_rows)
        .withColumn(
            "weight_pct",
            F.round(100 * F.col(value) / F.col("_total").cast("double"), scale).cast(share),
        )
        .withColumn("_is_last", position == F.col("_last"))
    )
    lasts = weighted.groupBy(*keys).agg(
        F.sum("weight_pct").alias("_sum"),
        F.max("_last").alias("_last"),
        F.max(F.when(F.col("_is_last"), F.col("weight_pct"))).alias("weight_pct"),
        F.count_if("_is_last").alias("_copies"),
    )
    columns = [*keys, *order, value, "weight_pct"]
    inner = weighted.filter(~F.col("_is_last")).select(*columns)
    # One copy of the last row takes the rest, further exact copies keep their share.
    closing = repeat_rows(
        lasts.select(
            *keys,
            *[F.col("_last")[c].alias(c) for c in [*order, value]],
            "weight_pct",
            (100 - F.col("_sum") + F.col("weight_pct")).cast(share).alias("_rest"),
            "_copies",
        ),
        "_copies",
        "_copy",
    ).withColumn("weight_pct", F.when(F.col("_copy") == 1, F.col("_rest")).otherwise(F.col("weight_pct")))
    return inner.unionByName(closing.select(*columns))


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def trading_days(start: Column, end: Column) -> Column:
    """Array of the weekdays from start to end, both included; empty if there are none."""
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return F.filter(days, is_weekday)


def missing_weekdays(df: DataFrame, keys: list[str], day: str, start: Column, end: Column) -> DataFrame:
    """Weekdays from start to end on which a key has no row.

    Distinct (key, day) pairs come first, so a key never has more rows than
    the calendar has days; gaps are then read off neighbouring days instead of
    pairing all keys with the whole calendar.
    """
    seen = df.select(*keys, F.to_date(day).alias("_day")).filter(F.col("_day").between(start, end)).distinct()
    # A key seen only outside the range misses all of it.
    edges = df.select(*keys).distinct().withColumn("_day", F.date_sub(start, 1))
    by_key = Window.partitionBy(*keys).orderBy("_day")
    following = F.coalesce(F.lead("_day").over(by_key), F.date_add(end, 1))
    return (
        seen.unionByName(edges)
        .withColumn("_next", following)
        .select(
            *keys,
            F.explode(trading_days(F.date_add("_day", 1), F.date_sub("_next", 1))).alias("missing_day"),
        )
    )
