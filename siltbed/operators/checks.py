"""Data tests of a table: what must hold, and how many rows or groups break it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.merge import union_all


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    """No value, or combination of values, occurs twice among the rows of ``where``.

    NULL in a single column is no value; in a combination it is one like others.
    """

    columns: tuple[str, ...]
    where: str | None = None


@dataclass(frozen=True)
class Relationship:
    """Every non-NULL value has a row in the parent frame."""

    column: str
    parent: str
    parent_column: str


Check = NotNull | AcceptedValues | Unique | Relationship


def _outcome(number: int, check: str, column: str, evaluated: Column, failures: Column) -> Column:
    return F.struct(
        F.lit(number).alias("number"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        evaluated.cast("bigint").alias("evaluated"),
        failures.cast("bigint").alias("failures"),
    )


def _row_checks(df: DataFrame, checks: list[tuple[int, Check]]) -> list[DataFrame]:
    """All row-level checks of a table as one aggregate over one scan."""
    measures, outcomes = [], []
    for n, check in checks:
        column = F.col(check.column)
        if isinstance(check, NotNull):
            measures += [F.count(F.lit(1)).alias(f"e{n}"), F.count_if(column.isNull()).alias(f"f{n}")]
            outcomes.append(_outcome(n, "not_null", check.column, F.col(f"e{n}"), F.col(f"f{n}")))
        else:
            # Rows evaluated; the failures of these checks come in frames of their own.
            name = "accepted_values" if isinstance(check, AcceptedValues) else "relationships"
            measures.append(F.count(column).alias(f"e{n}"))
            outcomes.append(_outcome(n, name, check.column, F.col(f"e{n}"), F.lit(0)))
    if not measures:
        return []
    return [df.agg(*measures).select(F.inline(F.array(*outcomes)))]


def _unexpected_values(df: DataFrame, checks: list[tuple[int, AcceptedValues]]) -> list[DataFrame]:
    """Distinct unexpected values per check; only offending rows leave the scan's tasks."""
    if not checks:
        return []
    offences = [
        F.when(
            ~F.col(c.column).isin(list(c.values)),
            F.struct(
                F.lit(n).alias("number"), F.lit(c.column).alias("column"), F.col(c.column).cast("string").alias("value")
            ),
        )
        for n, c in checks
    ]
    values = df.select(F.inline(F.array_compact(F.array(*offences)))).distinct()
    return [
        values.groupBy("number", "column")
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(
            "number",
            F.lit("accepted_values").alias("check"),
            "column",
            F.lit(0).cast("bigint").alias("evaluated"),
            "failures",
        )
    ]


def _key_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    keyed = df.select(*columns)
    if len(columns) == 1:
        keyed = keyed.filter(F.col(columns[0]).isNotNull())
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))


def duplicate_groups(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return _key_counts(df, columns).filter("_rows > 1")


def _uniqueness(df: DataFrame, number: int, check: Unique) -> DataFrame:
    rows = df.filter(check.where) if check.where else df
    columns = list(check.columns)
    name = "unique" if len(columns) == 1 else "unique_combination"
    sums = _key_counts(rows, columns).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("e"), F.count_if(F.col("_rows") > 1).alias("f")
    )
    return sums.select(F.inline(F.array(_outcome(number, name, ", ".join(columns), F.col("e"), F.col("f")))))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent and their number of rows; counted before the join."""
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return values.join(keys, F.col(column) == F.col("_parent"), "left_anti")


def _lost(df: DataFrame, number: int, check: Relationship, parents: dict[str, DataFrame]) -> DataFrame:
    lost = orphans(df, check.column, parents[check.parent], check.parent_column)
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("f")).select(
        F.inline(F.array(_outcome(number, "relationships", check.column, F.lit(0), F.col("f"))))
    )


REPORT = "check string, column string, evaluated long, failures long, success boolean"


def run_checks(df: DataFrame, checks: list[Check], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per declared check: evaluated rows, failures, success; no row without checks.

    Failures are rows for not_null and relationships, distinct unexpected
    values for accepted_values, and repeated keys for uniqueness. Checks that
    share kind and column, such as two parents of one column, are told apart by
    their place in the list and have a row each.
    """
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT)
    numbered = list(enumerate(checks))
    frames = _row_checks(df, [(n, c) for n, c in numbered if not isinstance(c, Unique)])
    frames += _unexpected_values(df, [(n, c) for n, c in numbered if isinstance(c, AcceptedValues)])
    frames += [_uniqueness(df, n, c) for n, c in numbered if isinstance(c, Unique)]
    frames += [_lost(df, n, c, parents or {}) for n, c in numbered if isinstance(c, Relationship)]
    return (
        union_all(frames)
        .groupBy("number", "check", "column")
        .agg(F.sum("evaluated").alias("evaluated"), F.sum("failures").alias("failures"))
        .drop("number")
        .withColumn("success", F.col("failures") == 0)
    )


def enforce_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """The frame itself; a NULL in one of the columns fails the job that reads it."""
    return df.select(
        *[
            F.coalesce(
                F.col(c), F.raise_error(F.lit(f"NULL in required column {c}")).cast(df.schema[c].dataType)
            ).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )
