"""Expectation suites: table-level quality rules with a tolerated share of exceptions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.merge import union_all


@dataclass(frozen=True)
class RowCountBetween:
    low: int
    high: int
    name: str = "row_count_between"


@dataclass(frozen=True)
class NotNull:
    column: str
    mostly: float = 1.0
    name: str = "not_null"

    def unexpected(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class LengthEquals:
    column: str
    length: int
    mostly: float = 1.0
    name: str = "length_equals"

    def unexpected(self) -> Column:
        return F.char_length(self.column) != self.length


@dataclass(frozen=True)
class InSet:
    column: str
    values: tuple
    mostly: float = 1.0
    name: str = "in_set"

    def unexpected(self) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class Between:
    column: str
    low: float
    high: float
    mostly: float = 1.0
    name: str = "between"

    def unexpected(self) -> Column:
        return ~F.col(self.column).between(self.low, self.high)


@dataclass(frozen=True)
class CompoundUnique:
    columns: tuple[str, ...]
    name: str = "compound_unique"


Expectation = RowCountBetween | NotNull | LengthEquals | InSet | Between | CompoundUnique


def _outcome(e: Expectation, evaluated: Column, unexpected: Column, success: Column) -> Column:
    if isinstance(e, CompoundUnique):
        column = ", ".join(e.columns)
    else:
        column = getattr(e, "column", "")
    evaluated, unexpected = evaluated.cast("bigint"), unexpected.cast("bigint")
    share = F.when(evaluated > 0, 100 * unexpected.cast("double") / evaluated).otherwise(F.lit(0.0))
    return F.struct(
        F.lit(e.name).alias("expectation"),
        F.lit(column).alias("column"),
        evaluated.alias("evaluated"),
        unexpected.alias("unexpected"),
        F.round(share, 4).alias("unexpected_pct"),
        success.alias("success"),
    )


def _row_level(df: DataFrame, suite: list[Expectation]) -> list[DataFrame]:
    """Everything but uniqueness as one aggregate over one scan."""
    measures, outcomes = [F.count(F.lit(1)).alias("n")], []
    total = F.col("n")
    for i, e in enumerate(suite):
        if isinstance(e, RowCountBetween):
            fits = total.between(e.low, e.high)
            outcomes.append(_outcome(e, total, F.when(fits, 0).otherwise(total), fits))
            continue
        if isinstance(e, CompoundUnique):
            continue
        measures.append(F.count_if(e.unexpected()).alias(f"u{i}"))
        if isinstance(e, NotNull):
            evaluated = total
        else:
            # NULLs are no values: they are neither expected nor unexpected.
            measures.append(F.count(e.column).alias(f"e{i}"))
            evaluated = F.col(f"e{i}")
        met = evaluated - F.col(f"u{i}")
        success = (evaluated == 0) | (met.cast("double") / F.nullif(evaluated, F.lit(0)) >= e.mostly)
        outcomes.append(_outcome(e, evaluated, F.col(f"u{i}"), success))
    if not outcomes:
        return []
    return [df.agg(*measures).select(F.inline(F.array(*outcomes)))]


def _compound(df: DataFrame, e: CompoundUnique) -> DataFrame:
    """All rows of a repeated key are unexpected; rows without any key value are left out.

    One grouping that combines map-side.
    """
    keyed = df.select(*e.columns).dropna("all")
    per_key = keyed.groupBy(*e.columns).agg(F.count(F.lit(1)).alias("_rows"))
    sums = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))), F.lit(0)).alias("u"),
    )
    return sums.select(F.inline(F.array(_outcome(e, F.col("n"), F.col("u"), F.col("u") == 0))))


def validate(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation: evaluated, unexpected, unexpected_pct, success."""
    frames = _row_level(df, suite)
    frames += [_compound(df, e) for e in suite if isinstance(e, CompoundUnique)]
    return union_all(frames)


def statistics(results: DataFrame) -> DataFrame:
    """One row for a whole suite: how many expectations, how many met, green or not."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.round(100 * F.count_if("success").cast("double") / F.count(F.lit(1)), 2).alias("success_percent"),
        F.every("success").alias("success"),
    )
