"""Column profiles that are kept per load and united, so that a profile reads the new load only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Registers of the distinct-count sketch as a power of two; the estimate's standard error is 0.83 / sqrt(2 ** this).
DISTINCT_BITS = 14
DISTINCT_ERROR = 0.83 / 2 ** (DISTINCT_BITS / 2)
#: Accuracy of the quantile sketch: ranks differ by about 0.7 % of the rows.
QUANTILE_K = 400

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBER = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
_SORTED_AS_TEXT = (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


def profile_state(df: DataFrame, load: str, columns: list[str] | None = None) -> DataFrame:
    """One row per column of a load: rows, NULLs, extremes, and sketches of its distinct values and quantiles.

    Whole numbers, other numbers and texts have extremes of their own type; dates
    and times are kept as texts, which sort like them. All in one aggregate.
    """
    measures: list[Column] = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, name in enumerate(columns or df.columns):
        column, kind = F.col(f"`{name}`"), df.schema[name].dataType
        whole, number = isinstance(kind, _WHOLE), isinstance(kind, _NUMBER)
        text = isinstance(kind, _SORTED_AS_TEXT)
        value = column.cast("long") if whole else column.cast("string")
        measures += [
            F.count_if(column.isNull()).alias(f"nulls{i}"),
            F.min(column).alias(f"least{i}"),
            F.max(column).alias(f"largest{i}"),
            F.hll_sketch_agg(value, F.lit(DISTINCT_BITS)).alias(f"distinct{i}"),
        ]
        quantiles = F.lit(None).cast("binary")
        if number:
            measures.append(F.kll_sketch_agg_double(column.cast("double"), F.lit(QUANTILE_K)).alias(f"quantiles{i}"))
            quantiles = F.col(f"quantiles{i}")

        def end(which: str, fits: bool, slot: str, i: int = i) -> Column:
            held = F.col(f"{which}{i}") if fits else F.lit(None)
            return held.cast(slot).alias(f"{which}_{slot}")

        rows.append(
            F.struct(
                F.lit(load).alias("load"),
                F.lit(name).alias("column_name"),
                F.col("n").alias("row_count"),
                F.col(f"nulls{i}").alias("null_count"),
                *[
                    end(which, fits, slot)
                    for which in ("least", "largest")
                    for fits, slot in ((whole, "long"), (number and not whole, "double"), (text, "string"))
                ],
                F.col(f"distinct{i}").alias("distinct_sketch"),
                quantiles.alias("quantile_sketch"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def unite(states: DataFrame) -> DataFrame:
    """One state per column from the states of all loads; counts and extremes are exact, whatever the split,
    estimates within the errors of their sketches."""
    slots = ("long", "double", "string")
    return states.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        *[F.min(f"least_{s}").alias(f"least_{s}") for s in slots],
        *[F.max(f"largest_{s}").alias(f"largest_{s}") for s in slots],
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", F.lit(QUANTILE_K)).alias("quantile_sketch"),
    )


def profile_of(united: DataFrame, quantile: float = 0.5) -> DataFrame:
    """The profile of united states: extremes as number or text, estimated distinct values, one quantile of numbers."""

    def number(which: str) -> Column:
        return F.coalesce(F.col(f"{which}_long").cast("double"), F.col(f"{which}_double"))

    has_numbers = number("least").isNotNull()
    return united.select(
        "column_name",
        "row_count",
        "null_count",
        number("least").alias("least_number"),
        number("largest").alias("largest_number"),
        F.col("least_string").alias("least_text"),
        F.col("largest_string").alias("largest_text"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        F.when(has_numbers, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(quantile))).alias("quantile"),
    )
