"""Two states of a table compared by digests first, row by row only where digests differ.

Rows fall into ranges of a hash of their key. Count and two sums of row hashes
of a range do not depend on row order or on how often a file was rewritten, can be
stored with a load, and add up from ranges to the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digests are one row per range, so this bounds what is joined and broadcast.
RANGES = 4096
MEASURES = ["rows", "sum_a", "sum_b"]


def _named(names: list[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def range_of(keys: list[str], ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(*_named(keys)), F.lit(ranges)).cast("int")


def _row_hash(seed: int, names: list[str]) -> Column:
    """64 bits of a whole row. NULLs leave a hash as it is, so their places go in beside the values."""
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in _named(names)])
    return F.xxhash64(F.lit(seed), nulls, *_named(names)).cast("decimal(20,0)")


def range_digests(rows: DataFrame, keys: list[str], ranges: int = RANGES) -> DataFrame:
    """One row per range that holds rows: its number, rows and order-free digests; one aggregate, combined map-side."""
    names = sorted(rows.columns)
    return rows.groupBy(range_of(keys, ranges).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_row_hash(1, names)).alias("sum_a"),
        F.sum(_row_hash(2, names)).alias("sum_b"),
    )


def add_digests(*parts: DataFrame) -> DataFrame:
    """Digests of several loads as those of all their rows."""
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united.groupBy("range").agg(*[F.sum(m).cast(united.schema[m].dataType).alias(m) for m in MEASURES])


def table_digest(digests: DataFrame) -> DataFrame:
    """One row for the whole table; equal tables have equal ones."""
    totals = [F.coalesce(F.sum(m), F.lit(0)).cast("decimal(38,0)").alias(m) for m in MEASURES]
    return digests.agg(*totals)


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """Numbers of the ranges whose digests differ or that one side lacks."""
    r = right.select(F.col("range").alias("r_range"), *[F.col(m).alias(f"r_{m}") for m in MEASURES])
    same = F.lit(True)
    for m in MEASURES:
        same = same & F.col(m).eqNullSafe(F.col(f"r_{m}"))
    both = left.join(r, F.col("range") == F.col("r_range"), "full")
    return both.filter(~same).select(F.coalesce("range", "r_range").alias("range"))


def rows_in(rows: DataFrame, keys: list[str], wanted: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Rows of some ranges. The numbers are broadcast, ``ranges`` at most, so other rows end where they are read."""
    numbers = F.broadcast(wanted.select(F.col("range").alias("_range")))
    return rows.join(numbers, range_of(keys, ranges) == F.col("_range"), "left_semi")


def compare_by_ranges(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    ranges: int = RANGES,
    digests: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Rows that only one side holds, with how often, as ``change`` and ``times``.

    Both sides have the same columns. With stored ``digests`` of both sides no row
    outside the differing ranges is touched twice. Copies of a row are counted before
    the shuffle.
    """
    known = digests or (range_digests(left, keys, ranges), range_digests(right, keys, ranges))
    wanted = differing_ranges(*known)
    names = left.columns
    sides = [
        rows_in(side.select(*_named(names)), keys, wanted, ranges).withColumn("_sign", F.lit(sign))
        for side, sign in ((left, -1), (right, 1))
    ]
    balance = sides[0].unionByName(sides[1]).groupBy(*_named(names)).agg(F.sum("_sign").alias("_balance"))
    return balance.filter("_balance <> 0").select(
        F.when(F.col("_balance") > 0, "added").otherwise("removed").alias("change"),
        F.abs("_balance").cast("bigint").alias("times"),
        *_named(names),
    )
