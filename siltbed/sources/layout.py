"""Files in which the values of several columns lie close together, so that any of them prunes.

A table sorted by one column is pruned by that one only. Here the bits of the
columns' quantile ranks are interleaved into one key, and files are ranges of
that key: each holds a small box of values, and the minima and maxima that
Parquet keeps skip the files and row groups that a filter does not meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a rank: 63 cuts per column go to the driver, whatever the size of the table.
BITS = 6
ROWS_PER_FILE = 2_000_000


def position(df: DataFrame, name: str) -> Column:
    """A column as a number in the same order; texts by their first six bytes, which is enough for a rank."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def rank_among(value: Column, cuts: list[float]) -> Column:
    """How many cuts are not above a value, found by halving; NULL ranks lowest."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(value.isNull(), 0).otherwise(between(0, len(cuts)))


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """Bits of several ranks in turn, the highest first."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return key


def interleaving_key(df: DataFrame, columns: list[str], bits: int = BITS) -> tuple[Column, int]:
    """The key of a row, and how many rows there are; one aggregate finds the cuts of all columns."""
    if bits * len(columns) > 62:
        raise ValueError("the key has room for 62 bits")
    shares = [n / 2**bits for n in range(1, 2**bits)]
    found = df.agg(
        F.count(F.lit(1)),
        *[F.percentile_approx(position(df, name), shares, 10_000).alias(f"c{i}") for i, name in enumerate(columns)],
    ).first()
    ranks = [rank_among(position(df, name), sorted(set(cuts or []))) for name, cuts in zip(columns, found[1:])]
    return interleaved(ranks, bits), found[0]


def write_interleaved(
    df: DataFrame, columns: list[str], folder: str, rows_per_file: int = ROWS_PER_FILE, bits: int = BITS
) -> None:
    """Store a table in files that are ranges of the interleaved key.

    Many rows with one key are spread over several files by their content and
    place; repeated rows, NULLs and an empty table are stored as they are.
    """
    key, rows = interleaving_key(df, columns, bits)
    files = max(1, -(-rows // rows_per_file))
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns])
    marked = df.withColumns({"_key": key, "_spread": spread})
    dealt = marked.repartitionByRange(files, "_key", "_spread") if files > 1 else marked.coalesce(1)
    dealt.sortWithinPartitions("_key").drop("_key", "_spread").write.parquet(folder)
