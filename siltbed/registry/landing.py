"""Source files derived from the given tables, written where all executors see them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.session import work_dir

RECORDS_PER_FILE = 1_000


def land_csv(df: DataFrame, label: str, records_per_file: int = 20_000) -> str:
    """Frame as CSV files with header; returns the folder."""
    folder = work_dir(df.sparkSession, label)
    df.write.option("header", True).option("maxRecordsPerFile", records_per_file).csv(folder)
    return folder


def land_lines(df: DataFrame, line: Column, label: str, records_per_file: int = 20_000) -> str:
    """One line per row."""
    folder = work_dir(df.sparkSession, label)
    df.select(line.alias("value")).write.option("maxRecordsPerFile", records_per_file).text(folder)
    return folder


def land_payloads(payloads: DataFrame, payload: str, label: str) -> str:
    """One file per row; payloads are whole documents of bounded size."""
    folder = work_dir(payloads.sparkSession, label)
    payloads.select(F.col(payload).alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return folder


def block_of(unique_id: str, size: int = RECORDS_PER_FILE) -> Column:
    """Block number that puts at most ``size`` ids of a unique integer key together."""
    return F.floor(F.col(unique_id) / size).cast("bigint")
