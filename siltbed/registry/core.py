"""Registration of queries and access to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.session import ensure_utc

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def register(run: Query) -> Query:
        @wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return run(spark, sf_dir)

        ENTRIES[name] = Entry(in_utc, sql)
        return in_utc

    return register


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payload_rows(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table that payloads are made of; how many tasks read them is a session setting."""
    return given(spark, sf_dir, name).select(*columns)


def instant(text: str):
    """A UTC instant as a literal column."""
    return F.to_timestamp(F.lit(text))


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """UTC instants as timestamps without zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
