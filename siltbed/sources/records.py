"""Record-level scans: typed CSV and multi-line JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header line. Without a schema Spark infers it in an extra pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Files that each hold one JSON document or one array of records."""
    reader = spark.read.option("multiLine", True)
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def extract(df: DataFrame, column: str, values: list, cutoff: Column | None = None) -> DataFrame:
    """Source extract: rows whose column is in a set, from a cutoff on.

    The column is found by name without regard to case.
    """
    names = {name.lower(): name for name in df.columns}
    kept = df.filter(F.col(names[column.lower()]).isin(values))
    return kept if cutoff is None else kept.filter(cutoff)
