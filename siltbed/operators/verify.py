"""Integrity checks of file-level raw rows, computed where the payloads are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.digests import byte_size, sha256_label
from siltbed.operators.expand import non_blank_lines


def _tally(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row per check: rows tested and rows passed, all from one scan."""
    measures = [F.count(F.lit(1)).alias("_n")]
    measures += [F.count_if(test).alias(f"_p{i}") for i, test in enumerate(tests.values())]
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.col("_n").alias("evaluated"),
            F.col(f"_p{i}").alias("passed"),
            (F.col(f"_p{i}") == F.col("_n")).alias("success"),
        )
        for i, name in enumerate(tests)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def verify_contents(raw: DataFrame, expected_format: str | None = None) -> DataFrame:
    """Hash and size of every payload against its provenance, and the format label."""
    tests = {
        "hash": sha256_label(F.col("raw_payload")) == F.col("source_file_hash"),
        "size": byte_size(F.col("raw_payload")) == F.col("source_file_size_bytes"),
    }
    if expected_format is not None:
        tests["format"] = F.col("source_file_format") == expected_format
    return _tally(raw, tests)


def csv_header(payload: str = "raw_payload") -> Column:
    """First line without byte order mark, carriage return and quotes around whole cells."""
    first = F.substring_index(F.col(payload), "\n", 1)
    bare = F.rtrim(F.ltrim(first, F.lit("\ufeff")), F.lit("\r"))
    return F.regexp_replace(bare, '(^|,)"([^",]*)"(?=,|$)', "$1$2")


def verify_csv(raw: DataFrame, header: str, expected_rows: Column | int) -> DataFrame:
    """Header cells and number of data records of every CSV payload; an open quote swallows records and fails."""
    expected = F.lit(expected_rows) if isinstance(expected_rows, int) else expected_rows
    return _tally(
        raw,
        {"header": csv_header() == header, "data_rows": non_blank_lines() - 1 == expected},
    )


def verify_json(
    raw: DataFrame, wrapper_keys: list[str], outer: str, inner: str | None, expected: dict[str, Column | int]
) -> DataFrame:
    """Wrapper keys and element counts of every JSON payload.

    ``expected`` may name ``outer`` (elements of the outer array), ``first``
    (inner elements of the first of them) and ``inner`` (inner elements in all).
    """
    keys = F.json_object_keys("raw_payload")
    missing = F.array_except(F.array(*[F.lit(k) for k in wrapper_keys]), keys)
    shape = (
        f"{outer} array<struct<{inner}: array<string>>>" if inner else f"{outer} array<string>"
    )
    parsed = raw.withColumn("_outer", F.from_json("raw_payload", shape)[outer])
    counts = {"outer": _length(F.col("_outer"))}
    if inner:
        lengths = F.transform("_outer", lambda element: _length(element[inner]))
        counts["first"] = F.coalesce(F.get(lengths, F.lit(0)), F.lit(0))
        counts["inner"] = F.coalesce(F.aggregate(lengths, F.lit(0), lambda a, b: a + b), F.lit(0))
    tests = {"wrapper_keys": F.coalesce(F.size(missing) == 0, F.lit(False))}
    for name, value in expected.items():
        tests[name] = counts[name] == (F.lit(value) if isinstance(value, int) else value)
    return _tally(parsed, tests)


def _length(array: Column) -> Column:
    return F.coalesce(F.array_size(array), F.lit(0))


def verify_counts(raw: DataFrame, expected_rows: int, expected_runs: int) -> DataFrame:
    """Number of rows and of distinct ingestion runs."""
    return (
        raw.groupBy("ingestion_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("runs"))
        .select(
            F.inline(
                F.array(
                    _against("rows", F.col("rows"), expected_rows), _against("runs", F.col("runs"), expected_runs)
                )
            )
        )
    )


def _against(name: str, actual: Column, expected: int) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(expected).cast("bigint").alias("evaluated"),
        actual.cast("bigint").alias("passed"),
        (actual == expected).alias("success"),
    )


def summarize(checks: DataFrame) -> DataFrame:
    """``passed`` of ``total`` checks, and whether all of them are green."""
    return checks.agg(
        F.count_if("success").alias("passed"), F.count(F.lit(1)).alias("total"), F.every("success").alias("success")
    )
