"""Turning whole-file payloads into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.csv_text import csv_cells, csv_records
from siltbed.functions.json_fields import Fields, pick, text_schema
from siltbed.functions.text import BLANKS, blank_to_null, trimmed, typed
from siltbed.operators.payload_parts import csv_parts, json_array_parts

# A payload explodes inside the task that holds it. ``spread`` shuffles the
# (small) records afterwards, so that one huge file does not leave all further
# work to that task; with many files of similar size leave it out.


def _spread(df: DataFrame, spread: int | None) -> DataFrame:
    return df.repartition(spread) if spread else df


def _in_parts(raw: DataFrame, records: str, carry: list[str], payload: str, part_bytes: int | None) -> DataFrame:
    if part_bytes is None:
        return raw
    large = F.octet_length(payload) > part_bytes
    small = raw.filter(~large).select(*carry, payload)
    return small.unionByName(json_array_parts(raw.filter(large), records, carry, payload, part_bytes))


def expand_records(
    raw: DataFrame,
    records: str,
    fields: Fields,
    carry: list[str],
    payload: str = "raw_payload",
    strict: bool = True,
    spread: int | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """One row per element of a JSON array in the payload.

    A payload whose array is missing, null or empty gives no row. The payload
    is parsed once, for the wanted fields only. With ``part_bytes``, payloads of
    more bytes are expanded by several tasks.
    """
    raw = _in_parts(raw, records, carry, payload, part_bytes)
    element = text_schema([path for path, _ in fields.values()])
    envelope = T.StructType([T.StructField(records, T.ArrayType(element))])
    exploded = raw.select(
        *carry, F.explode(F.from_json(payload, envelope)[records]).alias("_record")
    )
    return _spread(exploded, spread).select(*carry, *pick("_record", fields, strict))


def expand_nested_records(
    raw: DataFrame,
    outer: str,
    inner: str,
    outer_fields: Fields,
    inner_fields: Fields,
    carry: list[str],
    payload: str = "raw_payload",
    strict: bool = True,
    spread: int | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """One row per element of an array nested in the elements of another array; ``part_bytes`` as in ``expand_records``."""
    raw = _in_parts(raw, outer, carry, payload, part_bytes)
    element = text_schema([path for path, _ in outer_fields.values()])
    nested = text_schema([path for path, _ in inner_fields.values()])
    element = T.StructType(element.fields + [T.StructField(inner, T.ArrayType(nested))])
    envelope = T.StructType([T.StructField(outer, T.ArrayType(element))])
    exploded = raw.select(
        *carry, F.explode(F.from_json(payload, envelope)[outer]).alias("_outer")
    ).select(*carry, "_outer", F.explode(f"_outer.{inner}").alias("_inner"))
    return _spread(exploded, spread).select(
        *carry, *pick("_outer", outer_fields, strict), *pick("_inner", inner_fields, strict)
    )


def expand_lines(
    raw: DataFrame, carry: list[str], payload: str = "raw_payload", lines: Column | None = None
) -> DataFrame:
    """One row per line with its 1-based number; a carriage return is cut off."""
    cut = F.split(payload, "\n") if lines is None else lines
    numbered = raw.select(*carry, F.posexplode(cut).alias("_pos", "_line"))
    return numbered.select(
        *carry,
        (F.col("_pos") + 1).cast("bigint").alias("row_number"),
        F.rtrim(F.col("_line"), F.lit("\r")).alias("line"),
    )


def expand_csv(
    raw: DataFrame,
    columns: dict[str, str],
    carry: list[str],
    payload: str = "raw_payload",
    quoted: bool = True,
    strict: bool = False,
    spread: int | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """One typed row per data record of a CSV payload with a header line.

    Blank records are dropped but counted in ``row_number``. Empty fields are
    NULL, missing trailing fields too. A quote opens a cell only at its start; a
    quoted cell may hold commas and line breaks, and is then one record of several
    lines; other quotes are letters. With ``quoted=False`` every comma and line
    break separates, as in a plain split. With ``part_bytes``, payloads of more
    bytes are expanded by several tasks; it serves quoted payloads.
    """
    if quoted:
        lines = _csv_lines(raw, carry, payload, part_bytes)
    else:
        lines = expand_lines(raw, carry, payload)
    lines = lines.filter((F.col("row_number") > 1) & (F.length(F.btrim("line", F.lit(BLANKS))) > 0))
    lines = _spread(lines, spread)
    if quoted:
        lines = lines.withColumn("_cells", csv_cells(F.col("line")))
        cells = {name: blank_to_null(F.get("_cells", F.lit(n))) for n, name in enumerate(columns)}
    else:
        cells = {
            name: blank_to_null(F.split_part(F.col("line"), F.lit(","), F.lit(n)))
            for n, name in enumerate(columns, start=1)
        }
    return lines.select(
        *carry,
        "row_number",
        *[typed(cells[name], data_type, strict).alias(name) for name, data_type in columns.items()],
    )


def _csv_lines(raw: DataFrame, carry: list[str], payload: str, part_bytes: int | None) -> DataFrame:
    records = csv_records(F.col(payload))
    if part_bytes is None:
        return expand_lines(raw, carry, payload, records)
    large = F.octet_length(payload) > part_bytes
    small = expand_lines(raw.filter(~large), carry, payload, records)
    parts = csv_parts(raw.filter(large), carry, payload, part_bytes)
    of_parts = expand_lines(parts, [*carry, "first_record"], payload, records)
    shifted = of_parts.withColumn("row_number", F.col("row_number") + F.col("first_record")).drop("first_record")
    return small.unionByName(shifted)


def non_blank_lines(payload: str = "raw_payload"):
    """Number of CSV records of a payload that hold more than white space."""
    return F.size(F.filter(csv_records(F.col(payload)), lambda line: F.length(trimmed(line)) > 0))
