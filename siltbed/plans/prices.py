"""Fund prices: JSON load files to typed daily prices with correction history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators import history
from siltbed.operators.checks import AcceptedValues, NotNull, Unique
from siltbed.operators.expand import expand_records
from siltbed.sources.files import PROVENANCE, Source
from siltbed.sources.tables import VersionedTable

PRICE_FILES = Source(
    file_format="json",
    system="",
    version=None,
    system_field="source_system",
    version_field="source_version",
    object_required=True,
)

# output column -> (path in the JSON record, type)
PRICE_FIELDS = {
    "isin": ("isin", "string"),
    "fund_name": ("fund_name", "string"),
    "business_date": ("business_date", "date"),
    "nav": ("nav", "double"),
    "currency": ("currency", "string"),
}
KEYS = ["isin", "business_date"]
CHECKS = ["nav", "currency"]
PART = "history_part"
HISTORY_COLUMNS = [
    "isin",
    "business_date",
    "nav",
    "currency",
    "fund_name",
    "ingestion_id",
    "ingestion_timestamp",
    "source_system",
    "source_version",
    "source_file_hash",
]

RAW_CHECKS = [
    NotNull("ingestion_id"),
    NotNull("ingestion_timestamp"),
    NotNull("source_file_hash"),
    NotNull("raw_payload"),
]
STAGING_CHECKS = [
    NotNull("isin"),
    NotNull("business_date"),
    NotNull("nav"),
    NotNull("currency"),
    AcceptedValues("currency", ("EUR", "USD")),
    NotNull("ingestion_id"),
]
HISTORY_CHECKS = [
    NotNull("isin"),
    NotNull("business_date"),
    NotNull("nav"),
    Unique(("scd_id",)),
    NotNull("scd_id"),
    NotNull("valid_from"),
    Unique(("isin", "business_date"), where="valid_to IS NULL"),
]


def stage_prices(raw: DataFrame, spread: int | None = None) -> DataFrame:
    """One row per fund and day of every load file."""
    return expand_records(raw, "records", PRICE_FIELDS, PROVENANCE, spread=spread)


def newest_prices(staged: DataFrame) -> DataFrame:
    """The newest record per fund and day, as the history compares it."""
    return history.latest_load(staged, KEYS, "ingestion_timestamp", ["source_file_hash", "nav"]).select(
        *HISTORY_COLUMNS
    )


def record_history(
    table: VersionedTable,
    source: DataFrame,
    run_at: Column,
    keys: list[str] = KEYS,
    checks: list[str] = CHECKS,
    slice_by: Column | None = None,
    slices_from: DataFrame | None = None,
    loaded_at: str | None = None,
    **labels: str,
) -> int:
    """Bring a stored history up to date with a source that is unique per key.

    The table is split into open and closed versions, and these by a coarse
    slice of the key, such as its month. A run reads and writes the open
    versions of the slices its source touches; closed versions and other
    slices stay where they are. ``slice_by`` must follow from the key alone;
    the slices are looked up in ``slices_from``, rows with the same keys that
    cost less to read than the source. A record whose ``loaded_at`` is older
    than that of the open version changes nothing, whenever its load arrives.
    """
    slice_label = F.lit("all") if slice_by is None else F.coalesce(slice_by.cast("string"), F.lit("none"))
    state = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
    part = F.concat_ws("_", state, slice_label).alias(PART)
    newest = table.newest()
    if newest is None or newest["split_by"] is None:
        # Never written, or emptied since.
        first = history.first_load(source, keys, run_at)
        return table.overwrite(first.select("*", part), split_by=PART, **labels)
    parts = ["open_all"]
    if slice_by is not None:
        touched = source if slices_from is None else slices_from
        labelled = touched.select(F.concat_ws("_", F.lit("open"), slice_label).alias(PART))
        parts = [row[PART] for row in labelled.distinct().collect()]
    open_rows = table.read_entry(newest).filter(F.col(PART).isin(parts)).drop(PART)
    moved = history.advance(open_rows, source, keys, checks, run_at, loaded_at)
    return table.replace_split(moved.select("*", part), parts, **labels)


def record_prices(table: VersionedTable, staged: DataFrame, run_at: Column) -> int:
    """Price history by business month; corrections mostly concern recent ones.

    Staged records of new loads alone are enough, since keys without one stay open.
    """
    month = F.date_format("business_date", "yyyy-MM")
    return record_history(
        table, newest_prices(staged), run_at, slice_by=month, slices_from=staged, loaded_at="ingestion_timestamp"
    )


def read_history(table: VersionedTable, version: int | None = None) -> DataFrame:
    return table.read(version).drop(PART)
