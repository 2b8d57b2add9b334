"""Company emissions: two sources in two formats to one trusted table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.text import harmonize_sector, standardize_code, to_decimal
from siltbed.operators import expectations as expect
from siltbed.operators.checks import AcceptedValues, NotNull, Relationship, Unique
from siltbed.operators.expand import expand_csv, expand_nested_records
from siltbed.operators.merge import merge_entities, union_labelled
from siltbed.sources.files import PROVENANCE, Source

CDP_FILES = Source(file_format="csv", system="cdp")
NZDPU_FILES = Source(file_format="json", system="nzdpu", system_field="source", object_required=True)

# Header names of the CSV source, in file order, and our names and types.
CDP_COLUMNS = {
    "Account Number": ("account_number", "string"),
    "Organization": ("organization", "string"),
    "Primary Sector": ("primary_sector", "string"),
    "Primary Industry": ("primary_industry", "string"),
    "Country": ("country", "string"),
    "ISIN": ("isin", "string"),
    "Reporting Year": ("reporting_year", "int"),
    "Scope 1 (metric tons CO2e)": ("scope_1_tco2e", "double"),
    "Scope 2 Location-Based (metric tons CO2e)": ("scope_2_location_tco2e", "double"),
    "Scope 2 Market-Based (metric tons CO2e)": ("scope_2_market_tco2e", "double"),
    "Scope 3 Total (metric tons CO2e)": ("scope_3_total_tco2e", "double"),
    "Emission Unit": ("emission_unit", "string"),
    "Data Verification": ("data_verification", "string"),
    "CDP Score": ("cdp_score", "string"),
    "Public Disclosure": ("public_disclosure", "string"),
}
CDP_HEADER = ",".join(CDP_COLUMNS)

# Fields of the JSON source, per company and per reporting period.
NZDPU_COMPANY = {
    "company_id": ("company_id", "string"),
    "company_name": ("company_name", "string"),
    "isin": ("isin", "string"),
    "lei": ("lei", "string"),
    "country": ("country_of_incorporation", "string"),
    "primary_sector": ("primary_sector", "string"),
}
NZDPU_PERIOD = {
    "reporting_year": ("reporting_year", "int"),
    "reporting_framework": ("reporting_framework", "string"),
    "verification_status": ("verification_status", "string"),
    "scope_1_tco2e": ("scope_1.value", "double"),
    "scope_1_unit": ("scope_1.unit", "string"),
    "scope_2_location_tco2e": ("scope_2_location_based.value", "double"),
    "scope_2_market_tco2e": ("scope_2_market_based.value", "double"),
    "scope_3_total_tco2e": ("scope_3.total", "double"),
}
NZDPU_WRAPPER = ["status", "total_records", "source", "data"]

SCOPES = ["scope_1_tco2e", "scope_2_location_tco2e", "scope_2_market_tco2e", "scope_3_total_tco2e"]
EMISSION_KEY = ("isin", "reporting_year", "source_system")
SOURCES = ("nzdpu", "cdp")

RAW_CHECKS = [
    NotNull("ingestion_id"),
    NotNull("ingestion_timestamp"),
    NotNull("source_system"),
    NotNull("source_file_hash"),
    NotNull("source_file_size_bytes"),
    NotNull("source_file_format"),
    NotNull("raw_payload"),
]
RAW_CDP_CHECKS = [*RAW_CHECKS, AcceptedValues("source_file_format", ("csv",))]
RAW_NZDPU_CHECKS = [*RAW_CHECKS, AcceptedValues("source_file_format", ("json",))]
STAGED_CDP_CHECKS = [
    NotNull("ingestion_id"),
    NotNull("ingestion_timestamp"),
    NotNull("source_file_hash"),
    NotNull("row_number"),
    NotNull("account_number"),
    NotNull("reporting_year"),
]
STAGED_NZDPU_CHECKS = [
    NotNull("ingestion_id"),
    NotNull("ingestion_timestamp"),
    NotNull("source_file_hash"),
    NotNull("company_id"),
    NotNull("company_name"),
    NotNull("isin"),
    NotNull("reporting_year"),
    AcceptedValues("scope_1_unit", ("tCO2e",)),
]
COMPANY_CHECKS = [
    NotNull("isin"),
    Unique(("isin",)),
    NotNull("company_name"),
    NotNull("preferred_source"),
    AcceptedValues("preferred_source", SOURCES),
]
CURATED_CHECKS = [
    NotNull("isin"),
    Relationship("isin", "curated.companies", "isin"),
    NotNull("reporting_year"),
    NotNull("source_system"),
    AcceptedValues("source_system", SOURCES),
    NotNull("ingestion_timestamp"),
    NotNull("source_file_hash"),
    Unique(EMISSION_KEY),
]
TRUSTED_CHECKS = [
    NotNull("isin"),
    NotNull("reporting_year"),
    NotNull("source_system"),
    AcceptedValues("source_system", SOURCES),
    NotNull("scope_1_tco2e"),
    NotNull("ingestion_id"),
    NotNull("ingestion_timestamp"),
    Unique(EMISSION_KEY),
]

# The release rules of the curated table.
CURATED_SUITE = [
    expect.RowCountBetween(100, 200),
    expect.NotNull("isin"),
    expect.LengthEquals("isin", 12),
    expect.InSet("source_system", SOURCES),
    expect.Between("scope_1_tco2e", 0, 100_000_000, mostly=0.95),
    expect.CompoundUnique(EMISSION_KEY),
]


def stage_cdp(raw: DataFrame, quoted: bool = True, spread: int | None = None) -> DataFrame:
    """One row per CSV data line; numbers that do not parse are NULL."""
    columns = dict(CDP_COLUMNS.values())
    return expand_csv(raw, columns, PROVENANCE, quoted=quoted, spread=spread)


def stage_nzdpu(raw: DataFrame, spread: int | None = None) -> DataFrame:
    """One row per company and reporting period; numbers that do not parse fail."""
    return expand_nested_records(
        raw, "data", "reporting_periods", NZDPU_COMPANY, NZDPU_PERIOD, PROVENANCE, spread=spread
    )


def _identified(df: DataFrame, strict: bool) -> DataFrame:
    """Rows with an identifier, standardized first so that blank ones count as missing.

    With ``strict=False`` the filter comes first, so rows with a blank
    identifier stay and have none.
    """
    kept = df if strict else df.filter(F.col("isin").isNotNull())
    named = kept.withColumn("isin", standardize_code(F.col("isin")))
    return named.filter(F.col("isin").isNotNull()) if strict else named


def curate_companies(nzdpu: DataFrame, cdp: DataFrame, strict: bool = True) -> DataFrame:
    """One record per identifier; the JSON source is preferred, it knows the LEI."""
    def entities(df: DataFrame, name: str, lei) -> DataFrame:
        return _identified(df, strict).select(
            "isin",
            F.col(name).alias("company_name"),
            lei.cast("string").alias("lei"),
            "country",
            harmonize_sector(F.col("primary_sector")).alias("primary_sector"),
        )

    return merge_entities(
        {
            "nzdpu": entities(nzdpu, "company_name", F.col("lei")),
            "cdp": entities(cdp, "organization", F.lit(None)),
        },
        "isin",
    )


def curate_emissions(nzdpu: DataFrame, cdp: DataFrame, strict: bool = True) -> DataFrame:
    """Both sources side by side, one row per company, year and source."""
    def aligned(df: DataFrame, verification: str) -> DataFrame:
        return _identified(df, strict).select(
            "isin",
            "reporting_year",
            *[to_decimal(F.col(c)).alias(c) for c in SCOPES],
            F.col(verification).alias("verification"),
            "ingestion_id",
            "ingestion_timestamp",
            "source_file_hash",
        )

    both = union_labelled(
        {"nzdpu": aligned(nzdpu, "verification_status"), "cdp": aligned(cdp, "data_verification")}
    )
    return both.select(*EMISSION_KEY, *SCOPES, "verification", "ingestion_id", "ingestion_timestamp", "source_file_hash")


def trust_emissions(curated: DataFrame) -> DataFrame:
    """The released table: all curated rows. Its tests are stricter, not its filter."""
    return curated.select(*EMISSION_KEY, *SCOPES, "verification", "ingestion_id", "ingestion_timestamp", "source_file_hash")
