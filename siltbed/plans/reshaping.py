"""Company emissions in the newer record layout of the JSON source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.operators.reshape import nest, project_paths

# One record of the newer layout.
RECORD_V2 = (
    "entity struct<id: string, name: string, isin: string, lei: string, country: string>,"
    " industry_classification string, reporting_year bigint,"
    " emissions struct<scope_1_tco2e: bigint, scope_2_location_tco2e: bigint,"
    " scope_2_market_tco2e: bigint, scope_3_total_tco2e: bigint, unit: string>,"
    " climate_target struct<net_zero_year: bigint>,"
    " metadata struct<reporting_framework: string, verification: string, api_version: string>"
)

FLAT_PATHS = {
    "company_id": "entity.id",
    "company_name": "entity.name",
    "isin": "entity.isin",
    "lei": "entity.lei",
    "country": "entity.country",
    "sector": "industry_classification",
    "reporting_year": "reporting_year",
    "scope_1_tco2e": "emissions.scope_1_tco2e",
    "scope_2_location_tco2e": "emissions.scope_2_location_tco2e",
    "scope_2_market_tco2e": "emissions.scope_2_market_tco2e",
    "scope_3_total_tco2e": "emissions.scope_3_total_tco2e",
    "unit": "emissions.unit",
    "net_zero_year": "climate_target.net_zero_year",
    "reporting_framework": "metadata.reporting_framework",
    "verification": "metadata.verification",
    "api_version": "metadata.api_version",
}


def to_v2(companies: DataFrame) -> DataFrame:
    """Companies with their reporting periods to one nested record per period.

    ``companies`` has the columns of one element of the older layout's ``data``
    array. Value objects become plain numbers, missing ones NULL.
    """
    periods = companies.withColumn("_period", F.explode("reporting_periods"))

    def number(path: str):
        return F.col(f"_period.{path}").cast("bigint")

    return nest(
        periods,
        {
            "entity": {
                "id": F.col("company_id"),
                "name": F.col("company_name"),
                "isin": F.col("isin"),
                "lei": F.col("lei"),
                "country": F.col("country_of_incorporation"),
            },
            "industry_classification": F.col("primary_sector"),
            "reporting_year": number("reporting_year"),
            "emissions": {
                "scope_1_tco2e": number("scope_1.value"),
                "scope_2_location_tco2e": number("scope_2_location_based.value"),
                "scope_2_market_tco2e": number("scope_2_market_based.value"),
                "scope_3_total_tco2e": number("scope_3.total"),
                "unit": F.lit("tCO2e"),
            },
            "climate_target": {"net_zero_year": number("net_zero_target.target_year")},
            "metadata": {
                "reporting_framework": F.col("_period.reporting_framework"),
                "verification": F.col("_period.verification_status"),
                "api_version": F.lit("v2"),
            },
        },
    )


def flatten_v2(records: DataFrame) -> DataFrame:
    """Records of the newer layout to flat columns."""
    return project_paths(records, FLAT_PATHS, {"reporting_year": "int", "net_zero_year": "int"})
