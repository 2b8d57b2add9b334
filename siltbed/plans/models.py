"""The models of both data products, in the order of their inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.operators.checks import enforce_not_null
from siltbed.plans import emissions, prices
from siltbed.plans.layers import Model
from siltbed.sources.files import RAW_SCHEMA, Run, Source, ingest, read_files, with_ingestion_date


def raw_model(
    spark: SparkSession, name: str, path: str, glob: str, source: Source, run: Run, checks: list
) -> Model:
    required = [f.name for f in RAW_SCHEMA.fields if not f.nullable]

    def build() -> DataFrame:
        raw = enforce_not_null(ingest(read_files(spark, path, glob), source, run), required)
        return with_ingestion_date(raw)

    return Model("raw", name, (), build, tuple(checks), ("ingestion_date",))


def staging_model(name: str, build: Callable[[DataFrame], DataFrame], checks: list) -> Model:
    return Model("staging", name, (f"raw.{name}",), build, tuple(checks), row_wise=True)


def emission_models(
    spark: SparkSession,
    cdp_path: str,
    nzdpu_path: str,
    run: Run,
    cdp_glob: str = "*.csv",
    nzdpu_glob: str = "*.json",
) -> list[Model]:
    return [
        raw_model(spark, "cdp", cdp_path, cdp_glob, emissions.CDP_FILES, run, emissions.RAW_CDP_CHECKS),
        raw_model(spark, "nzdpu", nzdpu_path, nzdpu_glob, emissions.NZDPU_FILES, run, emissions.RAW_NZDPU_CHECKS),
        staging_model("cdp", emissions.stage_cdp, emissions.STAGED_CDP_CHECKS),
        staging_model("nzdpu", emissions.stage_nzdpu, emissions.STAGED_NZDPU_CHECKS),
        Model(
            "curated",
            "companies",
            ("staging.nzdpu", "staging.cdp"),
            emissions.curate_companies,
            tuple(emissions.COMPANY_CHECKS),
        ),
        Model(
            "curated",
            "emissions",
            ("staging.nzdpu", "staging.cdp"),
            emissions.curate_emissions,
            tuple(emissions.CURATED_CHECKS),
        ),
        Model(
            "trusted",
            "emissions",
            ("curated.emissions",),
            emissions.trust_emissions,
            tuple(emissions.TRUSTED_CHECKS),
        ),
    ]


def price_models(spark: SparkSession, path: str, run: Run, glob: str = "*.json") -> list[Model]:
    """Raw and typed prices, and their history, whose versions open at the run's time."""
    run_at = F.to_timestamp(F.lit(run.timestamp))
    return [
        raw_model(spark, "prices", path, glob, prices.PRICE_FILES, run, prices.RAW_CHECKS),
        staging_model("prices", prices.stage_prices, prices.STAGING_CHECKS),
        Model(
            "curated",
            "prices_history",
            ("staging.prices",),
            lambda staged: staged,
            tuple(prices.HISTORY_CHECKS),
            store=lambda table, staged: prices.record_prices(table, staged, run_at),
        ),
    ]
