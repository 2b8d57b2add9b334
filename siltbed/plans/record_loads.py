"""Record-level loads of tables that no model refines further."""

from __future__ import annotations

from pyspark.sql import SparkSession

from siltbed.sources.records import read_csv
from siltbed.sources.tables import VersionedTable

FUND_MASTER = (
    "fund_isin string, fund_wkn string, fund_name string, fund_type string,"
    " currency string, inception_date date, domicile string"
)
FUND_POSITIONS = "fund_isin string, holding_isin string, weight_pct double, position_date date"


def load_fund_master(spark: SparkSession, csv: str, table: VersionedTable) -> int:
    return table.overwrite(read_csv(spark, csv, FUND_MASTER))


def load_fund_positions(spark: SparkSession, csv: str, table: VersionedTable) -> int:
    return table.overwrite(read_csv(spark, csv, FUND_POSITIONS), partition_by=["position_date"])


def load_country_emissions(spark: SparkSession, csv: str, table: VersionedTable) -> int:
    """Columns of this public download vary, so its types are inferred."""
    return table.overwrite(read_csv(spark, csv), partition_by=["year"])
