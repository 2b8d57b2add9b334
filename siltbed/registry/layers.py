from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.functions.check_digits import check_digit
from siltbed.operators.merge import union_all
from siltbed.operators.reshape import wrap_records
from siltbed.operators.skew import bounded_blocks
from siltbed.plans.emissions import CDP_HEADER
from siltbed.plans.layers import Layers
from siltbed.plans.models import emission_models, price_models
from siltbed.plans.prices import read_history, record_prices
from siltbed.registry.core import given, instant, plain_time, query
from siltbed.registry.landing import block_of, land_payloads
from siltbed.session import work_dir
from siltbed.sources.files import Run

RUN = Run("run-0001", "2026-01-05T08:00:00Z")


def identifier(key):
    stem = F.concat(F.lit("DE"), F.lpad(key.cast("string"), 9, "0"))
    return F.concat(stem, check_digit(stem).cast("string"))


def land_json_companies(spark, sf_dir) -> str:
    """Customers as companies with two reporting years, in JSON files of up to 500."""

    def amount(value):
        return F.struct(value.cast("bigint").alias("value"), F.lit("tCO2e").alias("unit"))

    def period(year, shift):
        return F.struct(
            F.lit(year).alias("reporting_year"),
            F.lit("GRI").alias("reporting_framework"),
            F.lit("limited").alias("verification_status"),
            amount(F.abs(F.floor("c_acctbal")) + shift).alias("scope_1"),
            F.when(F.col("c_acctbal") > 0, amount(F.floor("c_acctbal"))).alias("scope_2_location_based"),
        )

    companies = given(spark, sf_dir, "customer").select(
        F.col("c_custkey"),
        F.concat(F.lit("C"), "c_custkey").alias("company_id"),
        F.col("c_name").alias("company_name"),
        identifier(F.col("c_custkey")).alias("isin"),
        F.concat(F.lit("LEI"), "c_custkey").alias("lei"),
        F.concat(F.lit("N"), "c_nationkey").alias("country_of_incorporation"),
        F.col("c_mktsegment").alias("primary_sector"),
        F.array(period(2021, 0), period(2022, 7)).alias("reporting_periods"),
    )
    envelopes = wrap_records(
        companies.withColumn("source", F.lit("registry")),
        ["source"],
        block_of("c_custkey", 500),
        ["c_custkey"],
        {"status": F.lit("ok"), "source": F.col("source")},
        500,
    )
    renamed = envelopes.withColumn(
        "raw_payload",
        F.regexp_replace(
            F.regexp_replace("raw_payload", '"records":\\[', '"data":['), '"record_count"', '"total_records"'
        ),
    )
    return land_payloads(renamed, "raw_payload", "companies-json")


def land_csv_companies(spark, sf_dir) -> str:
    """Suppliers as a CSV survey, one line each; some without identifier or scope 1."""
    empty = F.lit("")
    cells = [
        F.concat(F.lit("A-"), "s_suppkey"),
        F.concat(F.lit('"'), "s_name", F.lit(', Ltd"')),
        F.when(F.col("s_nationkey") < 5, "Chemicals").otherwise("Retail"),
        F.lit("Trade"),
        F.concat(F.lit("N"), "s_nationkey"),
        F.when(F.col("s_nationkey") > 20, empty).otherwise(F.lower(identifier(F.col("s_suppkey")))),
        F.lit("2022"),
        F.when(F.col("s_acctbal") < 1000, empty).otherwise(F.floor("s_acctbal").cast("string")),
        *[empty] * 3,
        F.lit("metric tons CO2e"),
        F.lit("self"),
        F.lit("B"),
        F.lit("Yes"),
    ]
    lines = given(spark, sf_dir, "supplier").select("s_suppkey", F.concat_ws(",", *cells).alias("line"))
    bounded = bounded_blocks(lines, [], block_of("s_suppkey", 500), 500)
    blocks = bounded.groupBy("block_no", "part_no").agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", "line"))).alias("lines")
    )
    payload = F.concat(F.lit(CDP_HEADER + "\n"), F.array_join(F.col("lines")["line"], "\n"))
    return land_payloads(blocks.select(payload.alias("raw_payload")), "raw_payload", "survey-csv")


def built(spark, sf_dir) -> tuple[Layers, list]:
    layers = Layers(spark, work_dir(spark, "layers"))
    csv, json = land_csv_companies(spark, sf_dir), land_json_companies(spark, sf_dir)
    # Spark's text files end in .txt; the models are told so by a wildcard.
    models = emission_models(spark, csv, json, RUN, "*.txt", "*.txt")
    layers.build_to(models, "trusted")
    return layers, models


COUNTS_SQL = """
    counts AS (
        SELECT (SELECT count(DISTINCT s_suppkey // 500) FROM supplier) AS cdp_files,
               (SELECT count(DISTINCT c_custkey // 500) FROM customer) AS nzdpu_files,
               (SELECT count(*) FROM supplier) AS cdp_rows,
               (SELECT 2 * count(*) FROM customer) AS nzdpu_rows,
               (SELECT count(*) FROM (SELECT c_custkey FROM customer
                                      UNION SELECT s_suppkey FROM supplier WHERE s_nationkey <= 20)) AS companies,
               (SELECT count(*) FROM supplier WHERE s_nationkey <= 20) AS cdp_known,
               (SELECT count(*) FROM supplier WHERE s_nationkey <= 20 AND s_acctbal < 1000) AS cdp_gaps)
"""


@query(
    "layer_states",
    f"""
    WITH {COUNTS_SQL},
    full_counts AS (
        SELECT unnest(['raw', 'raw', 'staging', 'staging', 'curated', 'curated', 'trusted']) AS layer,
               unnest(['cdp', 'nzdpu', 'cdp', 'nzdpu', 'companies', 'emissions', 'emissions']) AS table_name,
               unnest([cdp_files, nzdpu_files, cdp_rows, nzdpu_rows, companies,
                       nzdpu_rows + cdp_known, nzdpu_rows + cdp_known]) AS row_count,
               unnest([0, 0, 1, 1, 2, 2, 3]) AS depth
        FROM counts)
    SELECT state, layer, table_name,
           CAST(CASE WHEN depth <= reached THEN row_count ELSE 0 END AS BIGINT) AS row_count
    FROM full_counts CROSS JOIN (VALUES ('trusted', 3), ('staging', 1), ('raw', 0), ('empty', -1)) AS s(state, reached)
    """,
)
def layer_states(spark, sf_dir):
    """Rows per table in each state, from files to the trusted layer and back to nothing."""
    layers, models = built(spark, sf_dir)
    counts = [layers.row_counts(models).select(F.lit("trusted").alias("state"), "*")]
    for state, layer in (("staging", "staging"), ("raw", "raw"), ("empty", None)):
        layers.build_to(models, layer, rebuild=False)
        counts.append(layers.row_counts(models).select(F.lit(state).alias("state"), "*"))
    return union_all(counts)


@query(
    "build_report",
    f"""
    WITH {COUNTS_SQL}
    SELECT layer, table_name, CAST(checks AS BIGINT) AS checks, CAST(failed AS BIGINT) AS failed,
           CAST(failures AS BIGINT) AS failures
    FROM counts, LATERAL (VALUES
        ('raw', 'cdp', 8, 0, 0), ('raw', 'nzdpu', 8, 0, 0),
        ('staging', 'cdp', 6, 0, 0), ('staging', 'nzdpu', 8, 0, 0),
        ('curated', 'companies', 5, 0, 0), ('curated', 'emissions', 8, 0, 0),
        ('trusted', 'emissions', 8, CASE WHEN cdp_gaps > 0 THEN 1 ELSE 0 END, cdp_gaps)
    ) AS report(layer, table_name, checks, failed, failures)
    """,
)
def build_report(spark, sf_dir):
    """Build all layers, then run every declared test; the strict contract may be red."""
    layers, models = built(spark, sf_dir)
    return layers.test(models).groupBy("layer", "table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("failures").alias("failures"),
    )


@query(
    "trusted_emissions",
    """
    SELECT source_system, reporting_year, count(*) AS n, CAST(sum(scope_1) AS DECIMAL(28, 3)) AS scope_1_sum,
           count(DISTINCT sector) AS sectors
    FROM (
        SELECT 'nzdpu' AS source_system, 2021 AS reporting_year, abs(floor(c_acctbal)) AS scope_1, c_custkey AS k FROM customer
        UNION ALL SELECT 'nzdpu', 2022, abs(floor(c_acctbal)) + 7, c_custkey FROM customer
        UNION ALL SELECT 'cdp', 2022, CASE WHEN s_acctbal >= 1000 THEN floor(s_acctbal) END, s_suppkey
                  FROM supplier WHERE s_nationkey <= 20) AS e
    LEFT JOIN (
        SELECT c_custkey AS k, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Industrials' ELSE c_mktsegment END AS sector
        FROM customer
        UNION ALL
        SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 'Materials' ELSE 'Retail' END
        FROM supplier WHERE s_nationkey <= 20 AND s_suppkey NOT IN (SELECT c_custkey FROM customer)) AS c USING (k)
    GROUP BY 1, 2
    """,
)
def trusted_emissions(spark, sf_dir):
    """From files to the trusted table, joined with the merged companies."""
    layers, _ = built(spark, sf_dir)
    companies = layers.read("curated.companies").select("isin", "primary_sector")
    return (
        layers.read("trusted.emissions")
        .join(companies, "isin", "left")
        .groupBy("source_system", "reporting_year")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("scope_1_tco2e").cast("decimal(28,3)").alias("scope_1_sum"),
            F.count_distinct("primary_sector").alias("sectors"),
        )
    )


def land_prices(spark, sf_dir, correction: bool) -> str:
    """Parts as funds with one price each, in JSON load files; or corrected prices of some."""
    parts = given(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("P"), "p_partkey").alias("isin"),
        F.col("p_name").alias("fund_name"),
        F.date_add(F.lit("2026-01-05").cast("date"), F.col("p_size")).cast("string").alias("business_date"),
        F.col("p_retailprice").alias("nav"),
        F.lit("EUR").alias("currency"),
        F.lit("pricing").alias("source_system"),
        F.col("p_type"),
    )
    if correction:
        parts = parts.filter("p_type = 'PROMO' AND business_date >= '2026-02-01'").withColumn("nav", F.col("nav") - 1)
    envelopes = wrap_records(
        parts.drop("p_type"),
        ["source_system"],
        block_of("p_partkey"),
        ["business_date", "isin"],
        {"source_system": F.col("source_system"), "source_version": F.lit("correction" if correction else "v1")},
    )
    return land_payloads(envelopes, "raw_payload", "prices-json")


@query(
    "fund_price_history",
    """
    WITH prices AS (
        SELECT 'P' || p_partkey AS isin, p_name AS fund_name, DATE '2026-01-05' + p_size AS business_date,
               p_retailprice AS nav, p_type = 'PROMO' AND DATE '2026-01-05' + p_size >= DATE '2026-02-01' AS corrected
        FROM part)
    SELECT isin, business_date, nav, fund_name, 'run-0001' AS ingestion_id, 'v1' AS source_version,
           TIMESTAMP '2026-03-01 08:00:00' AS valid_from,
           CASE WHEN corrected THEN TIMESTAMP '2026-03-02 08:00:00' END AS valid_to
    FROM prices
    UNION ALL
    SELECT isin, business_date, nav - 1, fund_name, 'run-0002', 'correction', TIMESTAMP '2026-03-02 08:00:00', NULL
    FROM prices WHERE corrected
    """,
)
def fund_price_history(spark, sf_dir):
    """Price files to typed prices to history; the second load adds only its own rows."""
    layers = Layers(spark, work_dir(spark, "price-layers"))
    first = price_models(
        spark, land_prices(spark, sf_dir, False), Run("run-0001", "2026-03-01T06:00:00Z"), "*.txt"
    )
    layers.build_to(first, "staging")
    history, staged = layers.table("curated.price_history"), layers.table("staging.prices")
    record_prices(history, staged.read(), instant("2026-03-01T08:00:00Z"))

    seen = staged.entry()["version"]
    second = price_models(
        spark, land_prices(spark, sf_dir, True), Run("run-0002", "2026-03-02T06:00:00Z"), "*.txt"
    )
    layers.table("raw.prices").append(second[0].build())
    layers.extend(first[1])
    record_prices(history, staged.added_since(seen), instant("2026-03-02T08:00:00Z"))
    columns = ["isin", "business_date", "nav", "fund_name", "ingestion_id", "source_version", "valid_from", "valid_to"]
    return plain_time(read_history(history), "valid_from", "valid_to").select(*columns)


@query(
    "price_history_reset",
    """
    WITH n AS (SELECT count(*) AS loaded,
                      count(*) FILTER (WHERE p_type = 'PROMO' AND DATE '2026-01-05' + p_size >= DATE '2026-02-01') AS corrected
               FROM part)
    SELECT 1 AS step, loaded AS staged, loaded AS versions, 0::BIGINT AS failed_checks FROM n
    UNION ALL SELECT 2, loaded + corrected, loaded + corrected, 0 FROM n
    UNION ALL SELECT 3, 0, 0, 0
    UNION ALL SELECT 4, loaded, loaded, 0 FROM n
    """,
)
def price_history_reset(spark, sf_dir):
    """Prices loaded, corrected, emptied and loaded again: rows of staging and history, and red checks of all tables."""
    layers = Layers(spark, work_dir(spark, "price-reset-layers"))
    first, second = (
        price_models(spark, land_prices(spark, sf_dir, corrected), Run(run, at), "*.txt")
        for corrected, run, at in ((False, "run-0001", "2026-03-01T06:00:00Z"), (True, "run-0002", "2026-03-02T06:00:00Z"))
    )

    def correct() -> None:
        layers.table("raw.prices").append(second[0].build())
        layers.extend(second[1])
        layers.build(second[2])

    steps = [
        lambda: layers.build_to(first, "curated"),
        correct,
        lambda: layers.build_to(first, None),
        lambda: layers.build_to(first, "curated"),
    ]
    rows = []
    for number, step in enumerate(steps, start=1):
        step()
        counts = [layers.read(key).count() for key in ("staging.prices", "curated.prices_history")]
        rows.append((number, *counts, layers.test(first).filter("NOT success").count()))
    return spark.createDataFrame(rows, "step int, staged bigint, versions bigint, failed_checks bigint")
