from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.functions.check_digits import check_digit, has_valid_check_digit
from siltbed.operators.reshape import flatten, missing_weekdays, weights_to_100, wrap_records
from siltbed.plans.reshaping import RECORD_V2, flatten_v2, to_v2
from siltbed.registry.core import given, query
from siltbed.registry.landing import block_of

COMPANY_SQL = """
    SELECT 'C' || c_custkey AS company_id, c_name AS company_name, 'XS' || c_custkey AS isin,
           CASE WHEN c_nationkey < 20 THEN 'LEI' || c_custkey END AS lei, 'N' || c_nationkey AS country,
           c_mktsegment AS sector, reporting_year,
           CAST(floor(c_acctbal) AS BIGINT) + reporting_year AS scope_1_tco2e,
           CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS scope_2_location_tco2e,
           CAST(NULL AS BIGINT) AS scope_2_market_tco2e,
           CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(floor(c_acctbal) AS BIGINT) * 2 END AS scope_3_total_tco2e,
           'tCO2e' AS unit,
           CASE WHEN c_acctbal >= 5000 THEN 2040 END AS net_zero_year,
           'GRI' AS reporting_framework, CAST(NULL AS VARCHAR) AS verification, 'v2' AS api_version
    FROM customer CROSS JOIN (VALUES (2022), (2023)) AS years(reporting_year)
"""


def companies(spark, sf_dir):
    """Customers as companies of the older layout, two reporting periods each."""
    number = F.floor("c_acctbal")

    def measure(value, present=F.lit(True)):
        return F.when(present, F.struct(value.cast("bigint").alias("value"), F.lit("tCO2e").alias("unit")))

    def period(year):
        return F.struct(
            F.lit(year).alias("reporting_year"),
            F.lit("GRI").alias("reporting_framework"),
            F.lit(None).cast("string").alias("verification_status"),
            measure(number + year).alias("scope_1"),
            measure(number, F.col("c_acctbal") >= 0).alias("scope_2_location_based"),
            measure(number, F.lit(False)).alias("scope_2_market_based"),
            F.when(
                F.col("c_mktsegment") == "BUILDING", F.struct((number * 2).cast("bigint").alias("total"))
            ).alias("scope_3"),
            F.when(F.col("c_acctbal") >= 5000, F.struct(F.lit(2040).alias("target_year"))).alias("net_zero_target"),
        )

    return given(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.concat(F.lit("XS"), "c_custkey").alias("isin"),
        F.when(F.col("c_nationkey") < 20, F.concat(F.lit("LEI"), "c_custkey")).alias("lei"),
        F.concat(F.lit("N"), "c_nationkey").alias("country_of_incorporation"),
        F.col("c_mktsegment").alias("primary_sector"),
        F.array(period(2022), period(2023)).alias("reporting_periods"),
    )


@query("reshape_v1_to_v2", COMPANY_SQL)
def reshape_v1_to_v2(spark, sf_dir):
    return flatten_v2(to_v2(companies(spark, sf_dir)))


@query("flatten_nested_structs", COMPANY_SQL)
def flatten_nested_structs(spark, sf_dir):
    """Records of the newer layout read from JSON text, then flattened."""
    records = to_v2(companies(spark, sf_dir))
    text = records.select(F.to_json(F.struct(*records.columns)).alias("payload"))
    return flatten_v2(text.select(F.from_json("payload", RECORD_V2).alias("r")).select("r.*"))


@query(
    "flatten_generic",
    """
    SELECT o_orderkey AS order_id, o_custkey AS order_customer_id, o_orderstatus AS order_state_status,
           o_orderpriority AS order_state_priority, o_totalprice AS amount
    FROM orders
    """,
)
def flatten_generic(spark, sf_dir):
    """Every leaf of a nested record, whatever its schema."""
    nested = given(spark, sf_dir, "orders").select(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.struct(F.col("o_custkey").alias("id")).alias("customer"),
            F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias(
                "state"
            ),
        ).alias("order"),
        F.col("o_totalprice").alias("amount"),
    )
    return flatten(nested, "_")


@query(
    "reshape_to_envelope",
    """
    SELECT o_orderpriority, o_orderkey // 1000 AS block_no, 0 AS part_no, count(*) AS record_count,
           'shop' AS source_system,
           arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key,
           arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_key
    FROM orders GROUP BY 1, 2
    """,
)
def reshape_to_envelope(spark, sf_dir):
    """Orders of a priority in JSON envelopes of bounded size, sorted by date and key."""
    envelopes = wrap_records(
        given(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate", "o_totalprice"),
        ["o_orderpriority"],
        block_of("o_orderkey"),
        ["o_orderdate", "o_orderkey"],
        {"source_system": F.lit("shop"), "version": F.lit("v1")},
    )
    parsed = envelopes.withColumn(
        "_p", F.from_json("raw_payload", "source_system string, records array<struct<o_orderkey: bigint>>")
    )
    return parsed.select(
        "o_orderpriority",
        "block_no",
        "part_no",
        "record_count",
        F.col("_p.source_system"),
        F.element_at("_p.records", 1)["o_orderkey"].alias("first_key"),
        F.element_at("_p.records", -1)["o_orderkey"].alias("last_key"),
    )


@query(
    "weights_to_100",
    """
    WITH shares AS (
        SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
               CAST(round(100 * l_extendedprice / CAST(sum(CAST(l_extendedprice AS DECIMAL(28, 6)))
                    OVER (PARTITION BY l_suppkey) AS DOUBLE), 4) AS DECIMAL(10, 4)) AS share,
               row_number() OVER (PARTITION BY l_suppkey
                    ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS from_last
        FROM lineitem)
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           CAST(CASE WHEN from_last = 1 THEN 100 - sum(share) OVER (PARTITION BY l_suppkey) + share
                     ELSE share END AS DECIMAL(10, 4)) AS weight_pct
    FROM shares
    """,
)
def weights_to_100_query(spark, sf_dir):
    return weights_to_100(
        given(spark, sf_dir, "lineitem"),
        ["l_suppkey"],
        "l_extendedprice",
        ["l_orderkey", "l_linenumber", "l_partkey"],
    )


@query(
    "calendar_gaps",
    """
    WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders),
         all_days AS (SELECT unnest(range(first, last + 1, INTERVAL 1 DAY)) AS day FROM bounds),
         days AS (SELECT CAST(day AS DATE) AS day FROM all_days WHERE isodow(day) < 6),
         keys AS (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders),
         seen AS (SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT o_orderpriority, o_orderstatus, day AS missing_day
    FROM keys CROSS JOIN days ANTI JOIN seen USING (o_orderpriority, o_orderstatus, day)
    """,
)
def calendar_gaps(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    first, last = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    start, end = F.lit(first), F.lit(last)
    return missing_weekdays(
        orders, ["o_orderpriority", "o_orderstatus"], "o_orderdate", start, end
    )


@query(
    "isin_checksum",
    """
    WITH codes AS (
        SELECT c_custkey, 'US' || lpad(c_custkey::VARCHAR, 9, '0') AS stem FROM customer
        UNION ALL
        SELECT c_custkey, 'DE' || upper(substr(c_mktsegment, 1, 3)) || lpad(c_custkey::VARCHAR, 6, '0') FROM customer),
    digits AS (
        SELECT *, list_reverse(string_split(array_to_string(list_transform(string_split(stem, ''),
               lambda ch: CASE WHEN ch BETWEEN 'A' AND 'Z' THEN (ascii(ch) - 55)::VARCHAR ELSE ch END), ''), '')) AS d
        FROM codes),
    sums AS (
        SELECT *, list_sum(list_transform(d, lambda ch, i: CASE
               WHEN i % 2 = 0 THEN ch::INTEGER WHEN ch::INTEGER > 4 THEN 2 * ch::INTEGER - 9
               ELSE 2 * ch::INTEGER END)) AS s
        FROM digits)
    SELECT c_custkey, stem, CAST((10 - s % 10) % 10 AS INTEGER) AS check_digit, true AS valid,
           false AS valid_if_wrong
    FROM sums
    """,
)
def isin_checksum(spark, sf_dir):
    """Check digits of generated codes, and their validation right and wrong."""
    customer = given(spark, sf_dir, "customer")
    stems = customer.select(
        "c_custkey", F.concat(F.lit("US"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("stem")
    ).unionAll(
        customer.select(
            "c_custkey",
            F.concat(
                F.lit("DE"),
                F.upper(F.substring("c_mktsegment", 1, 3)),
                F.lpad(F.col("c_custkey").cast("string"), 6, "0"),
            ),
        )
    )
    digits = stems.withColumn("check_digit", check_digit(F.col("stem")))
    return digits.select(
        "*",
        has_valid_check_digit(F.concat("stem", "check_digit")).alias("valid"),
        has_valid_check_digit(F.concat("stem", (F.col("check_digit") + 1) % 10)).alias("valid_if_wrong"),
    )
