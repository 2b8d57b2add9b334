from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.functions.text import blank_to_null, harmonize_sector, standardize_code, to_decimal, trimmed, typed
from siltbed.operators.identify import entity_records, identify
from siltbed.operators.merge import compare_sources, latest_per_key, merge_entities, union_labelled
from siltbed.registry.core import given, query


@query(
    "union_sources",
    """
    SELECT 'ENT' || lpad(c_custkey::VARCHAR, 12, '0') AS code, 'customer' AS source_system,
           CAST(c_acctbal AS DECIMAL(18, 3)) AS balance FROM customer
    UNION ALL
    SELECT 'ENT' || lpad(s_suppkey::VARCHAR, 12, '0'), 'supplier', CAST(s_acctbal AS DECIMAL(18, 3)) FROM supplier
    """,
)
def union_sources(spark, sf_dir):
    """Two labelled sources with harmonized codes and fixed-point amounts."""

    def accounts(table, key, balance):
        code = F.concat(F.lit(" \tent"), F.lpad(F.col(key).cast("string"), 12, "0"), F.lit("\r"))
        rows = given(spark, sf_dir, table).select(standardize_code(code).alias("code"), F.col(balance).alias("balance"))
        return rows.filter(F.col("code").isNotNull()).withColumn("balance", to_decimal(F.col("balance")))

    return union_labelled(
        {
            "customer": accounts("customer", "c_custkey", "c_acctbal"),
            "supplier": accounts("supplier", "s_suppkey", "s_acctbal"),
        }
    ).select("code", "source_system", "balance")


@query(
    "scalar_clean",
    """
    SELECT c_custkey, upper(c_name) AS code,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS blank_is_null,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Industrials' WHEN 'BUILDING' THEN 'Financials'
                             WHEN 'FURNITURE' THEN 'Materials' WHEN 'HOUSEHOLD' THEN 'Household' END AS sector,
           CAST(c_acctbal AS DECIMAL(18, 3)) AS balance,
           CASE WHEN c_nationkey > 5 THEN c_nationkey END AS lenient_int, CAST(NULL AS VARCHAR) AS lei
    FROM customer
    """,
)
def scalar_clean(spark, sf_dir):
    segment = F.col("c_mktsegment")
    spelled = (
        F.when(segment == "AUTOMOBILE", F.lit(" automobile\t"))
        .when(segment == "BUILDING", F.lit("Banking"))
        .when(segment == "FURNITURE", F.lit("chemicals\r"))
        .when(segment == "HOUSEHOLD", F.lit("  Household "))
    )
    number = F.when(F.col("c_nationkey") > 5, F.col("c_nationkey").cast("string")).otherwise("n/a")
    return given(spark, sf_dir, "customer").select(
        "c_custkey",
        standardize_code(F.concat(F.lit("  "), F.lower("c_name"), F.lit("\n"))).alias("code"),
        blank_to_null(trimmed(F.when(F.col("c_acctbal") < 0, F.lit(" \t ")).otherwise(segment))).alias(
            "blank_is_null"
        ),
        harmonize_sector(spelled).alias("sector"),
        to_decimal(F.col("c_acctbal")).alias("balance"),
        typed(number, "int", strict=False).alias("lenient_int"),
        F.lit(None).cast("string").alias("lei"),
    )


@query(
    "entity_merge_priority",
    """
    WITH entities AS (
        SELECT o_custkey AS entity, o_orderstatus AS contact, CAST(NULL AS INTEGER) AS country,
               o_orderpriority AS sector, 'orders' AS preferred_source, 0 AS prio FROM orders
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Industrials' ELSE c_mktsegment END, 'customer', 1
        FROM customer)
    SELECT entity, contact, country, sector, preferred_source
    FROM entities
    QUALIFY row_number() OVER (PARTITION BY entity
        ORDER BY prio, contact NULLS LAST, country NULLS LAST, sector NULLS LAST) = 1
    """,
)
def entity_merge_priority(spark, sf_dir):
    """One record per customer from two sources, orders before master data."""
    seen = given(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity"),
        F.col("o_orderstatus").alias("contact"),
        F.lit(None).cast("int").alias("country"),
        F.col("o_orderpriority").alias("sector"),
    )
    master = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"),
        F.col("c_name").alias("contact"),
        F.col("c_nationkey").alias("country"),
        harmonize_sector(F.col("c_mktsegment")).alias("sector"),
    )
    return merge_entities({"orders": seen, "customer": master}, "entity")


@query(
    "entities_by_identifiers",
    """
    WITH ids AS (
        SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, 'master' AS preferred_source FROM customer
        UNION ALL
        SELECT o_custkey, min(o_orderpriority), NULL, 'orders' FROM orders GROUP BY o_custkey),
         present AS (SELECT DISTINCT k FROM ids),
         marked AS (SELECT k, CASE WHEN lag(k) OVER (ORDER BY k) = k - 1 AND k % 40 <> 0 THEN 0 ELSE 1 END AS starts FROM present),
         islands AS (SELECT k, sum(starts) OVER (ORDER BY k) AS island FROM marked)
    SELECT min(k) OVER (PARTITION BY island) AS first_key, count(*) OVER (PARTITION BY island) AS records,
           name, nation, preferred_source
    FROM ids JOIN islands USING (k)
    QUALIFY row_number() OVER (PARTITION BY island ORDER BY preferred_source, k) = 1
    """,
)
def entities_by_identifiers(spark, sf_dir):
    """Records of two sources that share identifiers in chains of forty: one entity per chain, master data first."""

    def known_by(rows, key):
        # Codes of either kind are shared by two neighbours each, which makes chains; every fortieth link is left out.
        isin = F.concat(F.lit("I"), F.floor(key / 2))
        lei = F.when(key % 40 != 0, F.concat(F.lit("L"), F.floor((key + 1) / 2)))
        return rows.withColumns({"isin": isin, "lei": lei})

    master = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    seen = given(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderpriority").alias("name"))
    records = union_labelled(
        {"master": master, "orders": seen.withColumn("nation", F.lit(None).cast("int")).select(*master.columns)},
        "preferred_source",
    )
    records = known_by(records, F.col("k")).withColumn("own", F.concat(F.lit("K"), "k"))
    identified = identify(records, ["isin", "lei", "own"])
    best = entity_records(identified, "preferred_source", ["master", "orders"], ["k"])
    sizes = identified.groupBy("entity").agg(F.min("k").alias("first_key"), F.count(F.lit(1)).alias("records"))
    return best.join(sizes, "entity").select("first_key", "records", "name", "nation", "preferred_source")


@query(
    "distinct_entities",
    "SELECT DISTINCT c_nationkey, c_mktsegment, c_acctbal >= 0 AS in_credit FROM customer",
)
def distinct_entities(spark, sf_dir):
    return (
        given(spark, sf_dir, "customer")
        .select("c_nationkey", "c_mktsegment", (F.col("c_acctbal") >= 0).alias("in_credit"))
        .distinct()
    )


@query(
    "cross_source_conflict",
    """
    WITH billed AS (
        SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS v
        FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, o_totalprice AS left_value, v AS right_value,
           abs(o_totalprice - v) AS abs_difference,
           CASE WHEN v <> 0 THEN 100 * abs(o_totalprice - v) / abs(v) END AS pct_difference
    FROM orders JOIN billed ON o_orderkey = l_orderkey
    """,
)
def cross_source_conflict(spark, sf_dir):
    """Order totals as the order states them and as its lines add up."""
    stated = given(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"))
    billed = (
        given(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"))
    )
    both = union_labelled({"orders": stated, "lines": billed})
    return compare_sources(both, ["o_orderkey"], "source_system", "amount", "orders", "lines")


@query(
    "latest_per_key",
    """
    SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
    """,
)
def latest_per_key_query(spark, sf_dir):
    events = given(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"])
