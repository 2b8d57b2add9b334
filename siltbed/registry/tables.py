from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.operators.merge import union_all
from siltbed.operators.range_digests import compare_by_ranges, range_digests
from siltbed.plans.layers import Layers
from siltbed.registry.core import given, query
from siltbed.session import work_dir
from siltbed.sources.layout import write_interleaved
from siltbed.sources.tables import VersionedTable, compare_versions, file_stats, partition_stats

def new_table(spark, label: str) -> VersionedTable:
    return VersionedTable(spark, work_dir(spark, label))


def orders_by_year(spark, sf_dir) -> VersionedTable:
    """One append per order year, as loads that follow each other; orders without a date come with the first."""
    table = new_table(spark, "orders-by-year")
    orders = given(spark, sf_dir, "orders")
    first, last = orders.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    for year in range(first, last + 1):
        # A range of the column itself is pushed to the scan, a function of it is not.
        start, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
        loaded = (F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)
        table.append(orders.filter(loaded | F.col("o_orderdate").isNull() if year == first else loaded))
    return table


@query(
    "time_travel_counts",
    """
    WITH bounds AS (SELECT min(year(o_orderdate)) AS first, max(year(o_orderdate)) AS last FROM orders),
         years AS (SELECT unnest(range(first, last + 1)) AS y, first FROM bounds)
    SELECT CAST(y - first + 1 AS BIGINT) AS version, count(o_orderkey) AS row_count, max(o_orderdate) AS newest
    FROM years JOIN orders ON coalesce(year(o_orderdate), first) <= y GROUP BY y, first
    """,
)
def time_travel_counts(spark, sf_dir):
    table = orders_by_year(spark, sf_dir)
    return union_all(
        [
            table.read(version)
            .agg(F.count(F.lit(1)).alias("row_count"), F.max("o_orderdate").alias("newest"))
            .select(F.lit(version).cast("bigint").alias("version"), "*")
            for version in range(1, table.entry()["version"] + 1)
        ]
    )


@query(
    "snapshot_log",
    """
    WITH bounds AS (SELECT min(year(o_orderdate)) AS first, max(year(o_orderdate)) AS last FROM orders),
         years AS (SELECT unnest(range(first, last + 1)) AS y, first FROM bounds),
         loads AS (SELECT y, first, count(o_orderkey) AS n FROM years
                   LEFT JOIN orders ON coalesce(year(o_orderdate), first) = y GROUP BY y, first)
    SELECT CAST(y - first + 1 AS BIGINT) AS version,
           CASE WHEN y > first THEN CAST(y - first AS BIGINT) END AS parent_version,
           'append' AS operation, n AS added_records, CAST(sum(n) OVER (ORDER BY y) AS BIGINT) AS total_records,
           count(*) OVER () AS version_count
    FROM loads
    """,
)
def snapshot_log(spark, sf_dir):
    history = orders_by_year(spark, sf_dir).history()
    version_count = history.groupBy().agg(F.count(F.lit(1))).first()[0]
    return history.drop("committed_at", "added_data_files").withColumn(
        "version_count", F.lit(version_count).cast("bigint")
    )


@query(
    "version_compare",
    """
    SELECT 'removed' AS change, CAST(1 AS BIGINT) AS times, c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT 'added', 2, c_custkey, c_acctbal + 1 FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def version_compare(spark, sf_dir):
    """Rows that differ between the first version and the one after a delete and two appends."""
    customer = given(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    raised = customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    table = new_table(spark, "customer-versions")
    first = table.append(customer)
    table.delete_where(F.col("c_acctbal") < 0)
    table.append(raised)
    last = table.append(raised)
    return compare_versions(table, first, last).drop("c_mktsegment")


@query(
    "compare_by_ranges",
    """
    WITH revised AS (
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderkey % 1000 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE coalesce(o_orderkey % 1500 <> 7, true)),
         sides AS (
        SELECT o_orderkey, o_orderstatus, o_totalprice, -1 AS sign FROM orders
        UNION ALL SELECT *, 1 FROM revised)
    SELECT CASE WHEN sum(sign) > 0 THEN 'added' ELSE 'removed' END AS change, CAST(abs(sum(sign)) AS BIGINT) AS times,
           o_orderkey, o_orderstatus, o_totalprice
    FROM sides GROUP BY o_orderkey, o_orderstatus, o_totalprice HAVING sum(sign) <> 0
    """,
)
def compare_by_ranges_query(spark, sf_dir):
    """Orders before and after a revision that few of them change, by digests stored with either state."""
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    raised = F.when(F.col("o_orderkey") % 1000 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    revised = orders.filter(F.coalesce(F.col("o_orderkey") % 1500 != 7, F.lit(True))).withColumn("o_totalprice", raised)
    folder = work_dir(spark, "order-digests")
    digests = []
    for name, rows in (("before", orders), ("after", revised)):
        range_digests(rows, ["o_orderkey"]).write.parquet(f"{folder}/{name}")
        digests.append(spark.read.parquet(f"{folder}/{name}"))
    return compare_by_ranges(orders, revised, ["o_orderkey"], digests=tuple(digests))


@query(
    "interleaved_layout",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
    WHERE l_partkey BETWEEN 10 AND 40 OR (l_shipdate >= TIMESTAMP '1995-03-01' AND l_shipdate < TIMESTAMP '1995-05-01')
    """,
)
def interleaved_layout(spark, sf_dir):
    """Lines laid out by part and ship date at once, read by a range of either column."""
    folder = work_dir(spark, "lines-interleaved")
    lines = given(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    write_interleaved(lines, ["l_partkey", "l_shipdate"], folder)
    stored = spark.read.parquet(folder)
    by_part = F.col("l_partkey").between(10, 40)
    start, end = (F.lit(day).cast("timestamp_ntz") for day in ("1995-03-01", "1995-05-01"))
    by_date = (F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end)
    # Two scans, each pruned by its own column, instead of one that no column prunes.
    return stored.filter(by_part).unionByName(stored.filter(by_date & ~F.coalesce(by_part, F.lit(False))))


@query(
    "schema_evolution_append",
    """
    SELECT p_partkey, p_name, CASE WHEN p_retailprice >= 950 THEN p_size END AS p_size,
           CAST(NULL AS DOUBLE) AS p_weight
    FROM part
    """,
)
def schema_evolution_append(spark, sf_dir):
    """Columns added between two loads; rows of the first load have NULL in them."""
    part = given(spark, sf_dir, "part")
    table = new_table(spark, "part-evolving")
    table.append(part.filter("NOT coalesce(p_retailprice >= 950, false)").select("p_partkey", "p_name"))
    table.add_columns({"p_size": "int", "p_weight": "double"})
    table.add_columns({"p_size": "int"})
    table.append(part.filter("p_retailprice >= 950").select("p_size", "p_name", "p_partkey"))
    return table.read()


@query(
    "schema_rename",
    "SELECT p_partkey, p_name AS product_name, p_retailprice AS price FROM part",
)
def schema_rename(spark, sf_dir):
    """A column renamed between two loads, without rewriting the first."""
    part = given(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("price"))
    table = new_table(spark, "part-renamed")
    table.append(part.filter("NOT coalesce(price >= 950, false)"))
    table.rename_column("p_name", "product_name")
    table.append(part.filter("price >= 950").withColumnRenamed("p_name", "product_name"))
    return table.read()


@query(
    "file_stats",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS record_count, min(o_totalprice) AS o_totalprice_min,
           max(o_totalprice) AS o_totalprice_max, count(*) FILTER (WHERE o_orderstatus = 'P') AS o_orderstatus_nulls
    FROM orders GROUP BY 1
    """,
)
def file_stats_query(spark, sf_dir):
    """Statistics of every data file, here summed up per folder, which is stable."""
    table = new_table(spark, "orders-files")
    orders = given(spark, sf_dir, "orders").select(
        "o_totalprice",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.year("o_orderdate").alias("order_year"),
    )
    table.append(orders, partition_by=["order_year"])
    per_file = file_stats(
        table.read(), ["o_totalprice", "o_orderstatus"], [F.col("order_year"), F.col("_metadata.file_path")]
    )
    return per_file.groupBy("order_year").agg(
        F.sum("record_count").alias("record_count"),
        F.min("o_totalprice_min").alias("o_totalprice_min"),
        F.max("o_totalprice_max").alias("o_totalprice_max"),
        F.sum("o_orderstatus_nulls").alias("o_orderstatus_nulls"),
    )


@query(
    "partition_stats",
    "SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS record_count, true AS has_files FROM lineitem GROUP BY 1",
)
def partition_stats_query(spark, sf_dir):
    """Rows and files of every partition of a table partitioned by month, by day inside."""
    table = new_table(spark, "lines-by-month")
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.to_date("l_shipdate").alias("ship_day"), F.year("l_shipdate").alias("ship_year")
    )
    table.append(lines, partition_by=["ship_year"])
    stats = partition_stats(table.read(), ["ship_year", "ship_day"])
    return stats.select("ship_day", "record_count", (F.col("file_count") > 0).alias("has_files"))


@query(
    "table_roundtrip",
    """
    SELECT CAST(1 AS BIGINT) AS version, count(*) AS row_count, min(s_name) AS first_name FROM supplier
    UNION ALL SELECT 2, count(*) FILTER (WHERE s_acctbal > 0), min(s_name) FILTER (WHERE s_acctbal > 0) FROM supplier
    UNION ALL SELECT 3, 0, NULL
    UNION ALL SELECT 4, count(*), min(s_name) FROM supplier
    """,
)
def table_roundtrip(spark, sf_dir):
    """Create, replace, drop and recreate, append; every version stays readable."""
    supplier = given(spark, sf_dir, "supplier")
    table = new_table(spark, "supplier-roundtrip")
    table.append(supplier)
    table.overwrite(table.read().filter("s_acctbal > 0"))
    table.recreate(supplier.select("s_suppkey", "s_name").schema)
    table.append(supplier.select("s_suppkey", "s_name"))
    return union_all(
        [
            table.read(version)
            .agg(F.count(F.lit(1)).alias("row_count"), F.min("s_name").alias("first_name"))
            .select(F.lit(version).cast("bigint").alias("version"), "*")
            for version in range(1, 5)
        ]
    )


@query(
    "delete_where",
    """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders
    WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F' AND o_totalprice > 1000, false)
    """,
)
def delete_where(spark, sf_dir):
    """Rows for which the predicate is NULL stay."""
    table = new_table(spark, "orders-delete")
    table.append(
        given(spark, sf_dir, "orders").select(
            "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice"
        )
    )
    table.delete_where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000))
    return table.read()


@query(
    "table_inventory",
    """
    SELECT 'raw.orders' AS table_name, 2 * count(*) AS row_count, CAST(2 AS BIGINT) AS version_count,
           true AS has_size FROM orders
    UNION ALL SELECT 'raw.customer', count(*), 1, true FROM customer
    """,
)
def table_inventory(spark, sf_dir):
    layers = Layers(spark, work_dir(spark, "inventory"))
    for _ in range(2):
        layers.table("raw.orders").append(given(spark, sf_dir, "orders"))
    layers.table("raw.customer").append(given(spark, sf_dir, "customer"))
    inventory = layers.inventory(["raw.orders", "raw.customer"])
    return inventory.select(
        "table_name",
        "row_count",
        "version_count",
        ((F.col("size_kb") > 0) & (F.col("file_count") > 0)).alias("has_size"),
    )
