from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.operators.merge import union_all
from siltbed.operators.profile import (
    column_profile,
    completeness,
    group_averages,
    group_counts,
    numeric_range,
    preview,
    row_counts,
    top,
)
from siltbed.operators.profile_states import DISTINCT_ERROR, profile_of, profile_state, unite
from siltbed.registry.core import TABLES, given, query
from siltbed.session import work_dir


@query(
    "profile_completeness",
    """
    SELECT count(*) AS row_count, count(*) FILTER (WHERE l_returnflag = 'N') AS l_returnflag_nulls,
           count(*) FILTER (WHERE l_shipdate IS NULL) AS l_shipdate_nulls,
           count(*) FILTER (WHERE l_discount IS NULL) AS l_discount_nulls,
           count(DISTINCT nullif(l_returnflag, 'N')) AS l_returnflag_distinct
    FROM lineitem
    """,
)
def profile_completeness(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return completeness(lines, ["l_returnflag", "l_shipdate", "l_discount"], "l_returnflag")


@query(
    "profile_numeric",
    """
    SELECT min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value,
           count(DISTINCT l_extendedprice) AS distinct_values FROM lineitem
    """,
)
def profile_numeric(spark, sf_dir):
    return numeric_range(given(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(
    "group_count",
    "SELECT nullif(event_type, 'view') AS event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2",
)
def group_count(spark, sf_dir):
    events = given(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    return group_counts(events, ["event_type", "user_id"])


@query(
    "group_avg_rounded",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_extendedprice), 2) AS avg_l_extendedprice,
           round(avg(l_quantity), 2) AS avg_l_quantity
    FROM lineitem GROUP BY 1, 2
    """,
)
def group_avg_rounded(spark, sf_dir):
    return group_averages(
        given(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice", "l_quantity"]
    )


@query(
    "topn_ordered",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 100
    """,
)
def topn_ordered(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return top(orders, [F.desc("o_totalprice"), F.asc("o_orderdate"), F.asc("o_orderkey")], 100)


@query(
    "payload_preview_union",
    """
    SELECT 'documents' AS table_name, length(text) AS payload_chars, substring(text, 1, 120) AS payload_start
    FROM documents
    UNION ALL SELECT 'pages', length(html), substring(html, 1, 120) FROM pages
    UNION ALL SELECT 'conversations', length(text), substring(text, 1, 120) FROM conversations
    """,
)
def payload_preview_union(spark, sf_dir):
    return union_all(
        [
            preview(given(spark, sf_dir, table), table, payload)
            for table, payload in (("documents", "text"), ("pages", "html"), ("conversations", "text"))
        ]
    )


@query(
    "layer_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def layer_row_counts(spark, sf_dir):
    return row_counts({name: given(spark, sf_dir, name) for name in TABLES})


PROFILED = {
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
}


@query(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{data_type}' AS data_type,"
        f" count(*) AS row_count, count(*) - count({column}) AS null_count,"
        f" count(DISTINCT {column}) AS distinct_count, CAST(min({column}) AS VARCHAR) AS min_value,"
        f" CAST(max({column}) AS VARCHAR) AS max_value FROM {table}"
        for table, columns in PROFILED.items()
        for column, data_type in columns.items()
    ),
)
def column_profile_query(spark, sf_dir):
    return union_all([column_profile(table, given(spark, sf_dir, table)) for table in PROFILED])


UNITED_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")


def _united_sql(column: str) -> str:
    number, text = (f"min({column})", f"max({column})"), ("NULL", "NULL")
    if column not in _NUMBERS:
        number, text = text, tuple(f"CAST({f} AS VARCHAR)" for f in number)
    return (
        f"SELECT '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS null_count,"
        f" CAST({number[0]} AS DOUBLE) AS least_number, CAST({number[1]} AS DOUBLE) AS largest_number,"
        f" CAST({text[0]} AS VARCHAR) AS least_text, CAST({text[1]} AS VARCHAR) AS largest_text, true AS distinct_is_close"
        f" FROM (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)"
    )


@query("profile_united", " UNION ALL ".join(map(_united_sql, UNITED_COLUMNS)))
def profile_united(spark, sf_dir):
    """Profiles of four loads of orders, stored load by load and united without reading orders again."""
    orders = given(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    folder = work_dir(spark, "profile-states")
    for load in range(4):
        of_load = orders.filter(F.pmod(F.coalesce("o_orderkey", F.lit(0)), F.lit(4)) == load)
        profile_state(of_load, str(load), UNITED_COLUMNS).write.mode("append").parquet(folder)
    found = profile_of(unite(spark.read.parquet(folder)))
    exact = union_all(
        [orders.agg(F.count_distinct(c).alias("exact")).select(F.lit(c).alias("column_name"), "exact") for c in UNITED_COLUMNS]
    )
    close = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 4 * DISTINCT_ERROR * F.col("exact") + 1
    return found.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "least_number", "largest_number", "least_text", "largest_text",
        close.alias("distinct_is_close"),
    )
