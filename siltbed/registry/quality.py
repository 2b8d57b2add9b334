from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.functions.json_fields import text_schema
from siltbed.operators import expectations as expect
from siltbed.operators.checks import AcceptedValues, NotNull, Relationship, Unique, run_checks
from siltbed.operators.expectations import statistics, validate
from siltbed.operators.known_keys import known_keys, remember_keys, uniqueness_of_load
from siltbed.operators.merge import union_all
from siltbed.operators.verify import summarize, verify_contents, verify_counts, verify_csv, verify_json
from siltbed.plans.gate import promote
from siltbed.registry.core import given, payload_rows, query
from siltbed.registry.ingest import DOCUMENTS, RUN, as_payloads, documents_as_payloads
from siltbed.session import work_dir
from siltbed.sources.files import Run, Source, ingest, label_payloads
from siltbed.sources.tables import VersionedTable


def check_sql(check: str, column: str, evaluated: str, failures: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", e AS evaluated, f AS failures, f = 0 AS success"
        f" FROM (SELECT CAST(({evaluated}) AS BIGINT) AS e, CAST(({failures}) AS BIGINT) AS f)"
    )


@query(
    "test_not_null",
    check_sql("not_null", "l_orderkey", "SELECT count(*) FROM lineitem", "SELECT 0")
    + " UNION ALL "
    + check_sql(
        "not_null",
        "l_returnflag",
        "SELECT count(*) FROM lineitem",
        "SELECT count(*) FROM lineitem WHERE l_returnflag = 'N'",
    )
    + " UNION ALL "
    + check_sql(
        "not_null",
        "l_shipdate",
        "SELECT count(*) FROM lineitem",
        "SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL",
    ),
)
def test_not_null(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return run_checks(lines, [NotNull("l_orderkey"), NotNull("l_returnflag"), NotNull("l_shipdate")])


@query(
    "test_unique",
    check_sql(
        "unique", "o_orderkey", "SELECT count(*) FROM orders", "SELECT count(*) - count(DISTINCT o_orderkey) FROM orders"
    )
    + " UNION ALL "
    + check_sql(
        "unique",
        "o_custkey",
        "SELECT count(*) FROM orders",
        "SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
    ),
)
def test_unique(spark, sf_dir):
    return run_checks(given(spark, sf_dir, "orders"), [Unique(("o_orderkey",)), Unique(("o_custkey",))])


@query(
    "test_accepted_values",
    check_sql(
        "accepted_values",
        "o_orderpriority",
        "SELECT count(*) FROM orders",
        "SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
    )
    + " UNION ALL "
    + check_sql(
        "accepted_values",
        "o_orderstatus",
        "SELECT count(*) FROM orders WHERE o_orderstatus <> 'P'",
        "SELECT 0",
    ),
)
def test_accepted_values(spark, sf_dir):
    """Distinct unexpected values; NULL passes."""
    orders = given(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return run_checks(
        orders,
        [AcceptedValues("o_orderpriority", ("1-URGENT", "2-HIGH")), AcceptedValues("o_orderstatus", ("O", "F"))],
    )


@query(
    "test_relationships",
    check_sql(
        "relationships",
        "doc_id",
        "SELECT count(*) FROM documents",
        "SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    )
    + " UNION ALL "
    + check_sql(
        "relationships",
        "doc_id",
        "SELECT count(*) FROM documents",
        "SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages)",
    ),
)
def test_relationships(spark, sf_dir):
    """Two parents of one column are two checks."""
    return run_checks(
        given(spark, sf_dir, "documents"),
        [Relationship("doc_id", "labels", "doc_id"), Relationship("doc_id", "pages", "page_id")],
        {"labels": given(spark, sf_dir, "labels"), "pages": given(spark, sf_dir, "pages")},
    )


@query(
    "test_unique_combination",
    check_sql(
        "unique_combination",
        "l_orderkey, l_linenumber",
        "SELECT count(*) FROM lineitem",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    )
    + " UNION ALL "
    + check_sql(
        "unique_combination",
        "l_orderkey, l_partkey, l_suppkey",
        "SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem WHERE l_returnflag = 'R'"
        " GROUP BY l_orderkey, l_partkey, l_suppkey HAVING count(*) > 1)",
    )
    + " UNION ALL "
    + check_sql(
        "unique_combination",
        "l_orderkey, l_partkey, l_suppkey",
        "SELECT count(*) FROM lineitem",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem"
        " GROUP BY l_orderkey, l_partkey, l_suppkey HAVING count(*) > 1)",
    ),
)
def test_unique_combination(spark, sf_dir):
    """One combination with and without a condition is two checks."""
    return run_checks(
        given(spark, sf_dir, "lineitem"),
        [
            Unique(("l_orderkey", "l_linenumber")),
            Unique(("l_orderkey", "l_partkey", "l_suppkey")),
            Unique(("l_orderkey", "l_partkey", "l_suppkey"), where="l_returnflag = 'R'"),
        ],
    )


def expectation_sql(name: str, column: str, evaluated: str, unexpected: str, success: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS expectation, '{column}' AS \"column\", e AS evaluated, u AS unexpected,"
        f" CASE WHEN e > 0 THEN round(100 * CAST(u AS DOUBLE) / e, 4) ELSE 0 END AS unexpected_pct,"
        f" {success} AS success"
        f" FROM (SELECT CAST({evaluated} AS BIGINT) AS e, CAST({unexpected} AS BIGINT) AS u FROM {source})"
    )


LINE_SUITE = [
    expect.RowCountBetween(1, 10_000_000_000_000),
    expect.NotNull("l_orderkey"),
    expect.LengthEquals("l_returnflag", 1),
    expect.InSet("l_linestatus", ("O", "F")),
    expect.Between("l_extendedprice", 0, 95_000, mostly=0.95),
    expect.CompoundUnique(("l_orderkey", "l_linenumber")),
]
LINE_SUITE_SQL = " UNION ALL ".join(
    [
        expectation_sql("row_count_between", "", "count(*)", "0", "e >= 1", "lineitem"),
        expectation_sql("not_null", "l_orderkey", "count(*)", "count(*) - count(l_orderkey)", "u = 0", "lineitem"),
        expectation_sql(
            "length_equals", "l_returnflag", "count(l_returnflag)", "count_if(length(l_returnflag) <> 1)", "u = 0", "lineitem"
        ),
        expectation_sql(
            "in_set", "l_linestatus", "count(*)", "count_if(l_linestatus NOT IN ('O', 'F'))", "u = 0", "lineitem"
        ),
        expectation_sql(
            "between",
            "l_extendedprice",
            "count(*)",
            "count_if(l_extendedprice NOT BETWEEN 0 AND 95000)",
            "(e - u) / e >= 0.95",
            "lineitem",
        ),
        expectation_sql(
            "compound_unique",
            "l_orderkey, l_linenumber",
            "sum(k)",
            "coalesce(sum(k) FILTER (WHERE k > 1), 0)",
            "u = 0",
            "(SELECT count(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber)",
        ),
    ]
)


@query("expectation_suite", LINE_SUITE_SQL)
def expectation_suite(spark, sf_dir):
    return validate(given(spark, sf_dir, "lineitem"), LINE_SUITE)


@query(
    "expectation_statistics",
    f"""
    SELECT count(*) AS evaluated_expectations, CAST(count_if(success) AS BIGINT) AS successful_expectations,
           CAST(count_if(NOT success) AS BIGINT) AS unsuccessful_expectations,
           round(100 * count_if(success)::DOUBLE / count(*), 2) AS success_percent, bool_and(success) AS success
    FROM ({LINE_SUITE_SQL})
    """,
)
def expectation_statistics(spark, sf_dir):
    return statistics(validate(given(spark, sf_dir, "lineitem"), LINE_SUITE))


@query(
    "expectation_mostly",
    " UNION ALL ".join(
        [
            expectation_sql(
                "between_strict",
                "l_quantity",
                "count(nullif(l_quantity, 25))",
                "count_if(nullif(l_quantity, 25) NOT BETWEEN 1 AND 46)",
                "(e - u) / e >= 0.95",
                "lineitem",
            ),
            expectation_sql(
                "between_lenient",
                "l_quantity",
                "count(nullif(l_quantity, 25))",
                "count_if(nullif(l_quantity, 25) NOT BETWEEN 1 AND 46)",
                "(e - u) / e >= 0.9",
                "lineitem",
            ),
            expectation_sql("in_set", "nothing", "0", "0", "true", "(SELECT 1)"),
        ]
    ),
)
def expectation_mostly(spark, sf_dir):
    """Shares count non-NULL values only; a column without values is green."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.nullif("l_quantity", F.lit(25.0)).alias("l_quantity"), F.lit(None).cast("string").alias("nothing")
    )
    return validate(
        lines,
        [
            expect.Between("l_quantity", 1, 46, mostly=0.95, name="between_strict"),
            expect.Between("l_quantity", 1, 46, mostly=0.9, name="between_lenient"),
            expect.InSet("nothing", ("a",)),
        ],
    )


ORDER_SUITE = [
    expect.RowCountBetween(1, 10_000_000_000_000),
    expect.NotNull("o_orderkey"),
    expect.InSet("o_orderstatus", ("O", "F", "P")),
    expect.Between("o_totalprice", 0, 1_000_000, mostly=0.95),
    expect.CompoundUnique(("o_orderkey", "o_orderstatus")),
]


def _gate_tables(spark):
    folder = work_dir(spark, "gate")
    return tuple(VersionedTable(spark, f"{folder}/{name}") for name in ("curated", "trusted", "results"))


@query(
    "gate_promote",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice, 'promoted' AS outcome, 0 AS exit_code,
           CAST(5 AS BIGINT) AS stored_results
    FROM orders
    """,
)
def gate_promote(spark, sf_dir):
    """Refresh, validate, and release; results are kept under the run's name."""
    curated, trusted, results = _gate_tables(spark)
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    verdict = promote(
        curated,
        trusted,
        ORDER_SUITE,
        refresh=lambda: curated.overwrite(orders),
        store=results,
        run_name="2026-01-05 orders",
    )
    return trusted.read().select(
        "*",
        F.lit(verdict.outcome).alias("outcome"),
        F.lit(verdict.exit_code).alias("exit_code"),
        F.lit(int(results.entry()["summary"]["total-records"])).cast("bigint").alias("stored_results"),
    )


@query(
    "gate_red_path",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice, 'blocked' AS outcome, 1 AS exit_code,
           CAST(1 AS BIGINT) AS trusted_version
    FROM orders
    """,
)
def gate_red_path(spark, sf_dir):
    """Outliers come into the source after a release: blocked, the target stays as it was."""
    curated, trusted, _ = _gate_tables(spark)
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    promote(curated, trusted, ORDER_SUITE, refresh=lambda: curated.overwrite(orders))
    outliers = orders.filter("o_totalprice > 250000").withColumn("o_totalprice", F.lit(500_000_000.0))
    curated.append(outliers)
    verdict = promote(curated, trusted, ORDER_SUITE)
    return trusted.read().select(
        "*",
        F.lit(verdict.outcome).alias("outcome"),
        F.lit(verdict.exit_code).alias("exit_code"),
        F.lit(trusted.entry()["version"]).cast("bigint").alias("trusted_version"),
    )


@query(
    "passthrough_contract",
    check_sql("not_null", "c_custkey", "SELECT count(*) FROM customer", "SELECT 0")
    + " UNION ALL "
    + check_sql(
        "not_null", "balance", "SELECT count(*) FROM customer", "SELECT count(*) FROM customer WHERE c_acctbal < 0"
    )
    + " UNION ALL "
    + check_sql("unique", "c_custkey", "SELECT count(*) FROM customer", "SELECT 0"),
)
def passthrough_contract(spark, sf_dir):
    """A released table takes all rows over; its stricter tests name what breaks them."""
    curated = given(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    return run_checks(curated, [NotNull("c_custkey"), NotNull("balance"), Unique(("c_custkey",))])


def verified_sql(check: str, evaluated: str, passed: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", e AS evaluated, p AS passed, e = p AS success"
        f" FROM (SELECT CAST(({evaluated}) AS BIGINT) AS e, CAST(({passed}) AS BIGINT) AS p)"
    )


def _damaged_documents(spark, sf_dir):
    """Documents as raw rows; those of one language changed after they were stored, those of another have a wrong label."""
    documents = payload_rows(spark, sf_dir, "documents", "doc_id", "text", "lang")
    path = F.format_string("doc/%d", F.col("doc_id"))

    def raw(rows):
        return ingest(as_payloads(rows, path, F.col("text")), DOCUMENTS, RUN)

    changed = F.concat(F.reverse("raw_payload"), F.lit("!"))
    german = raw(documents.filter("lang = 'de'")).withColumn("raw_payload", changed)
    french = raw(documents.filter("lang = 'fr'")).withColumn("source_file_format", F.lit("csv"))
    others = raw(documents.filter("lang IS NULL OR lang NOT IN ('de', 'fr')"))
    return union_all([others, german, french])


ALL_DOCUMENTS = "SELECT count(*) FROM documents"
NOT_GERMAN = "SELECT count(*) FROM documents WHERE lang IS DISTINCT FROM 'de'"
NOT_FRENCH = "SELECT count(*) FROM documents WHERE lang IS DISTINCT FROM 'fr'"
CONTENT_SQL = " UNION ALL ".join(
    [
        verified_sql("hash", ALL_DOCUMENTS, NOT_GERMAN),
        verified_sql("size", ALL_DOCUMENTS, NOT_GERMAN),
        verified_sql("format", ALL_DOCUMENTS, NOT_FRENCH),
    ]
)


@query("verify_hash_size", CONTENT_SQL)
def verify_hash_size(spark, sf_dir):
    return verify_contents(_damaged_documents(spark, sf_dir), "text")


def _order_payloads(spark, sf_dir):
    """A JSON and a CSV payload per order, as raw rows."""
    entry = F.struct(
        F.col("o_custkey").cast("string").alias("company_id"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.array(F.struct(F.lit(2022).alias("reporting_year")), F.struct(F.lit(2023).alias("reporting_year"))),
        ).alias("reporting_periods"),
    )
    wrapper = F.struct(
        F.when(F.col("o_orderpriority") != "5-LOW", "ok").alias("status"),
        F.lit(1).alias("total_records"),
        F.lit("shop").alias("source"),
        F.array(entry).alias("data"),
    )
    orders = payload_rows(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    path = F.col("o_orderkey").cast("string")
    csv = F.concat_ws(
        "\n",
        F.when(F.col("o_orderpriority") == "5-LOW", "key;price").otherwise("key,price"),
        F.concat_ws(",", path, F.col("o_totalprice").cast("string")),
        F.when(F.col("o_orderstatus") == "P", ""),
        F.when(F.col("o_orderstatus") == "F", F.concat_ws(",", path, F.lit("0"))),
        F.lit(""),
    )

    def raw(text, source):
        return label_payloads(as_payloads(orders, path, text), source, RUN)

    return raw(F.to_json(wrapper), Source("json", "shop")), raw(csv, Source("csv", "shop"))


ALL_ORDERS = "SELECT count(*) FROM orders"
NOT_LOW = "SELECT count(*) FROM orders WHERE o_orderpriority <> '5-LOW'"
STRUCTURE_SQL = " UNION ALL ".join(
    [
        verified_sql("wrapper_keys", ALL_ORDERS, NOT_LOW),
        verified_sql("outer", ALL_ORDERS, ALL_ORDERS),
        verified_sql("first", ALL_ORDERS, "SELECT count(*) FROM orders WHERE o_orderstatus <> 'P'"),
        verified_sql("inner", ALL_ORDERS, "SELECT count(*) FROM orders WHERE o_orderstatus <> 'P'"),
        verified_sql("header", ALL_ORDERS, NOT_LOW),
        verified_sql("data_rows", ALL_ORDERS, "SELECT count(*) FROM orders WHERE o_orderstatus <> 'F'"),
    ]
)


def _structure_checks(spark, sf_dir):
    json_rows, csv_rows = _order_payloads(spark, sf_dir)
    return union_all(
        [
            verify_json(
                json_rows,
                ["status", "total_records", "source", "data"],
                "data",
                "reporting_periods",
                {"outer": 1, "first": 2, "inner": 2},
            ),
            verify_csv(csv_rows, "key,price", 1),
        ]
    )


@query("verify_payload_structure", STRUCTURE_SQL)
def verify_payload_structure(spark, sf_dir):
    return _structure_checks(spark, sf_dir)


@query(
    "payload_element_count",
    """
    SELECT count(*) AS payloads, CAST(count(*) FILTER (WHERE o_orderstatus <> 'P') * 2 AS BIGINT) AS periods
    FROM orders
    """,
)
def payload_element_count(spark, sf_dir):
    """Elements of nested arrays, summed over all payloads without unnesting them."""
    json_rows, _ = _order_payloads(spark, sf_dir)
    element = text_schema(["company_id"]).simpleString()[7:-1]
    data = F.from_json("raw_payload", f"data array<struct<{element}, reporting_periods: array<string>>>")["data"]
    periods = F.aggregate(
        data, F.lit(0), lambda total, company: total + F.coalesce(F.array_size(company["reporting_periods"]), F.lit(0))
    )
    return json_rows.agg(F.count(F.lit(1)).alias("payloads"), F.sum(periods).alias("periods"))


@query(
    "verify_counts",
    f"""
    WITH counts AS (SELECT count(*) AS n FROM documents),
    checks AS (
        SELECT 'rows' AS "check", 2 * n AS evaluated, 2 * n AS passed, true AS success FROM counts
        UNION ALL SELECT 'runs', 2, 2, true
        UNION ALL {CONTENT_SQL})
    SELECT CAST(count_if(success) AS BIGINT) AS passed, count(*) AS total, bool_and(success) AS success FROM checks
    """,
)
def verify_counts_query(spark, sf_dir):
    """Rows and runs of two ingestions, with the content checks, as one verdict."""
    files = documents_as_payloads(spark, sf_dir)
    second = Run("run-0002", "2026-01-06T08:00:00Z")
    raw = label_payloads(files, DOCUMENTS, RUN).unionByName(label_payloads(files, DOCUMENTS, second))
    expected = given(spark, sf_dir, "documents").count() * 2
    return summarize(
        verify_counts(raw, expected, 2).unionByName(verify_contents(_damaged_documents(spark, sf_dir), "text"))
    )


@query(
    "unique_incremental",
    """
    WITH keys AS (SELECT coalesce(l_orderkey, 0) % 3 AS load, l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT CAST(load AS INTEGER) AS load, CAST(sum(n) AS BIGINT) AS evaluated,
           count(*) FILTER (n > 1 OR EXISTS (
               SELECT 1 FROM keys e WHERE e.load < keys.load AND e.l_partkey IS NOT DISTINCT FROM keys.l_partkey
               AND e.l_suppkey IS NOT DISTINCT FROM keys.l_suppkey)) AS failures
    FROM keys GROUP BY load
    """,
)
def unique_incremental(spark, sf_dir):
    """Three loads of lines, each tested against the keys of those before, which lie in buckets."""
    lines, columns = given(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]
    path = work_dir(spark, "known-keys")
    name = "known_" + path.rsplit("-", 1)[-1]
    reports = []
    for load in range(3):
        rows = lines.filter(F.pmod(F.coalesce("l_orderkey", F.lit(0)), F.lit(3)) == load)
        known = known_keys(spark, name) if load else None
        # The report of a load is about the keys before it, so it is made before they grow.
        evaluated, failures = uniqueness_of_load(rows, columns, known).first()
        reports.append((load, evaluated, failures))
        remember_keys(rows, columns, name, path)
    return spark.createDataFrame(reports, "load int, evaluated long, failures long")
