from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.operators.expand import expand_csv, expand_lines, expand_nested_records, expand_records
from siltbed.registry.core import payload_rows, query
from siltbed.registry.landing import block_of


@query(
    "json_expand_single",
    """
    SELECT o_orderkey, 'list' AS kind, CAST(o_orderdate AS DATE) AS business_date, o_totalprice AS nav
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, 'net', CAST(o_orderdate AS DATE), o_totalprice / 2 FROM orders WHERE o_orderstatus = 'O'
    """,
)
def json_expand_single(spark, sf_dir):
    """Order envelopes with none, one or two records; quoted numbers cast as well."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")

    def record(kind, price):
        return F.struct(F.lit(kind).alias("kind"), day, price.cast("string").alias("price"))

    listed = record("list", F.col("o_totalprice"))
    records = (
        F.when(F.col("o_orderstatus") == "O", F.array(listed, record("net", F.col("o_totalprice") / 2)))
        .when(F.col("o_orderstatus") == "F", F.array(listed))
        .alias("records")
    )
    rows = payload_rows(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    raw = rows.select(
        "o_orderkey", F.to_json(F.struct(F.lit("shop").alias("source_system"), records)).alias("raw_payload")
    )
    fields = {"kind": ("kind", "string"), "business_date": ("day", "date"), "nav": ("price", "double")}
    return expand_records(raw, "records", fields, ["o_orderkey"])


@query(
    "json_filter_scalar",
    """
    SELECT user_id, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 50
    """,
)
def json_filter_scalar(spark, sf_dir):
    """Rows chosen by a value inside their JSON payload."""
    k = F.from_json("props", "k string")["k"].cast("int")
    events = payload_rows(spark, sf_dir, "events", "user_id", "event_id", "props")
    return events.select("user_id", "event_id", k.alias("k")).filter("k > 50")


LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query(
    "json_expand_double",
    """
    WITH periods AS (
        SELECT *, 'price' AS kind, l_extendedprice AS amount, 'EUR' AS unit FROM lineitem
        UNION ALL
        SELECT *, 'discount', CASE WHEN l_returnflag <> 'N' THEN l_discount END,
               CASE WHEN l_returnflag <> 'N' THEN 'share' END FROM lineitem
        UNION ALL
        SELECT *, 'tax', l_tax, 'share' FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey AS company_id, l_shipdate AS shipped, kind, amount, unit
    FROM periods WHERE NOT (l_linestatus = 'F' AND l_returnflag = 'A') AND l_quantity <> 50
    """,
)
def json_expand_double(spark, sf_dir):
    """Line items as items with periods: empty and missing inner arrays give no row,
    a missing value object gives NULLs."""

    def period(kind, value, unit, present=F.lit(True)):
        amount = F.when(present, F.struct(value.alias("value"), F.lit(unit).alias("unit")))
        return F.struct(F.lit(kind).alias("kind"), amount.alias("amount"))

    periods = F.array(
        period("price", F.col("l_extendedprice"), "EUR"),
        period("discount", F.col("l_discount"), "share", F.col("l_returnflag") != "N"),
        period("tax", F.col("l_tax"), "share"),
    )
    item = F.struct(
        "l_partkey",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A"), F.slice(periods, 1, 0))
        .when(F.col("l_quantity") != 50, periods)
        .alias("periods"),
    )
    rows = payload_rows(spark, sf_dir, "lineitem", *LINE_COLUMNS)
    raw = rows.select(
        "l_orderkey", "l_linenumber", F.to_json(F.struct(F.array(item).alias("data"))).alias("raw_payload")
    )
    return expand_nested_records(
        raw,
        "data",
        "periods",
        {"company_id": ("l_partkey", "bigint"), "shipped": ("shipped", "timestamp_ntz")},
        {"kind": ("kind", "string"), "amount": ("amount.value", "double"), "unit": ("amount.unit", "string")},
        ["l_orderkey", "l_linenumber"],
    )


def _order_csv(quote: str):
    """Header, a full line, a blank line, and a line with gaps and no number."""
    label = F.concat(F.lit(quote), "o_orderpriority", F.lit("," if quote else ";"), "o_orderstatus", F.lit(quote))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    first = F.concat_ws(",", F.col("o_custkey").cast("string"), label, F.col("o_totalprice").cast("string"), day)
    second = F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit(""), F.lit("n/a"))
    return F.concat_ws("\n", F.lit("account,label,price,day"), F.concat(first, F.lit("\r")), F.lit(" \t"), second, F.lit(""))


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate"]
CSV_COLUMNS = {"account": "bigint", "label": "string", "price": "double", "day": "date"}
CSV_SQL = """
    SELECT o_orderkey, CAST(2 AS BIGINT) AS row_number, o_custkey AS account,
           o_orderpriority || '{sep}' || o_orderstatus AS label, o_totalprice AS price,
           CAST(o_orderdate AS DATE) AS day
    FROM orders
    UNION ALL
    SELECT o_orderkey, 4, o_custkey, NULL, NULL, NULL FROM orders
"""


@query("csv_expand", CSV_SQL.format(sep=","))
def csv_expand(spark, sf_dir):
    """CSV payloads with quoted commas, carriage returns, blank lines and short lines."""
    raw = payload_rows(spark, sf_dir, "orders", *ORDER_COLUMNS).select("o_orderkey", _order_csv('"').alias("raw_payload"))
    return expand_csv(raw, CSV_COLUMNS, ["o_orderkey"])


@query("csv_expand_plain", CSV_SQL.format(sep=";"))
def csv_expand_plain(spark, sf_dir):
    """The same with every comma a separator."""
    raw = payload_rows(spark, sf_dir, "orders", *ORDER_COLUMNS).select("o_orderkey", _order_csv("").alias("raw_payload"))
    return expand_csv(raw, CSV_COLUMNS, ["o_orderkey"], quoted=False)


@query(
    "lines_ordinality",
    """
    SELECT doc_id, CAST(row_number AS BIGINT) AS row_number, CAST(length(line) AS BIGINT) AS n_chars,
           sha256(line) AS line_hash
    FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS row_number
          FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
    """,
)
def lines_ordinality(spark, sf_dir):
    lines = expand_lines(payload_rows(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"], "text")
    return lines.select(
        "doc_id",
        "row_number",
        F.char_length("line").cast("bigint").alias("n_chars"),
        F.sha2("line", 256).alias("line_hash"),
    )


@query(
    "csv_records",
    r"""
    SELECT doc_id // 1000 AS block, row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) + 1 AS row_number,
           doc_id, sha256(text) AS text_hash, coalesce(source, '') || ' 5" disk' AS note, 'say "hi", ' || coalesce(lang, '') AS quoted
    FROM documents
    """,
)
def csv_records_query(spark, sf_dir):
    """A thousand documents as one CSV payload: quoted texts of several lines, quotes inside plain cells, and payloads
    that several tasks expand."""

    def cell(value):
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))

    block = block_of("doc_id").alias("block")
    line = F.concat_ws(
        ",",
        F.col("doc_id").cast("string"),
        cell(F.col("text")),
        F.concat(F.coalesce("source", F.lit("")), F.lit(' 5" disk')),
        cell(F.concat(F.lit('say "hi", '), F.coalesce("lang", F.lit("")))),
    )
    lines = F.array_sort(F.collect_list(F.struct("doc_id", line.alias("line"))))["line"]
    documents = payload_rows(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    raw = documents.groupBy(block).agg(F.concat(F.lit("doc_id,text,note,quoted\r\n"), F.array_join(lines, "\r\n")).alias("raw_payload"))
    columns = {"doc_id": "bigint", "text": "string", "note": "string", "quoted": "string"}
    records = expand_csv(raw, columns, ["block"], part_bytes=1 << 18)
    return records.select("block", "row_number", "doc_id", F.sha2("text", 256).alias("text_hash"), "note", "quoted")


@query(
    "json_split_large",
    r"""
    SELECT o_orderkey // 1000 AS block, o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price,
           'a]},"\' || o_orderpriority AS note
    FROM orders
    """,
)
def json_split_large(spark, sf_dir):
    """A thousand order keys as one JSON payload with keys before and after its records, expanded by several tasks."""
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.array(F.lit(1), F.lit(2)).alias("other")).alias("at"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.concat(F.lit('a]},"\\'), "o_orderpriority").alias("note"),
    )
    orders = payload_rows(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    envelope = F.struct(
        F.struct(F.lit("shop,[").alias("name"), F.array(F.lit("x")).alias("tags")).alias("source"),
        F.collect_list(record).alias("records"),
        F.array(F.struct(F.lit(0).alias("id"))).alias("trailer"),
    )
    raw = orders.groupBy(block_of("o_orderkey").alias("block")).agg(F.to_json(envelope).alias("raw_payload"))
    fields = {
        "order_id": ("id", "bigint"),
        "day": ("at.day", "date"),
        "price": ("price", "double"),
        "note": ("note", "string"),
    }
    return expand_records(raw, "records", fields, ["block"], part_bytes=1 << 14)
