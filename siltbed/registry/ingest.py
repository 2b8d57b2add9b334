from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.digests import byte_size
from siltbed.operators.expand import expand_csv, expand_lines, expand_records
from siltbed.operators.reshape import wrap_records
from siltbed.registry.core import given, payload_rows, plain_time, query
from siltbed.registry.landing import block_of, land_csv, land_payloads
from siltbed.session import work_dir
from siltbed.sources.files import (
    RAW_SCHEMA,
    Run,
    Source,
    first_of_each_content,
    ingest,
    ingested_between,
    label_payloads,
    read_files,
    skip_known,
    split_rejects,
    with_ingestion_date,
)
from siltbed.sources.manifest import Manifest, list_files, read_listed
from siltbed.sources.records import extract, read_csv, read_json_documents
from siltbed.sources.tables import VersionedTable

RUN = Run("run-0001", "2026-01-05T08:00:00Z")
DOCUMENTS = Source(file_format="text", system="library")

ORDER_CSV = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
ORDER_DDL = ", ".join(f"{name} {data_type}" for name, data_type in ORDER_CSV.items())


def as_payloads(df: DataFrame, path, text) -> DataFrame:
    """Rows in the shape of a file scan: path, length, content."""
    return df.select(path.alias("path"), byte_size(text).alias("length"), text.cast("binary").alias("content"))


def documents_as_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_payloads(
        payload_rows(spark, sf_dir, "documents", "doc_id", "text"), F.format_string("doc/%d", F.col("doc_id")), F.col("text")
    )


@query(
    "raw_ingest_provenance",
    """
    SELECT 'run-0001' AS ingestion_id, TIMESTAMP '2026-01-05 08:00:00' AS ingestion_timestamp,
           'library' AS source_system, 'v1' AS source_version,
           'doc/' || doc_id AS source_file_path, 'sha256:' || sha256(text) AS source_file_hash,
           CAST(octet_length(encode(text)) AS BIGINT) AS source_file_size_bytes,
           'text' AS source_file_format, text AS raw_payload
    FROM documents
    """,
)
def raw_ingest_provenance(spark, sf_dir):
    raw = ingest(documents_as_payloads(spark, sf_dir), DOCUMENTS, RUN)
    return plain_time(raw, "ingestion_timestamp")


@query(
    "raw_file_ingest",
    """
    SELECT 'run-0001' AS ingestion_id, 'shop' AS source_system, o_orderkey, o_custkey, o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """,
)
def raw_file_ingest(spark, sf_dir):
    """Orders as CSV files on disk, each ingested whole into a raw table, then expanded."""
    files = land_csv(payload_rows(spark, sf_dir, "orders", *ORDER_CSV), "orders-csv")
    raw = ingest(read_files(spark, files, "*.csv"), Source("csv", "shop"), RUN)
    table = VersionedTable(spark, work_dir(spark, "raw-orders"))
    table.append(with_ingestion_date(raw), partition_by=["ingestion_date"])
    stored = ingested_between(table.read(), "2026-01-05", "2026-01-05")
    return expand_csv(stored, ORDER_CSV, ["ingestion_id", "source_system"], strict=True).drop("row_number")


@query(
    "raw_envelope_metadata",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN 'fallback' ELSE c_mktsegment END
               AS source_system,
           CASE WHEN c_nationkey > 12 THEN 'v' || c_nationkey END AS source_version
    FROM customer
    """,
)
def raw_envelope_metadata(spark, sf_dir):
    """Labels from the JSON envelope; an empty or missing source takes the fallback."""
    envelope = F.struct(
        F.when(F.col("c_acctbal") < 0, "")
        .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
        .alias("source"),
        F.when(F.col("c_nationkey") > 12, F.concat(F.lit("v"), "c_nationkey")).alias("source_version"),
        F.array(F.struct("c_name", "c_acctbal")).alias("records"),
    )
    payloads = as_payloads(
        given(spark, sf_dir, "customer"), F.col("c_custkey").cast("string"), F.to_json(envelope)
    )
    labels = Source("json", "fallback", None, "source", "source_version", object_required=True)
    raw = ingest(payloads, labels, RUN)
    return raw.select(
        F.col("source_file_path").cast("bigint").alias("c_custkey"), "source_system", "source_version"
    )


@query(
    "ingest_reject_split",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 'malformed_json' WHEN 'view' THEN 'not_an_object'
                           WHEN 'signup' THEN 'not_utf8' ELSE 'accepted' END AS verdict,
           CAST(CASE event_type WHEN 'click' THEN length(props) - 1 WHEN 'view' THEN length(props) + 2
                                WHEN 'signup' THEN length(props) + 1 ELSE length(props) END AS BIGINT) AS size_bytes
    FROM events
    """,
)
def ingest_reject_split(spark, sf_dir):
    """Event payloads, those of some types damaged: stored or rejected with a reason."""
    content = F.col("props").cast("binary")
    damaged = (
        F.when(F.col("event_type") == "click", F.expr("left(props, length(props) - 1)").cast("binary"))
        .when(F.col("event_type") == "view", F.concat(F.lit("["), "props", F.lit("]")).cast("binary"))
        .when(F.col("event_type") == "signup", F.concat(content, F.unhex(F.lit("FF"))))
        .otherwise(content)
    )
    events = payload_rows(spark, sf_dir, "events", "event_id", "event_type", "props")
    files = events.select(
        F.col("event_id").cast("string").alias("path"), byte_size(damaged).alias("length"), damaged.alias("content")
    )
    accepted, rejected = split_rejects(files, Source("json", "web", object_required=True), RUN)
    return accepted.select(
        F.col("source_file_path").cast("bigint").alias("event_id"),
        F.lit("accepted").alias("verdict"),
        F.col("source_file_size_bytes").alias("size_bytes"),
    ).unionAll(rejected.select(F.col("path").cast("bigint"), "reject_reason", "length"))


@query(
    "ingest_dedup_by_hash",
    """
    SELECT 'sha256:' || sha256(text) AS source_file_hash, min(doc_id) AS doc_id, count(*) AS copies
    FROM documents GROUP BY 1
    """,
)
def ingest_dedup_by_hash(spark, sf_dir):
    return first_of_each_content(payload_rows(spark, sf_dir, "documents", "doc_id", "text"), "text", "doc_id")


@query(
    "ingest_skip_known",
    """
    SELECT 'doc/' || doc_id AS source_file_path, 'sha256:' || sha256(text) AS source_file_hash
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def ingest_skip_known(spark, sf_dir):
    """All documents come in again; those that are labelled were stored before."""
    incoming = label_payloads(documents_as_payloads(spark, sf_dir), DOCUMENTS, RUN)
    labelled = given(spark, sf_dir, "labels").select(
        F.format_string("doc/%d", F.col("doc_id")).alias("source_file_path")
    )
    stored = incoming.join(labelled, "source_file_path", "left_semi")
    return skip_known(incoming, stored).select("source_file_path", "source_file_hash")


@query(
    "ingest_by_manifest",
    """
    SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN 'run-0001' ELSE 'run-0002' END AS ingestion_id FROM events
    """,
)
def ingest_by_manifest(spark, sf_dir):
    """Event files of a folder that grows between three runs; each run opens the files that are new to it."""
    landing, raw = work_dir(spark, "event-landing"), work_dir(spark, "raw-by-manifest")
    manifest = Manifest(spark, work_dir(spark, "event-manifest"))
    events = given(spark, sf_dir, "events").select("event_id", "user_id")
    odd = F.coalesce(F.col("event_id") % 2 == 1, F.lit(False))
    for number, arriving in enumerate((events.filter(odd), events.filter(~odd), None), 1):
        if arriving is not None:
            lines = arriving.select(F.to_json(F.struct(*events.columns)).alias("value"))
            lines.write.mode("append").option("maxRecordsPerFile", 20_000).text(landing)
        run = Run(f"run-{number:04d}", RUN.timestamp)
        new = manifest.unseen(list_files(spark, landing, "*.txt"))
        rows = ingest(read_listed(spark, landing, new, "*.txt"), Source("jsonl", "web"), run)
        rows.write.mode("overwrite").parquet(f"{raw}/ingestion_id={run.ingestion_id}")
        manifest.record(new, run.ingestion_id)
    stored = manifest.finished(spark.read.schema(RAW_SCHEMA).parquet(raw))
    lines = expand_lines(stored, ["ingestion_id"]).filter("line <> ''")
    event = F.from_json("line", events.schema)
    return lines.select(event["event_id"].alias("event_id"), event["user_id"].alias("user_id"), "ingestion_id")


@query("scan_csv_typed", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_csv_typed(spark, sf_dir):
    files = land_csv(given(spark, sf_dir, "part"), "part-csv", 100_000)
    return read_csv(
        spark,
        files,
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    )


@query(
    "scan_json_documents",
    "SELECT o_orderpriority, o_orderkey, o_totalprice, o_orderdate FROM orders",
)
def scan_json_documents(spark, sf_dir):
    """JSON documents of up to five thousand orders, one per file, read and unnested."""
    envelopes = wrap_records(
        given(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice", "o_orderdate"),
        ["o_orderpriority"],
        block_of("o_orderkey", 5_000),
        ["o_orderdate", "o_orderkey"],
        {"source_system": F.lit("shop"), "priority": F.col("o_orderpriority")},
        5_000,
    )
    files = land_payloads(envelopes, "raw_payload", "orders-json")
    documents = read_json_documents(
        spark,
        files,
        "priority string, record_count int,"
        " records array<struct<o_orderkey: bigint, o_totalprice: double, o_orderdate: timestamp_ntz>>",
    )
    return documents.select(F.col("priority").alias("o_orderpriority"), F.inline("records"))


@query(
    "filter_in_set_cutoff",
    """
    SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate >= TIMESTAMP '1998-01-01'
    """,
)
def filter_in_set_cutoff(spark, sf_dir):
    cutoff = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    orders = extract(given(spark, sf_dir, "orders"), "O_ORDERPRIORITY", ["1-URGENT", "2-HIGH"], cutoff)
    return orders.select("o_orderkey", "o_orderpriority", "o_orderdate")


@query(
    "partition_pruned_read",
    """
    SELECT event_id, CAST(ts AS DATE) AS ingestion_date FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15'
    """,
)
def partition_pruned_read(spark, sf_dir):
    """Raw rows by day of ingestion; a day range reads its folders only."""
    raw = given(spark, sf_dir, "events").select("event_id", F.col("ts").alias("ingestion_timestamp"), "props")
    table = VersionedTable(spark, work_dir(spark, "raw-events"))
    table.append(with_ingestion_date(raw), partition_by=["ingestion_date"])
    return ingested_between(table.read(), "2024-01-10", "2024-01-14").select("event_id", "ingestion_date")
