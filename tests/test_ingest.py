import hashlib

import pytest
from fixtures import price, prices_json, write_csv_source, write_json_source
from pyspark.sql import functions as F

from siltbed.functions.json_fields import is_json, is_json_object
from siltbed.operators.verify import summarize, verify_contents, verify_counts, verify_csv, verify_json
from siltbed.plans.emissions import CDP_FILES, CDP_HEADER, NZDPU_FILES, NZDPU_WRAPPER
from siltbed.plans.prices import PRICE_FILES
from siltbed.sources.files import (
    Run,
    Source,
    ingest,
    ingested_between,
    read_files,
    skip_known,
    split_rejects,
    with_ingestion_date,
)
from siltbed.sources.tables import VersionedTable

RUN = Run("run", "2026-01-05T08:00:00Z")


def test_csv_file_is_stored_byte_for_byte(spark, tmp_path):
    folder = write_csv_source(tmp_path / "csv", end="\r\n")
    content = (folder / "survey.csv").read_bytes()
    row = ingest(read_files(spark, str(folder), "*.csv"), CDP_FILES, RUN).first()
    assert row["raw_payload"].encode() == content
    assert row["source_file_hash"] == "sha256:" + hashlib.sha256(content).hexdigest()
    assert row["source_file_size_bytes"] == len(content)
    assert (row["source_system"], row["source_version"], row["source_file_format"]) == ("cdp", "v1", "csv")
    assert row["ingestion_id"] == "run"
    assert str(row["ingestion_timestamp"]) == "2026-01-05 08:00:00"


def test_labels_from_the_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text(prices_json([price("DE1", "2026-01-05", 1.5)]))
    (tmp_path / "b.json").write_text('{"records": []}')
    rows = {r["source_file_path"][-6:]: r for r in ingest(read_files(spark, str(tmp_path)), PRICE_FILES, RUN).collect()}
    assert (rows["a.json"]["source_system"], rows["a.json"]["source_version"]) == ("fundsys", "v1")
    assert (rows["b.json"]["source_system"], rows["b.json"]["source_version"]) == ("", None)


def test_empty_source_takes_the_fallback(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"source": "", "data": []}')
    assert ingest(read_files(spark, str(tmp_path)), NZDPU_FILES, RUN).first()["source_system"] == "nzdpu"


@pytest.mark.parametrize(
    ("content", "reason"),
    [(b'{"data": [', "malformed_json"), (b'{"data": []} x', "malformed_json"), (b"[1, 2]", "not_an_object"), (b'{"a": "\xff"}', "not_utf8")],
)
def test_bad_files_are_rejected_or_fail(spark, tmp_path, content, reason):
    (tmp_path / "good.json").write_text('{"source": "x", "data": []}')
    (tmp_path / "bad.json").write_bytes(content)
    files = read_files(spark, str(tmp_path))
    accepted, rejected = split_rejects(files, NZDPU_FILES, RUN)
    assert [r["source_file_path"][-9:] for r in accepted.collect()] == ["good.json"]
    assert [r["reject_reason"] for r in rejected.collect()] == [reason]
    with pytest.raises(Exception, match=reason):
        ingest(files, NZDPU_FILES, RUN).collect()


def test_ingesting_twice_adds_nothing(spark, tmp_path):
    folder = write_csv_source(tmp_path / "csv")
    table = VersionedTable(spark, str(tmp_path / "raw"))
    first = ingest(read_files(spark, str(folder)), CDP_FILES, RUN)
    table.append(first)
    table.append(skip_known(first, table.read()))
    assert table.read().count() == 1
    (folder / "survey.csv").write_text(CDP_HEADER + "\n")
    changed = ingest(read_files(spark, str(folder)), CDP_FILES, RUN)
    assert skip_known(changed, table.read()).count() == 1


def test_day_range_reads_its_partitions_only(spark, tmp_path, plan):
    folder = write_csv_source(tmp_path / "csv")
    table = VersionedTable(spark, str(tmp_path / "raw"))
    table.append(
        with_ingestion_date(ingest(read_files(spark, str(folder)), CDP_FILES, RUN)), partition_by=["ingestion_date"]
    )
    found = ingested_between(table.read(), "2026-01-05", "2026-01-06")
    assert found.count() == 1
    pruned = plan(found).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "ingestion_date" in pruned
    assert ingested_between(table.read(), "2026-01-06", "2026-01-07").count() == 0


def test_verification_of_raw_rows(spark, tmp_path):
    csv = ingest(read_files(spark, str(write_csv_source(tmp_path / "c"))), CDP_FILES, RUN)
    json = ingest(read_files(spark, str(write_json_source(tmp_path / "j"))), NZDPU_FILES, RUN)
    checks = (
        verify_contents(csv, "csv")
        .unionByName(verify_contents(json, "json"))
        .unionByName(verify_csv(csv, CDP_HEADER, 100))
        .unionByName(verify_json(json, NZDPU_WRAPPER, "data", "reporting_periods", {"outer": 30, "first": 3, "inner": 90}))
        .unionByName(verify_counts(csv, 1, 1))
    )
    total = summarize(checks).first()
    assert (total["passed"], total["total"], total["success"]) == (14, 14, True)


def test_verification_finds_damage(spark, tmp_path):
    raw = ingest(read_files(spark, str(write_csv_source(tmp_path / "c"))), CDP_FILES, RUN)
    damaged = raw.selectExpr("* except (raw_payload)", "raw_payload || 'x' AS raw_payload")
    failed = {r["check"] for r in verify_contents(damaged, "json").filter("not success").collect()}
    assert failed == {"hash", "size", "format"}
    failed = {r["check"] for r in verify_csv(raw, "other", 99).filter("not success").collect()}
    assert failed == {"header", "data_rows"}


def test_verification_of_broken_json(spark):
    rows = spark.createDataFrame([('{"status": 1}',), ("not json",), ('{"data": null}',)], "raw_payload string")
    checks = {r["check"]: r for r in verify_json(rows, ["status"], "data", "x", {"outer": 0, "inner": 0}).collect()}
    assert checks["wrapper_keys"]["passed"] == 1
    assert checks["outer"]["passed"] == 3
    assert checks["inner"]["passed"] == 3


def test_plain_text_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text("größe\n")
    row = ingest(read_files(spark, str(tmp_path)), Source("text", "x", None), RUN).first()
    assert (row["raw_payload"], row["source_file_size_bytes"], row["source_version"]) == ("größe\n", 8, None)


def test_empty_files_and_missing_files(spark, tmp_path):
    (tmp_path / "full +1.json").write_text('{"source": "x", "data": []}')
    (tmp_path / "empty +1.json").write_text("")
    accepted, rejected = split_rejects(read_files(spark, str(tmp_path)), NZDPU_FILES, RUN)
    assert [r["source_file_path"][-12:] for r in accepted.collect()] == ["full +1.json"]
    assert [(r["path"][-13:], r["length"], r["reject_reason"]) for r in rejected.collect()] == [("empty +1.json", 0, "malformed_json")]
    stored = ingest(read_files(spark, str(tmp_path), "empty*"), CDP_FILES, RUN).first()
    assert (stored["raw_payload"], stored["source_file_size_bytes"]) == ("", 0)
    with pytest.raises(FileNotFoundError):
        read_files(spark, str(tmp_path), "*.csv")


def test_large_json_and_repeated_keys_are_json(spark):
    texts = spark.range(1).select(
        F.explode(
            F.array(
                F.concat(F.lit('{"a":"'), F.expr("repeat('x', 140000000)"), F.lit('"}')),
                F.lit('{"a": 1, "a": 2}'),
                F.lit('{"a": 1} and more'),
                F.lit("1, 2"),
                F.lit(" [1, {}] "),
            )
        ).alias("t")
    )
    assert [r[0] for r in texts.select(is_json(F.col("t"))).collect()] == [True, True, False, False, True]
    assert [r[0] for r in texts.select(is_json_object(F.col("t"))).collect()] == [True, True, False, False, False]
